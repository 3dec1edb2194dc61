"""Mixing sources to target weights by Poisson replication. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import col, free_name
from tabml.sources.staging import stage

#: Largest mean of one inverted distribution; a larger one is a sum of several.
PIECE_MEAN = 16.0
#: Steps of a cumulative distribution: beyond them its tail is below a double's precision.
STEPS = 80


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of an MD5 of the seed and the parts."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("\0")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0**52)


def source_rates(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``source, n_docs, n_chars, weight, rate``: how often each document of a source is wanted.

    ``rate * n_chars`` is the source's share of all characters under the target weights, which
    are normalised over the sources that have characters. Without ``weights`` every source
    weighs the same; sources missing in ``weights`` get rate 0. Null is a source of its own.
    """
    size = F.coalesce(F.length(col(text).cast("string")), F.lit(0)).cast("long")
    counts = docs.groupBy(col(source).alias("source")).agg(
        F.count("*").alias("n_docs"), F.sum(size).alias("n_chars")
    )
    if weights is None:
        weight = F.lit(1.0)
    else:
        pairs = [F.lit(x) for name, w in sorted(weights.items()) for x in (name, float(w))]
        found = F.create_map(*pairs)[F.coalesce("source", F.lit("\0"))] if pairs else F.lit(None)
        weight = F.coalesce(found.cast("double"), F.lit(0.0))
    counts = counts.withColumn("weight", F.when(F.col("n_chars") > 0, weight).otherwise(0.0))
    counts = stage(counts, "source-counts")
    all_weight, all_chars = counts.agg(F.sum("weight"), F.sum("n_chars").cast("double")).first()
    share = F.col("weight") / F.lit(all_weight or 1.0)
    rate = share * F.lit(all_chars or 0.0) / F.col("n_chars")
    return counts.select(
        "source", "n_docs", "n_chars", "weight",
        F.when(F.col("weight") > 0, rate).otherwise(0.0).alias("rate"),
    )


def _cumulative(mean: Column) -> Column:
    """P(X <= j) for j = 0 .. STEPS - 1, each term from the one before."""
    empty = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS - 1)),
        empty,
        lambda acc, j: F.struct(
            (acc["p"] * mean / j).alias("p"),
            F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + acc["p"] * mean / j)).alias("c"),
        ),
        lambda acc: acc["c"],
    )


def replicate(
    docs: DataFrame,
    rates: DataFrame,
    seed: int = 17,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
    copy: str | None = None,
) -> DataFrame:
    """Each document as often as a Poisson number with the mean ``rate`` of its source says.

    ``rates`` has ``source`` and ``rate``. The number inverts the cumulative distribution at a
    uniform number hashed from the seed, key and text, so a document has the same number in any
    partition and in a task that runs again. A mean over ``PIECE_MEAN`` is a sum of independent
    pieces. The copies are dealt out by a hash and sorted by it inside each partition, which
    is a shuffle of the whole table; ``copy`` names a column for the copy's number, from 1.

    Rows equal in key and text draw alike. A null key or text is hashed as such, a null source
    is a source; a source without a rate, or a null or NaN rate, gives nothing. All columns come
    back as they were; an empty table stays empty.
    """
    rate = F.col("rate").cast("double")
    wanted = rates.select(
        F.col("source").alias("__source"),
        F.when(rate.isNull() | F.isnan(rate) | (rate < 0), 0.0).otherwise(rate).alias("rate"),
    )
    pieces = F.greatest(F.ceil(F.col("rate") / PIECE_MEAN), F.lit(1)).cast("int")
    wanted = wanted.withColumn("pieces", pieces).select(
        "__source", "pieces", _cumulative(F.col("rate") / F.col("pieces")).alias("cdf")
    )
    identity = [col(key), F.md5(F.coalesce(col(text).cast("string"), F.lit("\0")))]
    rows = docs.select(F.struct("*").alias("__row"), col(source).alias("__own"), *[
        c.alias(n) for c, n in zip(identity, ("__key", "__digest"), strict=True)
    ])
    rows = rows.join(wanted, F.col("__own").eqNullSafe(F.col("__source")))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("pieces")),
        F.lit(0),
        lambda acc, i: acc
        + F.size(
            F.filter("cdf", lambda c: c < uniform(seed, F.col("__key"), F.col("__digest"), i))
        ),
    )
    # A piece of one is the usual case, and cheaper outside the loop.
    single = uniform(seed, F.col("__key"), F.col("__digest"), F.lit(1))
    rows = rows.withColumn("__u", single)
    count = F.when(
        F.col("pieces") == 1, F.size(F.filter("cdf", lambda c: c < F.col("__u")))
    ).otherwise(drawn)
    rows = rows.select("__row", "__key", "__digest", count.alias("__n")).filter("__n > 0")
    copies = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    place = F.xxhash64(F.lit(seed), "__key", "__digest", "__copy")
    shuffled = copies.withColumn("__place", place).repartition("__place")
    shuffled = shuffled.sortWithinPartitions("__place")
    columns = [F.col("__row")[name].alias(name) for name in docs.columns]
    return shuffled.select(*columns, *([F.col("__copy").alias(free_name(copy, docs.columns))] if copy else []))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = 17, copy: str | None = None) -> DataFrame:
    """``replicate`` at the rates that bring ``docs`` to the target weights of its sources.

    The rates are written first, so that Spark knows their size when it picks the join.
    """
    rates = stage(source_rates(docs, weights), "rates")
    return replicate(docs, rates, seed, copy=copy)
