"""Fuzzy duplicate lines by SimHash, pigeonhole blocks and edit similarity.

DataFrame functions only: nothing here runs Python on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import col, free_name
from tabml.llm.components import components
from tabml.sources.staging import stage

#: Blocks of a SimHash, one of which two lines must agree in, and bits in which the whole may
#: differ: for lines of fewer than ``LONG`` characters, which resemble others by common words,
#: and for longer ones.
BLOCKS, DISTANCE, LONG, LONG_DISTANCE = 4, 5, 200, 8
#: Orders that give a block its heads, and turns of meeting them.
ORDERS, TURNS = 2, 2
#: Bits of a SimHash, and the width of the lanes that count them, which divides the bits.
BITS, LANE = 63, 9
#: Words of a line from which on a lane could overflow.
NARROW = 2 ** (LANE - 1)
BLOCK_BITS = -(-BITS // BLOCKS)
#: Fewest words of a line that can be a duplicate; shorter ones are left alone.
LEAST_WORDS = 3
#: Edit similarity of a link, in percent of the longer line.
SIMILARITY = 80
#: Edits that are looked for before all that a link may have, and most words of both lines that
#: are compared as words first.
FEW_EDITS, MOST_WORDS = 32, 1000
#: Bytes of a table's rows that go to every executor, added up first.
BROADCAST_BYTES = 32 * 1024 * 1024


def normalised(text: Column) -> Column:
    """Lower case; every run of ASCII marks, white space and controls is one space. Line ends stay."""
    return F.regexp_replace(F.lower(text), r"[\x00-\x09\x0b-/:-@\[-`{-\xbf]+", " ")


def _with_simhash(rows: DataFrame) -> DataFrame:
    """``sim`` for lines with ``row, words, count`` and other columns of whole numbers.

    It has the bits that more than half of the distinct words' hashes have. Words are exploded and
    summed by the line's number alone; whatever else belongs to the line comes along as a
    maximum of equal numbers, so that the aggregate's rows stay narrow and of fixed width. Sum
    number j of a line of fewer than ``NARROW`` words adds up the bits j, j + LANE,
    j + 2 * LANE, ... of its hashes, each in a lane of ``LANE`` bits; adding to each lane what
    half the words lack to its highest bit leaves that bit as the answer. A longer line is
    summed in parts of ``LANE`` bits, whose counts have a whole number each; it comes back as a
    row for each ``part``, and the parts' ``sim`` add up by a bitwise or.
    """
    lanes = range(0, BITS, LANE)
    ones = F.lit(sum(1 << lane for lane in lanes)).cast("long")
    tops = F.lit(sum(1 << (lane + LANE - 1) for lane in lanes)).cast("long")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    keys = [name for name in rows.columns if name not in ("row", "words")]

    narrow_line = F.col("count") < NARROW
    parts = F.sequence(F.lit(0), F.lit(BITS // LANE - 1))
    parts = F.when(narrow_line, F.array(F.lit(0))).otherwise(parts)
    rows = rows.withColumn("part", F.explode(parts))
    # The outer explode, as a plain one has Spark make all arrays once more to filter empty ones.
    rows = rows.select("row", "part", *keys, F.explode_outer("words").alias("word"))
    # Spark's functions shift by a constant, its expressions by a column as well.
    rows = rows.withColumn("feature", F.expr(f"shiftrightunsigned(xxhash64(word), {LANE} * part)"))
    mask = F.when(narrow_line, ones).otherwise(one)
    sums = [F.sum(F.shiftrightunsigned("feature", j).bitwiseAND(mask)).alias(f"n{j}") for j in range(LANE)]
    summed = rows.groupBy("row", "part").agg(*sums, *[F.max(name).alias(name) for name in keys])

    half = F.floor(F.col("count") / 2)
    lacking = (F.lit(NARROW - 1).cast("long") - half) * ones
    narrow = [
        F.shiftrightunsigned((F.col(f"n{j}") + lacking).bitwiseAND(tops), LANE - 1 - j) for j in range(LANE)
    ]
    wide = [F.when(F.col(f"n{j}") > half, F.lit(1 << j).cast("long")).otherwise(zero) for j in range(LANE)]
    summed = summed.withColumn("wide", reduce(Column.bitwiseOR, wide))
    sim = F.when(narrow_line, reduce(Column.bitwiseOR, narrow))
    sim = sim.otherwise(F.expr(f"shiftleft(wide, {LANE} * part)"))
    return summed.select(*[name for name in keys if name != "count"], "part", sim.alias("sim"))


def line_table(docs: DataFrame, text: str, key: str, least_words: int = LEAST_WORDS) -> DataFrame:
    """``id, mark, pos, node, n_chars, part, sim`` for every line that can be a duplicate.

    ``mark`` tells rows of the same key apart by their text, ``node`` names the normalised line.
    A line of ``NARROW`` words or more has a row for each part of its SimHash.
    """
    rows = docs.select(
        col(key).cast("long").alias("id"),
        F.xxhash64(col(text).cast("string")).alias("mark"),
        F.posexplode(F.split(normalised(col(text).cast("string")), "\n", -1)).alias("pos", "line"),
    )
    rows = rows.withColumn("line", F.trim("line"))
    blanks = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit("")))
    rows = rows.withColumn("count", F.when(F.col("line") == "", 0).otherwise(blanks + 1).cast("long"))
    rows = rows.filter(F.col("count") >= least_words)
    rows = rows.select(
        "id", "mark", "pos", F.length("line").alias("n_chars"), F.array_distinct(F.split("line", " ")).alias("words"),
        F.xxhash64("line").alias("high"), F.xxhash64(F.lit(1), F.col("line")).alias("low"),
        # Keeps equal rows apart, whose words would be summed together.
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.withColumn("count", F.size("words").cast("long"))
    node = F.unhex(F.concat(F.lpad(F.hex("high"), 16, "0"), F.lpad(F.hex("low"), 16, "0")))
    return _with_simhash(rows).withColumn("node", node).drop("high", "low")


def _block(sim: Column, number: int) -> Column:
    value = F.shiftrightunsigned(sim, BLOCK_BITS * number).bitwiseAND(F.lit(2**BLOCK_BITS - 1))
    return value.bitwiseOR(F.lit(number << BLOCK_BITS)).cast("int")


_ENDS = ("node", "sim", "n_chars")


def _near() -> Column:
    """SimHashes and lengths of ``a`` and ``b`` that a link may have."""
    shorter = F.least("a_n_chars", "b_n_chars")
    allowed = F.when(shorter >= LONG, LONG_DISTANCE).otherwise(DISTANCE)
    return (F.bit_count(F.col("a_sim").bitwiseXOR(F.col("b_sim"))) <= allowed) & (
        100 * F.least("a_n_chars", "b_n_chars") >= SIMILARITY * F.greatest("a_n_chars", "b_n_chars")
    )


def _blocks(lines: DataFrame, *more: str) -> DataFrame:
    blocks = F.array(*[_block(F.col("sim"), k) for k in range(BLOCKS)])
    return lines.select(F.explode(blocks).alias("block"), *_ENDS, *more)


def first_candidates(lines: DataFrame, turn: int = 0) -> DataFrame:
    """Pairs ``a, b``: every line with the nearest head of its blocks, if one of another label is near.

    So the lines of a template, each of which resembles all others, are not paired with each
    other. A block's heads are the first and the last line in each of ``ORDERS`` orders, another
    set of orders for every ``turn``; long lines come before short ones. There are at most
    ``2 * ORDERS`` heads for each of the ``BLOCKS * 2 ** BLOCK_BITS`` blocks, whatever the
    input, so they go to every executor. Without ``label`` every line is its own.
    """
    if "label" not in lines.columns:
        lines = lines.withColumn("label", F.col("node"))
    short = F.when(F.col("n_chars") < LONG, 1 << 62).otherwise(0).cast("long")
    names = [f"order{k}" for k in range(ORDERS)]
    for k, name in enumerate(names):
        own = F.shiftrightunsigned(F.xxhash64("node", F.lit(turn * ORDERS + k)), 2)
        lines = lines.withColumn(name, own.bitwiseOR(short))
    spread = _blocks(lines, "label", *names)
    ends = [(f"{end}{name}", name, function) for name in names for end, function in (("low", F.min), ("high", F.max))]
    limits = spread.groupBy("block").agg(*[function(name).alias(end) for end, name, function in ends])
    at_end = reduce(Column.__or__, [F.col(name) == F.col(end) for end, name, _ in ends])
    columns = ("node", "sim", "n_chars", "label")
    heads = spread.join(F.broadcast(limits), "block").filter(at_end)
    heads = stage(heads.select("block", *[F.col(c).alias(f"a_{c}") for c in columns]), "heads")
    met = spread.select("block", *[F.col(c).alias(f"b_{c}") for c in columns]).join(F.broadcast(heads), "block")
    met = met.filter(_near() & (F.col("a_label") != F.col("b_label")))
    apart = F.bit_count(F.col("a_sim").bitwiseXOR(F.col("b_sim")))
    ends = F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")
    nearest = F.min(F.struct(apart.alias("apart"), F.xxhash64(*ends).alias("hash"), *ends))
    best = met.groupBy("b_node").agg(nearest.alias("best"))
    # Two heads may have chosen each other.
    return best.select("best.a", "best.b").distinct()


def candidates(lines: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of lines of different ``label`` whose SimHashes and lengths allow a link.

    A pair that agrees in several blocks comes from the first of them only.
    """
    spread = _blocks(lines, "label")
    left = spread.select(*[F.col(c).alias(f"a_{c}") for c in ("block", "label", *_ENDS)])
    right = spread.select(*[F.col(c).alias(f"b_{c}") for c in ("block", "label", *_ENDS)])
    differ = F.col("a_sim").bitwiseXOR(F.col("b_sim"))
    number = F.shiftright(F.col("a_block"), BLOCK_BITS)
    earlier = [
        (number > k) & (F.shiftrightunsigned(differ, BLOCK_BITS * k).bitwiseAND(F.lit(2**BLOCK_BITS - 1)) == 0)
        for k in range(BLOCKS - 1)
    ]
    near = (
        (F.col("a_block") == F.col("b_block"))
        & _near()
        & (F.col("a_node") < F.col("b_node"))
        & (F.col("a_label") != F.col("b_label"))
        & ~reduce(Column.__or__, earlier)
    )
    return left.join(right, near).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def _small(frame: DataFrame, row_bytes: Column, most: int = BROADCAST_BYTES) -> DataFrame:
    """``frame`` for every executor if its rows, added up first, have few bytes; else as it is."""
    size = frame.agg(F.sum(row_bytes.cast("long"))).first()[0] or 0
    return F.broadcast(frame) if size <= most else frame


def _word_edits() -> Column:
    """At least as many edits as ``x`` and ``y`` need: edits of whole words, each of the longest.

    Every word becomes one letter, its place among the words ``known`` of both lines.
    """
    letters = "decode(unhex(array_join(transform(split({}, ' '), w -> hex(array_position(known, w) + 16384)), '')), 'UTF-16BE')"
    longest = F.array_max(F.transform("known", F.length)) + 1
    return F.levenshtein(F.expr(letters.format("x")), F.expr(letters.format("y"))) * longest


def _links(pairs: DataFrame, distinct: DataFrame, docs: DataFrame, text: str, key: str) -> DataFrame:
    """The pairs whose texts reach the edit similarity. Only candidates' texts are fetched."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = distinct.join(nodes, "node", "left_semi").select("node", "first.*")
    wanted = stage(wanted.groupBy("id", "mark").agg(F.collect_list(F.struct("pos", "node")).alias("at")), "wanted")
    value = col(text).cast("string")
    rows = docs.select(col(key).cast("long").alias("id"), F.xxhash64(value).alias("mark"), value.alias("text"))
    match = rows["id"].eqNullSafe(wanted["id"]) & (rows["mark"] == wanted["mark"])
    rows = rows.join(_small(wanted, F.size("at") * 48 + 64), match).select("text", "at")
    split = rows.select(F.split(normalised(F.col("text")), "\n", -1).alias("lines"), F.explode("at").alias("one"))
    texts = split.select(F.col("one.node").alias("node"), F.trim(F.get("lines", F.col("one.pos"))).alias("line"))
    texts = stage(texts.groupBy("node").agg(F.first("line").alias("line")), "texts")
    rows = pairs.join(texts.select(F.col("node").alias("a"), F.col("line").alias("x")), "a")
    rows = rows.join(texts.select(F.col("node").alias("b"), F.col("line").alias("y")), "b")
    most = F.expr(f"{100 - SIMILARITY} * greatest(length(x), length(y)) div 100").cast("int")
    # With its bound the edit distance computes a band, and is -1 beyond it.
    # Pairs are grouped by both ends, as those of a frequent line have come to one task.
    known = F.array_distinct(F.concat(F.split(F.first("x"), " "), F.split(F.first("y"), " ")))
    rows = rows.withColumn("most", most).groupBy("a", "b")
    rows = rows.agg(*[F.first(name).alias(name) for name in ("x", "y", "most")], known.alias("known"))
    # Most near copies differ in few words: that many times the longest word bounds their edits.
    whole = F.expr("levenshtein(x, y, most) >= 0")
    few = F.when(F.size("known") <= MOST_WORDS, _word_edits() <= F.col("most")).otherwise(False)
    # A narrow band shows most others; the rest gets its whole one.
    narrow = F.expr(f"levenshtein(x, y, least(most, {FEW_EDITS})) >= 0")
    near = F.when(few, True).when(narrow, True).when(F.col("most") <= FEW_EDITS, False).otherwise(whole)
    return rows.filter(near).select("a", "b")


def dropped_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", least_words: int = LEAST_WORDS) -> DataFrame:
    """``id, mark, drops``: the positions of the lines that go, for each row that loses any."""
    lines = stage(line_table(docs, text, key, least_words), "lines")
    distinct = lines.groupBy("node").agg(
        F.min(F.struct("id", "mark", "pos")).alias("first"),
        F.count_if(F.col("part") == 0).alias("n"),
        F.bit_or("sim").alias("sim"),
        F.first("n_chars").alias("n_chars"),
    )
    distinct = stage(distinct, "distinct-lines")
    # First one pair for each line, then turns among the lines that found one, then the pairs
    # that are still between groups.
    links = stage(_links(stage(first_candidates(distinct), "line-heads"), distinct, docs, text, key), "line-links")
    groups = stage(components(links, "a", "b"), "line-groups")
    for turn in range(1, TURNS):
        linked = distinct.join(groups, "node").select(*_ENDS, "label")
        pairs = stage(first_candidates(linked, turn), "line-heads")
        if pairs.isEmpty():
            break
        links = stage(links.union(_links(pairs, distinct, docs, text, key)), "line-links")
        groups = stage(components(links, "a", "b"), "line-groups")
    grouped = distinct.join(groups, "node", "left").withColumn("label", F.coalesce("label", "node"))
    pairs = stage(candidates(grouped), "line-pairs")
    if not pairs.isEmpty():
        links = stage(links.union(_links(pairs, distinct, docs, text, key)), "line-links")
        groups = stage(components(links, "a", "b"), "line-groups")
    grouped = distinct.join(groups, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = groups.join(distinct.select("node", "first"), "node").groupBy("label").agg(F.min("first").alias("keep"))
    repeated = grouped.join(least, "label", "left").withColumn("keep", F.coalesce("keep", "first"))
    repeated = stage(repeated.filter("n > 1 or keep != first").select("node", "keep"), "repeated")
    hit = lines.filter("part = 0").join(_small(repeated, F.lit(96)), "node")
    here = F.struct("id", "mark", "pos")
    gone = hit.filter(~here.eqNullSafe(F.col("keep"))).select("id", "mark", "pos").distinct()
    return gone.groupBy("id", "mark").agg(F.collect_list("pos").alias("drops"))


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    counts: bool = False,
    empty: bool = True,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``; ``counts`` adds ``n_lines, n_dropped``.

    Lines are compared in normalised form (lower case, marks as spaces). Equal ones are one
    node. Two nodes link when the 63-bit SimHashes of their distinct words agree in one of ``BLOCKS``
    blocks and differ in at most ``DISTANCE`` bits (``LONG_DISTANCE`` in lines of ``LONG``
    characters), and their edit distance is at most ``100 - SIMILARITY`` percent of the longer
    one. Of all lines in a connected group the first
    by key, then by hash of the text, then by position stays. Lines of fewer than
    ``least_words`` words, blank ones among them, always stay.

    All equal lines are found. Of unlike ones a SimHash finds those that share most of their
    words, so it is made for long lines: of pairs with one changed character the tests ask for
    80 % at 120 words and 45 % at 40; lines of 15 words or less that differ are mostly left alone.

    Null text stays null. Rows equal in key and text are treated alike, so a line that stays
    in one stays in all of them; a null key sorts first. Without ``empty``, rows that lose all
    their lines go. Other columns come back unchanged; where they have the names of the counts,
    these get underscores after theirs; an empty table stays empty.
    """
    gone = dropped_lines(docs, text, key, least_words)
    value = col(text).cast("string")
    rows = docs.select(
        F.struct("*").alias("__row"), col(key).cast("long").alias("__id"), F.xxhash64(value).alias("__mark")
    )
    gone = gone.select(F.col("id").alias("__own"), F.col("mark").alias("__hash"), "drops")
    match = F.col("__id").eqNullSafe(F.col("__own")) & (F.col("__mark") == F.col("__hash"))
    rows = rows.join(gone, match, "left")
    lines = F.split(F.col("__row")[text].cast("string"), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drops"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    cleaned = F.when(F.col("drops").isNull(), F.col("__row")[text].cast("string")).otherwise(kept)
    if not empty:
        rows = rows.filter(F.col("drops").isNull() | (F.size(stay) > 0))
    columns = [(cleaned if name == text else F.col("__row")[name]).alias(name) for name in docs.columns]
    if counts:
        own = [free_name(name, docs.columns) for name in ("n_lines", "n_dropped")]
        n_dropped = F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops"))
        columns += [
            F.when(F.col("__row")[text].isNull(), 0).otherwise(F.size(lines)).cast("long").alias(own[0]),
            n_dropped.cast("long").alias(own[1]),
        ]
    return rows.select(*columns)
