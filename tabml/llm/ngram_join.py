"""Jaccard join on word shingles with adaptive multi-match prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabml.llm.common import arrow_map, col, semi_join
from tabml.llm.components import components
from tabml.sources.staging import stage

#: Shared prefix tokens that a pair may have to show at most.
MOST_MATCHES = 4
#: Cells of the frequency sketch, and its pieces on the way to the driver.
CELLS, SLICES = 2**20, 64
#: Cost of verifying a pair, in looked-up postings.
VERIFY_COST = 40.0
#: Partners that a turn of the first step gives a set, and its turns. The second step, which
#: takes all pairs that are left, has no such bound.
PARTNERS, SAMPLED = 8, 1
#: Words whose hashes a worker remembers.
REMEMBERED = 100_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(31)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _SHIFT)) * _M2
    return values ^ (values >> _SHIFT)


class Shingler:
    """Hashed shingle sets of texts."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        """The sorted distinct shingle hashes; words end at ASCII white space, A-Z count as a-z."""
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        missing = set(words).difference(known)
        if len(known) + len(missing) > REMEMBERED:
            known.clear()
            missing = set(words)
        for word in missing:
            known[word] = xxhash.xxh3_64_intdigest(word)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(codes))
        count = len(codes) - size + 1
        # A short sequence gets its length mixed in, so it equals no other length's shingle.
        shingles = np.full(count, size, np.uint64)
        for place in range(size):
            shingles = shingles * _M1 + codes[place : place + count]
            shingles ^= shingles >> _SHIFT
        return np.unique(_mixed(shingles))


def _node(shingles: np.ndarray) -> int:
    """Names a shingle set: equal sets, equal names. Signed, for Spark."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(44)).astype(np.int64)


def bitmap(shingles: np.ndarray) -> bytes:
    """One bit for each of about twice as many cells as there are shingles."""
    cells = min(2**17, max(256, 1 << int(2 * len(shingles) - 1).bit_length()))
    bits = np.zeros(cells, np.uint8)
    bits[(shingles & np.uint64(cells - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def least_difference(left: bytes, right: bytes) -> int:
    """At least so many shingles are in one of both sets only: bits that differ."""
    one, two = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    while len(one) > len(two):
        one = one[: len(one) // 2] | one[len(one) // 2 :]
    while len(two) > len(one):
        two = two[: len(two) // 2] | two[len(two) // 2 :]
    return int(np.bitwise_count(one ^ two).sum())


_SETS = pa.schema(
    [
        ("id", pa.int64()),
        ("node", pa.int64()),
        ("n", pa.int64()),
        ("bits", pa.binary()),
        ("slice", pa.int32()),
        ("counts", pa.binary()),
    ]
)
_SETS_DDL = "id long, node long, n long, bits binary, slice int, counts binary"


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """Per row its set's name, size and bitmap; per task its share of the frequency sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(words), np.zeros(CELLS, np.int32)
        for rows in batches:
            nodes, sizes, maps = [], [], []
            for text in rows["text"].to_pylist():
                shingles = shingler(text)
                np.add.at(counts, _cell(shingles), 1)
                nodes.append(_node(shingles) if len(shingles) else None)
                sizes.append(len(shingles))
                maps.append(bitmap(shingles) if len(shingles) else None)
            empty = pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    rows["id"],
                    pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(maps, pa.binary()),
                    *empty,
                ],
                schema=_SETS,
            )
        parts = [p.tobytes() for p in np.split(counts, SLICES)] if counts.any() else []
        nothing = [pa.nulls(len(parts), pa.int64())] * 3 + [pa.nulls(len(parts), pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [*nothing, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], schema=_SETS
        )

    return arrow_map(docs, run, _SETS_DDL)


def _sketch(sets: DataFrame) -> np.ndarray:
    """Sum of the tasks' sketches: a fixed number of cells, whatever the input."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for number, data in zip(rows["slice"].to_pylist(), rows["counts"].to_pylist(), strict=True):
                part = np.frombuffer(data, np.int32).astype(np.int64)
                sums[number] = sums[number] + part if number in sums else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
            names=["slice", "counts"],
        )

    parts = sets.filter("slice is not null").select("slice", "counts").repartition("slice")
    cells = np.zeros((SLICES, CELLS // SLICES), np.int64)
    for number, data in arrow_map(parts, add, "slice int, counts binary").collect():
        cells[number] += np.frombuffer(data, np.int64)
    return cells.reshape(-1)


_PREFIX = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("place", pa.int32()), ("matches", pa.int32())])
_PREFIX_DDL = "token long, node long, n int, place int, matches int"


def matches_wanted(frequency: np.ndarray, least: int) -> int:
    """How many prefix tokens a document asks its partners to share: the cheapest number.

    ``frequency`` estimates, in the global order, how many sets hold each token; ``least`` is
    the smallest overlap of a link. A longer prefix costs look-ups, but of its postings only
    a share of about one in that number becomes a pair to verify.
    """
    base = len(frequency) - least
    running = np.cumsum(frequency)
    best, cost = 1, None
    for wanted in range(1, min(MOST_MATCHES, least) + 1):
        postings = float(running[base + wanted - 1])
        now = postings + VERIFY_COST * (postings - base - wanted) / wanted**2
        if cost is None or now < cost:
            best, cost = wanted, now
    return best


def _prefixes(docs: DataFrame, words: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """The prefix tokens of every distinct set, at most once for each task."""
    # What a cell holds by chance is not a token's frequency.
    typical = float(np.median(sketch))
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, cells, seen = Shingler(words), shared.value, set()
        for rows in batches:
            out: list[tuple] = []
            for text in rows["text"].to_pylist():
                shingles = shingler(text)
                if not len(shingles) or (node := _node(shingles)) in seen:
                    continue
                seen.add(node)
                counts = cells[_cell(shingles)]
                order = np.lexsort((shingles, counts))
                n = len(shingles)
                least = -(-percent * n // 100)
                frequency = np.maximum(counts[order] - typical, 0) + 1
                wanted = matches_wanted(frequency, least)
                tokens = shingles[order[: n - least + wanted]].astype(np.int64)
                out.append((tokens, node, n, wanted))
            sizes = [len(t) for t, *_ in out]
            total = sum(sizes)
            arrays = [
                np.concatenate([t for t, *_ in out]) if out else np.empty(0, np.int64),
                np.repeat(np.array([x[1] for x in out], np.int64), sizes),
                np.repeat(np.array([x[2] for x in out], np.int32), sizes),
                np.concatenate([np.arange(s, dtype=np.int32) for s in sizes]) if out else np.empty(0, np.int32),
                np.repeat(np.array([x[3] for x in out], np.int32), sizes),
            ]
            for first in range(0, total, 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(a[first : first + 100_000]) for a in arrays], schema=_PREFIX)

    return arrow_map(docs.select("text"), run, _PREFIX_DDL)


def _shared_prefixes(prefixes: DataFrame) -> DataFrame:
    """Prefix rows whose token another set has in its prefix as well, with the token's first set.

    The order of a token's sets is its own, so that a set meets different ones at its tokens.
    """
    window = Window.partitionBy("token").orderBy(F.xxhash64("token", "node"), "node")
    first = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = [F.first(name).over(first).alias(f"head_{name}") for name in ("node", "n", "place", "matches")]
    rows = prefixes.select(
        "*",
        *heads,
        F.lag("node").over(window).alias("before"),
        F.lead("node").over(window).alias("after"),
    )
    # The same set from another task is one set.
    once = rows.filter("before is null or before != node")
    return once.filter("head_node != node or after is not null").drop("before", "after")


def _close(left: str, right: str, percent: int) -> str:
    """Sizes that a link allows."""
    return f"100L * least({left}, {right}) >= {percent}L * greatest({left}, {right})"


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs that share as many prefix tokens as the less demanding of both asks for.

    ``rows``: token by token, two sets with size, place of the token and matches wanted. A
    token counts if it lies in both prefixes of that common length.
    """
    wanted = F.least("a_matches", "b_matches")

    def inside(side: str) -> object:
        return F.expr(f"{side}_place < {side}_n - ({percent}L * {side}_n + 99) div 100") | (
            F.expr(f"{side}_place - {side}_n + ({percent}L * {side}_n + 99) div 100") < wanted
        )

    kept = rows.filter(F.expr(_close("a_n", "b_n", percent))).filter(inside("a") & inside("b"))
    counted = kept.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max(wanted).alias("wanted"))
    return counted.filter("shared >= wanted").select("a", "b")


def _some_partners(rows: DataFrame, percent: int) -> DataFrame:
    """For each set ``b`` up to ``PARTNERS`` of its tokens' first sets, most shared tokens first."""
    close = rows.filter(F.expr(_close("a_n", "b_n", percent)))
    counted = close.groupBy("a", "b").agg(F.count("*").alias("shared"))
    ranked = F.struct(-F.col("shared"), F.xxhash64("a", "b"), F.col("a").alias("a"))
    best = counted.groupBy("b").agg(F.slice(F.array_sort(F.collect_list(ranked)), 1, PARTNERS).alias("best"))
    pairs = best.select(F.explode("best.a").alias("a"), "b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps do not already show too many different shingles."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    maps = semi_join(sets, nodes, "node").groupBy("node")
    maps = stage(maps.agg(F.first("n").alias("n"), F.first("bits").alias("bits")), "bitmaps")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sizes = zip(rows["x_n"].to_pylist(), rows["y_n"].to_pylist(), strict=True)
            maps = zip(rows["x"].to_pylist(), rows["y"].to_pylist(), strict=True)
            keep = pa.array(
                [
                    (100 + percent) * least_difference(x, y) <= (100 - percent) * (n + m)
                    for (n, m), (x, y) in zip(sizes, maps, strict=True)
                ],
                pa.bool_(),
            )
            yield pa.RecordBatch.from_arrays([rows["a"].filter(keep), rows["b"].filter(keep)], schema=_LINKS)

    rows = pairs
    for own, name in (("b", "y"), ("a", "x")):
        side = maps.select(F.col("node").alias(own), F.col("n").alias(f"{name}_n"), F.col("bits").alias(name))
        rows = rows.join(side, own)
    found = arrow_map(rows.select("a", "b", "x_n", "y_n", "x", "y"), compare, "a long, b long")
    return stage(found, "possible")


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the similarity. ``pairs`` is a written table.

    Bitmaps, which only ever rule out what is no link, leave few pairs for whole sets.
    """
    pairs = _possible(pairs, sets, percent)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    known = semi_join(sets.select("node", "id"), nodes, "node").groupBy("node").agg(F.min("id").alias("id"))
    known = stage(known, "known")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(words), set()
        for rows in batches:
            out = {}
            for text in rows["text"].to_pylist():
                shingles = shingler(text)
                if len(shingles) and (node := _node(shingles)) not in seen:
                    seen.add(node)
                    # 48 bits tell apart the shingles of two documents.
                    out[node] = (shingles >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.int64()), pa.array(list(out.values()), pa.binary())], names=["node", "shingles"]
            )

    wanted = semi_join(docs, known.filter("id is not null"), "id").select("id", "text")
    if not known.filter("id is null").isEmpty():
        wanted = wanted.union(docs.filter("id is null").select("id", "text"))
    found = arrow_map(wanted, run, "node long, shingles binary")
    found = stage(semi_join(found, nodes, "node").groupBy("node").agg(F.first("shingles").alias("shingles")), "shingles")

    def whole(data: bytes) -> np.ndarray:
        out = np.zeros((len(data) // 6, 8), np.uint8)
        out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
        return out.view(np.uint64).reshape(-1)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            same = []
            for left, right in zip(rows["x"].to_pylist(), rows["y"].to_pylist(), strict=True):
                one, two = whole(left), whole(right)
                both = len(np.intersect1d(one, two, assume_unique=True))
                same.append(100 * both >= percent * (len(one) + len(two) - both))
            keep = pa.array(same, pa.bool_())
            yield pa.RecordBatch.from_arrays([rows["a"].filter(keep), rows["b"].filter(keep)], schema=_LINKS)

    rows = pairs.join(found.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    rows = rows.join(found.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    return stage(arrow_map(rows.select("a", "b", "x", "y"), compare, "a long, b long"), "links-found")


_OWN = ("node", "n", "place", "matches")


def _side(prefix: str, name: str) -> list:
    """A set's columns under the names of one side of a pair."""
    return [F.col(prefix + c).alias(name if c == "node" else f"{name}_{c}") for c in _OWN]


def _open_rows(rows: DataFrame, groups: DataFrame, turn: int) -> DataFrame:
    """Rows of tokens whose sets are still in several groups, each with a set of another group
    that comes first in the order of this turn, if any does."""
    members = rows.select("token", *_OWN).join(groups, "node", "left")
    members = members.withColumn("label", F.coalesce("label", "node"))
    spread = members.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    members = members.join(spread.filter("low != high").select("token"), "token", "left_semi")
    order = Window.partitionBy("token").orderBy(F.xxhash64("token", "node", F.lit(turn)), "node")
    first = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = [*_OWN, "label"]
    found = members.select("token", *names, *[F.first(c).over(first).alias(f"head_{c}") for c in names])
    # A set of the first one's group has nothing to gain from it.
    same = F.col("head_label") == F.col("label")
    return found.withColumn("head_node", F.when(same, F.col("node")).otherwise(F.col("head_node")))


def jaccard_components(
    docs: DataFrame,
    words: int = 5,
    percent: int = 75,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key, n_shingles, component_id`` for every row: groups linked by Jaccard similarity.

    Two rows link when ``100 * |A and B| >= percent * |A or B|`` for their sets of distinct
    ``words``-word shingles (fewer words: the whole sequence). Rows of the same set are one
    node, however many they are. Tokens are ordered by a sketch of their frequency over all
    rows; any order gives the same links. Each set takes the prefix that its estimated cost
    makes cheapest: ``n - ceil(percent * n / 100) + l`` tokens, of which a partner must share
    ``l``; two sets with different ``l`` go by the smaller one, which no link can miss.

    Links are sought in two steps so that a group of near copies is not spelled out as pairs:
    first, in a few turns, every set against some that come first for one of its tokens, then
    all pairs that are still in different groups. Both steps verify whole sets.

    Null text counts as empty; rows without words have 0 shingles and their own key as group.
    Rows with a null key take part, a group's id is its smallest key that is not null. Equal
    rows come back as often as they are there; extra columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(
        col(key).cast("long").alias("id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text")
    )
    sets = stage(_sets(rows, words), "sets")
    prefixes = _prefixes(rows, words, percent, _sketch(sets))
    shared = stage(_shared_prefixes(prefixes), "prefixes")

    named = sets.filter("slice is null").drop("slice", "counts")

    links, groups, open_rows = None, None, shared
    for turn in range(SAMPLED):
        first = open_rows.filter("head_node != node").select(*_side("head_", "a"), *_side("", "b"))
        found = _verified(stage(_some_partners(first, percent), "pairs"), rows, named, words, percent)
        links = found if links is None else links.union(found)
        groups = components(links, "a", "b")
        open_rows = stage(_open_rows(open_rows, groups, turn), "open")

    left = open_rows.select("token", F.col("label").alias("a_label"), *_side("", "a"))
    right = open_rows.select("token", F.col("label").alias("b_label"), *_side("", "b"))
    across = left.join(right, "token").filter("a < b and a_label != b_label")
    more = _verified(stage(_pairs(across, percent), "pairs"), rows, named, words, percent)
    if not more.isEmpty():
        groups = components(links.union(more), "a", "b")

    named = named.drop("bits")
    nodes = named.filter("node is not null").groupBy("node").agg(F.min("id").alias("id"))
    nodes = nodes.join(groups, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = nodes.groupBy("label").agg(F.min("id").alias("component_id"))
    mapping = nodes.join(smallest, "label").select("node", "component_id")
    return named.join(mapping, "node", "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
