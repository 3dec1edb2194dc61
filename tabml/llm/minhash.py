"""Near duplicates by HyperMinHash registers, bands of registers, estimates and whole sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import arrow_map, col, semi_join
from tabml.llm.components import components
from tabml.llm.ngram_join import Shingler
from tabml.llm.streamed import matching_pairs
from tabml.sources.staging import stage

#: Registers of a set, a power of two, and mantissa bits beside a register's leading zeros.
BUCKETS, MANTISSA = 512, 10
#: Registers of a band, and bands. Sets of similarity 0.8 share none once in 10^10 times.
BAND, BANDS = 4, 44
#: Standard errors by which an estimate may miss the similarity of a link.
ERRORS = 4.5
#: Sets of a block; a bucket of more is compared block by block.
BLOCK = 1024

_BUCKET_BITS = BUCKETS.bit_length() - 1


def registers(shingles: np.ndarray) -> np.ndarray:
    """A code for each bucket, 0 where no shingle falls into it.

    A shingle's first bits choose its bucket. Of the bucket's smallest remainder the number of
    leading zeros is kept and the ``MANTISSA`` bits after the first one. ``shingles`` is sorted,
    so a bucket's first is its smallest.
    """
    bucket = (shingles >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = shingles[first] << np.uint64(_BUCKET_BITS)
    # The exponent of the 53 bits that a float holds exactly.
    zeros = (53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]).astype(np.uint64)
    mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = np.zeros(BUCKETS, np.uint16)
    out[bucket[first]] = (zeros << np.uint64(MANTISSA)) + mantissa + np.uint64(1)
    return out


def pack(codes: np.ndarray) -> bytes:
    """Which registers have a code, then the codes."""
    return np.packbits(codes != 0).tobytes() + codes[codes != 0].tobytes()


def unpack(data: bytes) -> np.ndarray:
    codes = np.zeros(BUCKETS, np.uint16)
    has = np.unpackbits(np.frombuffer(data, np.uint8, BUCKETS // 8)).view(bool)
    codes[has] = np.frombuffer(data, np.uint16, offset=BUCKETS // 8)
    return codes


def _orders() -> np.ndarray:
    """For each banded register an order of all registers: an empty one takes the code of the first that has one."""
    rng = np.random.default_rng(20)
    return np.argsort(rng.random((BAND * BANDS, BUCKETS)), axis=1).astype(np.int16)


_ORDERS = _orders()
#: Registers of an order that are looked at before all of them.
_LOOKED = 12
_BANDED = np.random.default_rng(21).permutation(BUCKETS)[: BAND * BANDS]


def band_keys(codes: np.ndarray) -> np.ndarray:
    """A key for each band: its number above 57 bits of a hash of its registers.

    The order by which empty registers borrow is the same for all sets, so two sets agree in a
    borrowed register with the probability of their similarity as well.
    """
    chosen = codes[_BANDED]
    empty = np.flatnonzero(chosen == 0)
    if len(empty):
        borrowed = codes[_ORDERS[empty, :_LOOKED]]
        borrowed = borrowed[np.arange(len(empty)), (borrowed != 0).argmax(axis=1)]
        still = np.flatnonzero(borrowed == 0)
        if len(still):
            whole = codes[_ORDERS[empty[still]]]
            borrowed[still] = whole[np.arange(len(still)), (whole != 0).argmax(axis=1)]
        chosen[empty] = borrowed
    packed = np.ascontiguousarray(chosen).view(np.uint64)
    packed = (packed ^ (packed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    packed = (packed ^ (packed >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (packed ^ (packed >> np.uint64(32))) >> np.uint64(7)
    return (mixed | (np.arange(BANDS, dtype=np.uint64) << np.uint64(57))).astype(np.int64)


_LOADS = np.geomspace(1e-4, 1e9, 4000)
_AGREE = sum(
    2.0 ** -(z + 1 + MANTISSA) * (np.exp(-_LOADS * 2.0 ** -(z + 1)) - np.exp(-_LOADS * 2.0**-z)) for z in range(54)
)


def collisions(n: int, m: np.ndarray) -> np.ndarray:
    """How often two different smallest remainders have one code, for sets of ``n`` and ``m``.

    A bucket's smallest of about ``n / BUCKETS`` remainders is exponential; the integral over
    the codes of the product of both densities and a code's width has a closed form for each
    number of leading zeros. The sum over these is looked up by the load of both sets.
    """
    one, two = n / BUCKETS, np.asarray(m) / BUCKETS
    both = one + two
    # Given that both buckets have a shingle.
    present = np.expm1(-one) * np.expm1(-two)
    return np.minimum(1.0, np.interp(both, _LOADS, _AGREE) * one * two / both / present)


def estimates(codes: np.ndarray, n: int, others: np.ndarray, sizes: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of one set and several, and how far below a link's may be estimated.

    The share of equal codes among the registers that either set has, less the expected
    collisions. The registers are a sample without repetition of the union, whose size for a
    link follows from both sizes; small sets are thus estimated almost exactly.
    """
    has, have = codes != 0, others != 0
    equal = ((others == codes) & has).sum(axis=1)
    both = (have & has).sum(axis=1)
    either = (have | has).sum(axis=1)
    expected = collisions(n, sizes) * (both - equal)
    similarity = np.maximum(0.0, equal - expected) / np.maximum(either, 1)
    union = np.maximum((n + sizes) / (1 + least), either)
    error = np.sqrt(least * (1 - least) / np.maximum(either, 1) * (1 - either / union) + 1e-9)
    return similarity, ERRORS * error + 1.0 / np.maximum(either, 1)


# --- tables ------------------------------------------------------------------------------

_SETS = pa.schema([("id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])


def _node(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """``id, node, n, data`` for each row: its set's name, size and registers.

    A task gives a set's registers with the first row that has it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(words), set()
        for rows in batches:
            nodes, sizes, data = [], [], []
            for text in rows["text"].to_pylist():
                shingles = shingler(text)
                node = _node(shingles) if len(shingles) else None
                nodes.append(node)
                sizes.append(len(shingles))
                data.append(None if node is None or node in seen else pack(registers(shingles)))
                seen.add(node)
            arrays = [rows["id"], pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema=_SETS)

    return arrow_map(docs, run, "id long, node long, n long, data binary")


def _bands(sets: DataFrame) -> DataFrame:
    """``key, node``: a set's bands, at most once for each task of the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keys = [band_keys(unpack(data)) for data in rows["data"].to_pylist()]
            nodes = np.repeat(rows["node"].to_numpy(), BANDS)
            whole = np.concatenate(keys) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(whole, pa.int64()), pa.array(nodes, pa.int64())], names=["key", "node"])

    return arrow_map(sets.filter("data is not null").select("node", "data"), run, "key long, node long")


def _open(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    """``key, node, label``: the rows of buckets whose sets are in more than one group."""
    if groups is not None:
        rows = rows.select("key", "node").join(groups, "node", "left")
    else:
        rows = rows.select("key", "node", F.lit(None).cast("long").alias("label"))
    rows = rows.withColumn("label", F.coalesce("label", "node"))
    ends = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    keys = ends.filter("low != high").select("key")
    return rows.join(keys, "key", "left_semi").select("key", "node", "label").distinct()


def _partners(rows: DataFrame, turn: int) -> DataFrame:
    """One pair ``a, b`` for each set ``b``: of its buckets' first sets in other groups the most frequent."""
    rank = F.xxhash64("node", F.lit(turn))
    heads = rows.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), "node", "label")).alias("head"))
    met = rows.join(heads, "key").filter("head.label != label")
    counted = met.groupBy("node", F.col("head.node").alias("a")).agg(F.count("*").alias("shared"))
    best = counted.groupBy("node").agg(F.max(F.struct("shared", "a")).alias("best"))
    pairs = best.select(F.least("best.a", "node").alias("a"), F.greatest("best.a", "node").alias("b"))
    return pairs.distinct()


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows with the block pair ``i, j`` they are compared in and their own block ``own``."""
    counts = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rows = rows.join(counts, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.withColumn("other", other)
    return rows.select("key", "node", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def _root(parent: dict[int, int], x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


class _Bucket:
    """The sets of one bucket, or of two of its blocks."""

    def __init__(self, key: int):
        self.band = (key >> 57) & (2**7 - 1)
        self.nodes: list[int] = []
        self.labels: list[int] = []
        self.own: list[int] = []
        self.sizes: list[int] = []
        self.data: list[bytes] = []

    def candidates(self, within: bool, least: float, take: str) -> list[tuple[int, int]]:
        """Pairs of different groups that may be links, each only in the first band it shares.

        ``take``: of these "forest" gives the most similar ones that connect all that can be
        connected, "rest" gives all but those whose ends pairs connect that are links by more
        than the error, and "all" gives all.
        """
        if not self.nodes:
            return []
        nodes, labels, own = (np.array(x, np.int64) for x in (self.nodes, self.labels, self.own))
        if labels.min() == labels.max():
            return []
        sizes = np.array(self.sizes, np.int64)
        codes = np.array([unpack(d) for d in self.data])
        keys = np.array([band_keys(c) for c in codes])[:, : self.band]
        found: list[tuple[float, int, int]] = []
        for at in range(len(nodes) - 1):
            rest = np.arange(at + 1, len(nodes))
            use = labels[rest] != labels[at]
            if not within:
                use &= own[rest] != own[at]
            use &= np.minimum(sizes[rest], sizes[at]) >= least * np.maximum(sizes[rest], sizes[at])
            rest = rest[use]
            rest = rest[~(keys[rest] == keys[at]).any(axis=1)]
            if not len(rest):
                continue
            similarity, error = estimates(codes[at], int(sizes[at]), codes[rest], sizes[rest], least)
            for k in np.flatnonzero(similarity >= least - error):
                found.append((float(similarity[k]), bool(similarity[k] >= least + error[k]), at, int(rest[k])))
        # Sure links first, as others cannot be left out before these are known.
        found.sort(key=lambda x: (not x[1], -x[0]))
        parent: dict[int, int] = {}
        pairs = []
        for _, sure, x, y in found:
            if take != "all":
                one, two = _root(parent, int(labels[x])), _root(parent, int(labels[y]))
                if one == two:
                    continue
                if sure or take == "forest":
                    parent[one] = two
            pairs.append((int(nodes[x]), int(nodes[y])))
        return pairs


def _across(rows: DataFrame, payloads: DataFrame, least: float, take: str) -> DataFrame:
    """Pairs of sets of different groups that may be links by their registers."""
    sent = _blocks(rows).join(payloads, "node")
    sent = sent.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, bucket = None, None
        out: list[tuple[int, int]] = []

        def batch() -> pa.RecordBatch:
            arrays = [pa.array([min(p) for p in out], pa.int64()), pa.array([max(p) for p in out], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

        for rows in batches:
            names = ("key", "i", "j", "node", "label", "own", "n", "data")
            for key, i, j, node, label, own, n, data in zip(*(rows[c].to_pylist() for c in names), strict=True):
                if at != (key, i, j):
                    if bucket is not None:
                        out += bucket.candidates(at[1] == at[2], least, take)
                    at, bucket = (key, i, j), _Bucket(key)
                bucket.nodes.append(node)
                bucket.labels.append(label)
                bucket.own.append(own)
                bucket.sizes.append(n)
                bucket.data.append(data)
            if len(out) > 50_000:
                yield batch()
                out.clear()
        if bucket is not None:
            out += bucket.candidates(at[1] == at[2], least, take)
        yield batch()

    columns = sent.select("key", "i", "j", "node", "label", "own", "n", "data")
    return arrow_map(columns, run, "a long, b long").distinct()


def _whole_sets(pairs: DataFrame, docs: DataFrame, sets: DataFrame, words: int) -> DataFrame:
    """``node, n, data``: the whole shingle sets, 64 bits each, of the nodes of ``pairs``."""
    nodes = stage(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "nodes")
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
                    out[node] = shingles.tobytes()
            sizes = pa.array([len(d) // 8 for d in out.values()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.int64()), sizes, pa.array(list(out.values()), pa.binary())], names=["node", "n", "data"]
            )

    wanted = semi_join(docs, known.filter("id is not null"), "id").select("id", "text")
    if not known.filter("id is null").isEmpty():
        wanted = wanted.union(docs.filter("id is null").select("id", "text"))
    found = semi_join(arrow_map(wanted, run, "node long, n long, data binary"), nodes, "node")
    return stage(found.dropDuplicates(["node"]), "whole-sets")


def near_duplicates(
    docs: DataFrame, words: int = 4, percent: int = 80, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row: groups of near copies.

    Rows link when ``100 * |A and B| >= percent * |A or B|`` for their sets of distinct
    ``words``-word shingles (fewer words: the whole sequence). Equal sets are one node, however
    many rows have them. A node's shingles fall into ``BUCKETS`` registers, each a count of
    leading zeros and a mantissa; ``BANDS`` bands of ``BAND`` registers bring nodes together.
    First every node meets the one that comes first in its buckets. Then nodes that share a
    bucket with one of another group are compared by their registers, in blocks of at most
    ``BLOCK``, so no bucket needs to fit a task: the most similar pairs that would connect a
    bucket come first, all other ones after these are known. What the collision-corrected
    estimate, less ``ERRORS`` standard errors, does not rule out is decided on the whole sets. A
    pair of similarity 0.8 shares no band about once in 10^10 times.

    Null text counts as empty; rows without words have 0 shingles and stand alone. A group's id
    is its smallest key that is not null, and ``kept`` says that a row has it; rows with a null
    key take part and are not kept. Equal rows come back as often as they are there, extra
    columns are ignored, an empty table has no rows. Texts of any length are read whole.
    """
    least = percent / 100
    rows = docs.select(
        col(key).cast("long").alias("id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text")
    )
    sets = stage(_sets(rows, words), "register-sets")
    bands = stage(_open(_bands(sets), None).drop("label"), "bands")
    payloads = semi_join(sets.filter("data is not null").select("node", "n", "data"), bands, "node")
    payloads = stage(payloads.dropDuplicates(["node"]), "registers")

    def may_link(one: tuple, two: tuple) -> bool:
        (n, codes), (m, others) = one, two
        if min(n, m) < least * max(n, m):
            return False
        similarity, error = estimates(codes, n, others[None], np.array([m]), least)
        return bool(similarity[0] >= least - error[0])

    def is_link(one: np.ndarray, two: np.ndarray) -> bool:
        both = len(np.intersect1d(one, two, assume_unique=True))
        return 100 * both >= percent * (len(one) + len(two) - both)

    def verified(pairs: DataFrame) -> DataFrame:
        whole = _whole_sets(pairs, rows, sets, words)
        return stage(matching_pairs(pairs, whole, lambda n, d: np.frombuffer(d, np.uint64), is_link), "links-found")

    links, groups, rest = None, None, bands
    # The last turn is for pairs that the one before left out as connected by what is no link.
    for turn, take in enumerate(("heads", "forest", "rest", "all")):
        rest = stage(_open(rest, groups), "open")
        if rest.isEmpty():
            break
        if take == "heads":
            pairs = stage(_partners(rest, turn), "partners")
            pairs = stage(matching_pairs(pairs, payloads, lambda n, d: (n, unpack(d)), may_link), "pairs")
        else:
            pairs = stage(_across(rest, payloads, least, take), "across")
        found = verified(pairs)
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            groups = components(links, "a", "b")
        if take == "rest" and not _broken(pairs, found, payloads, least):
            break

    named = sets.drop("data")
    if groups is None:
        groups = sets.sparkSession.createDataFrame([], "node long, label long")
    nodes = named.filter("node is not null").groupBy("node").agg(F.min("id").alias("id"))
    nodes = nodes.join(groups, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = nodes.groupBy("label").agg(F.min("id").alias("component_id"))
    mapping = nodes.join(smallest, "label").select("node", "component_id")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return named.join(mapping, "node", "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _broken(pairs: DataFrame, links: DataFrame, payloads: DataFrame, least: float) -> bool:
    """Whether a pair that counted as a sure link by its registers is none."""

    def sure(one: tuple, two: tuple) -> bool:
        (n, codes), (m, others) = one, two
        similarity, error = estimates(codes, n, others[None], np.array([m]), least)
        return bool(similarity[0] >= least + error[0])

    failed = stage(pairs.join(links, ["a", "b"], "left_anti"), "failed")
    return not matching_pairs(failed, payloads, lambda n, d: (n, unpack(d)), sure).isEmpty()
