"""Comparing pairs of rows by their payloads without putting two payloads in every pair.

A pair's first side is sent once to the task that gets the pair, not once for each partner; a
side with very many partners is dealt out in slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import arrow_map

#: Partners that one copy of a payload serves.
SLICE_ROWS = 2000


def matching_pairs(
    pairs: DataFrame,
    payloads: DataFrame,
    unpack: Callable[[int, bytes], object],
    accept: Callable[[object, object], bool],
) -> DataFrame:
    """The ``a, b`` of ``pairs`` that ``accept(unpack(a's), unpack(b's))`` takes.

    ``payloads`` has one row ``node, n, data`` for every node of a pair. Both tables should be
    written ones, as they are read twice. Pairs whose payload is missing are left out.
    """
    slices = F.greatest(F.lit(1), F.ceil(F.col("partners") / SLICE_ROWS))
    counts = pairs.groupBy("a").agg(F.count("*").alias("partners"))
    dealt = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), slices).alias("slice"))
    members = dealt.join(payloads.withColumnRenamed("node", "b"), "b").select("a", "slice", "b", "n", "data")
    heads = counts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)).alias("slice"))
    heads = heads.join(payloads.withColumnRenamed("node", "a"), "a")
    heads = heads.select("a", "slice", F.lit(None).cast("long").alias("b"), "n", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, head = None, None
        for rows in batches:
            left, right = [], []
            columns = (rows[name].to_pylist() for name in ("a", "slice", "b", "n", "data"))
            for a, part, b, n, data in zip(*columns, strict=True):
                if b is None:
                    at, head = (a, part), unpack(n, data)
                elif at == (a, part) and accept(head, unpack(n, data)):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    spread = heads.unionByName(members).repartition("a", "slice")
    return arrow_map(spread.sortWithinPartitions("a", "slice", F.asc_nulls_first("b")), run, "a long, b long")
