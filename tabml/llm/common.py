"""Helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Collection, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of one Arrow batch; long texts then make batches of few rows.
BATCH_BYTES = 16 * 1024 * 1024
#: Keys that a checked broadcast may hold (8 bytes each).
BROADCAST_KEYS = 1_000_000


def col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches in bytes and in rows.

    These are session settings of Spark's, as it has none per call; they change how many rows
    travel together, never a result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def give_back() -> None:
    """Return what a task has freed to the machine.

    Workers live on for later tasks, and the memory of a task's peak would stay theirs.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        return  # Another C library, which has no such call.


def arrow_map(
    frame: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` with bounded batches, whose workers give memory back after each task."""
    bound_batches(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return frame.mapInArrow(run, schema)


def free_name(wanted: str, taken: Collection[str]) -> str:
    """``wanted``, or with as many underscores after it as make it a new name."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def semi_join(frame: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``frame`` whose ``on`` is in ``keys`` (``left_anti``: is not).

    Up to ``BROADCAST_KEYS`` distinct keys, counted first, go to every executor; more are
    joined by a shuffle. The rows are the same either way.
    """
    keys = keys.select(on).distinct()
    if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return frame.join(keys, on, how)
