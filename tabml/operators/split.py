"""Repeatable train/test splits and cross-validation folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.functions import HASH_SPACE, hash_position, named, require_columns, row_text

FOLD_SALT = "fold:"


#: Copies of one row that a task makes at most.
COPIES = 100_000


def with_row_identity(frame: DataFrame, name: str = "row_id") -> DataFrame:
    """Add a text that tells every row from all others, for tables without a key.

    It is the MD5 of all columns and the row's number among equal rows, so it is the same for any
    layout of the files. Equal rows are counted before they are shuffled and made again from
    their count, at most ``COPIES`` to a task; which of them gets which number makes no
    difference. A column that cannot be grouped, such as a map, is an error.
    """
    if name in frame.columns:
        raise ValueError(f"there is a column {name} already")
    rows = frame.select(F.struct(*[named(c) for c in frame.columns]).alias("_row"), F.md5(row_text(frame)).alias("_digest"))
    counted = rows.groupBy("_row", "_digest").agg(F.count("*").alias("_copies"))
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPIES)))
    dealt = counted.withColumn("_chunk", chunks)
    # Only rows with many copies are many chunks; they go to many tasks.
    dealt = dealt.repartition(F.xxhash64("_digest", "_chunk"))
    first = F.col("_chunk") * COPIES
    copies = F.explode(F.sequence(first + 1, F.least(first + COPIES, F.col("_copies"))))
    return dealt.select("_row", "_digest", copies.alias("_number")).select(
        "_row.*", F.concat_ws("-", "_digest", F.col("_number").cast("string")).alias(name)
    )


def _position(frame: DataFrame, key: str, salt: str = "") -> Column:
    """A key's hash position; a row without key goes by all its other columns."""
    require_columns(frame, [key])
    other = F.concat(F.lit("\\0"), F.md5(row_text(frame, leave_out=[key])))
    return hash_position(F.coalesce(named(key).cast("string"), other), salt)


def in_train(frame: DataFrame, key: str, fraction: float) -> Column:
    return _position(frame, key) < int(fraction * HASH_SPACE)


def split_column(frame: DataFrame, key: str, fraction: float = 0.8) -> DataFrame:
    """Add ``split``, 'train' or 'test', fixed by the key alone.

    The same row lands on the same side on every run, cluster and layout, and all
    rows of one key land together. Rows without a key are split by their other columns.
    """
    side = F.when(in_train(frame, key, fraction), "train").otherwise("test")
    return frame.withColumn("split", side)


def train_test_split(
    frame: DataFrame, key: str | None, fraction: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """Two filters on the key hash: no sort, no shuffle.

    Without a key every row is split on its own, equal ones too, by :func:`with_row_identity`,
    which counts equal rows in one shuffle.
    """
    if key is None:
        train, test = train_test_split(with_row_identity(frame, "_row_id"), "_row_id", fraction)
        return train.drop("_row_id"), test.drop("_row_id")
    train = in_train(frame, key, fraction)
    return frame.where(train), frame.where(~train)


def random_split(
    frame: DataFrame, fraction: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """For tables without a key. Repeats only while the input keeps its partitions."""
    train, test = frame.randomSplit([fraction, 1 - fraction], seed)
    return train, test


def fold_column(frame: DataFrame, key: str, folds: int = 3) -> DataFrame:
    """Add ``fold`` in ``[0, folds)``, independent of :func:`split_column`."""
    position = _position(frame, key, FOLD_SALT)
    return frame.withColumn("fold", (position % folds).cast("int"))
