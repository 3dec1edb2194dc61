"""Table profiling. Each function is one pass over the columns it names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.functions import is_missing, named, require_columns
from tabml.operators.spec import FeatureSpec


def row_count(frame: DataFrame) -> DataFrame:
    return frame.agg(F.count("*").alias("n_rows"))


def preview(frame: DataFrame, order_by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-n, not a full sort)."""
    return frame.orderBy(*order_by).limit(n)


def filtered_count(frame: DataFrame, condition: Column) -> DataFrame:
    return frame.where(condition).agg(F.count("*").alias("n_rows"))


def global_aggregates(frame: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """Several whole-table aggregates in one job instead of one job each."""
    return frame.agg(*[column.alias(name) for name, column in aggregates.items()])


def _long(one_row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn one wide row into one row per struct."""
    return one_row.select(F.inline(F.array(*structs)))


def column_profile(frame: DataFrame, spec: FeatureSpec | None = None) -> DataFrame:
    """Position, name, type and role of each column with its missing and total count."""
    counted = frame.agg(
        F.count("*").alias("n_rows"),
        *[
            F.count_if(is_missing(frame, field.name)).alias(f"m{i}")
            for i, field in enumerate(frame.schema)
        ],
    )
    return _long(
        counted,
        [
            F.struct(
                F.lit(i).alias("pos"),
                F.lit(field.name).alias("name"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.lit(spec.role(field.name) if spec else None).cast("string").alias("role"),
                F.col(f"m{i}").alias("n_missing"),
                F.col("n_rows"),
            )
            for i, field in enumerate(frame.schema)
        ],
    )


def missing_counts(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows ``(column, n_missing)``; null and NaN both count as missing."""
    columns = list(columns or frame.columns)
    require_columns(frame, columns)
    counted = frame.agg(
        *[F.count_if(is_missing(frame, c)).alias(f"m{i}") for i, c in enumerate(columns)]
    )
    return _long(
        counted,
        [
            F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing"))
            for i, c in enumerate(columns)
        ],
    )


def describe(frame: DataFrame, columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Rows ``(column, stat, value, text_value)`` for count, mean, stddev, min and max.

    ``value`` holds numbers. Strings get a count, and their minimum and maximum in
    ``text_value``. A double cannot hold every long or decimal: ``exact`` adds ``exact_value``,
    the count, minimum and maximum as text of the column's own type.
    """
    columns = list(columns or frame.columns)
    require_columns(frame, columns)
    aggregates, structs = [], []
    for i, name in enumerate(columns):
        column = named(name)
        numeric = isinstance(frame.schema[name].dataType, T.NumericType)
        stats = {"count": F.count(column), "min": F.min(column), "max": F.max(column)}
        if numeric:
            stats |= {"mean": F.avg(column), "stddev": F.stddev_samp(column)}
        for stat in ("count", "mean", "stddev", "min", "max"):
            result = f"{stat}{i}"
            if stat in stats:
                aggregates.append(stats[stat].alias(result))
            is_number = stat in stats and (numeric or stat == "count")
            is_text = stat in stats and not is_number
            own = F.col(result) if stat in ("count", "min", "max") and stat in stats else F.lit(None)
            structs.append(
                F.struct(
                    F.lit(name).alias("column"),
                    F.lit(stat).alias("stat"),
                    *([own.cast("string").alias("exact_value")] if exact else []),
                    (F.col(result) if is_number else F.lit(None)).cast("double").alias("value"),
                    (F.col(result) if is_text else F.lit(None)).cast("string").alias("text_value"),
                )
            )
    return _long(frame.agg(*aggregates), structs)


def category_sizes(frame: DataFrame, column: str) -> DataFrame:
    """Rows per value; a missing value forms its own group."""
    return frame.groupBy(named(column)).agg(F.count("*").alias("count"))


def group_count_desc(frame: DataFrame, column: str) -> DataFrame:
    """Category sizes, largest first, ties by value."""
    return category_sizes(frame, column).orderBy(F.desc("count"), named(column))


def group_average(frame: DataFrame, by: str, value: str, name: str = "avg_value") -> DataFrame:
    return frame.groupBy(named(by)).agg(F.avg(named(value)).alias(name))


def sql_group_average(frame: DataFrame, by: str, value: str) -> DataFrame:
    """The same as :func:`group_average`, as a SQL statement."""
    return frame.sparkSession.sql(
        "SELECT {by}, avg({value}) AS avg_value FROM {rows} GROUP BY {by}",
        rows=frame,
        by=named(by),
        value=named(value),
    )


def frequency_table(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, value, freq)`` for many columns in one scan and one shuffle.

    The map side sums each value before the shuffle, so a value that fills a third
    of the table still sends one row per task.
    """
    require_columns(frame, columns)
    as_text = frame.select(*[named(c).cast("string").alias(c) for c in columns])
    return (
        as_text.unpivot([], [named(c) for c in columns], "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("freq"))
    )


def sorted_frequency_table(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """:func:`frequency_table` by column, the most frequent value first, ties by value."""
    order = [F.asc("column"), F.desc("freq"), F.asc_nulls_last("value")]
    return frequency_table(frame, columns).orderBy(*order)
