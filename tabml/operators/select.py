"""Scores of single predictors against a label, and what to keep by them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions import is_missing, require_columns

_STEPS, _EPSILON, _TINY = 10_000, 1e-15, 1e-300


# --- tails -------------------------------------------------------------------------------


def _continued(terms, start: float) -> float:
    """A continued fraction by the modified Lentz method; ``terms`` yields (numerator, denominator)."""
    value = start if start else _TINY
    upper, lower = value, 0.0
    for numerator, denominator in terms:
        lower = denominator + numerator * lower
        lower = 1 / (lower if abs(lower) > _TINY else _TINY)
        upper = denominator + numerator / upper
        upper = upper if abs(upper) > _TINY else _TINY
        value *= upper * lower
        if abs(upper * lower - 1) < _EPSILON:
            break
    return value


def chi2_tail(statistic: float, freedom: float) -> float:
    """Probability that a chi-squared number of ``freedom`` degrees is larger."""
    if statistic <= 0:
        return 1.0
    a, x = freedom / 2, statistic / 2
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * _EPSILON:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1 - scale * total)
    terms = ((-k * (k - a), x + 2 * k + 1 - a) for k in range(1, _STEPS))
    return scale / _continued(terms, x + 1 - a)


def f_tail(statistic: float, between: float, within: float) -> float:
    """Probability that an F number of these degrees of freedom is larger."""
    if statistic <= 0:
        return 1.0
    if math.isinf(statistic):
        return 0.0
    return _beta(within / 2, between / 2, within / (within + between * statistic))


def _beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta(b, a, 1 - x)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / a

    def terms():
        for k in range(1, _STEPS):
            m = k // 2
            if k % 2:
                yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
            else:
                yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    return front / _continued(terms(), 1.0)


# --- scores ------------------------------------------------------------------------------


def chi2_scores(frame: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Rows ``(column, n, statistic, freedom, p_value)``: independence of each category and the label.

    The cells of all columns are unpivoted and counted in one shuffle, with counts combined
    before it; from there on the data are contingency tables. Missing values and labels are
    left out. Where a column or the label has one value only, the statistic is 0 and the
    p-value 1; a column without rows has null for both.
    """
    require_columns(frame, [*columns, label])
    known = frame.where(~is_missing(frame, label))
    cells = known.select(
        F.col(label).cast("string").alias("_label"), *[F.col(c).cast("string").alias(c) for c in columns]
    )
    counts = (
        cells.unpivot(["_label"], list(columns), "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value", "_label")
        .agg(F.count("*").alias("n"))
    )
    # A value's classes are few; sum over its cells of n^2 / (row * column) = sum of (n^2 / row) by class / column.
    by_value = counts.groupBy("column", "value").agg(
        F.sum("n").alias("row"), F.collect_list(F.struct("_label", "n")).alias("classes")
    )
    parts = by_value.select("column", "row", F.posexplode("classes").alias("at", "cell")).groupBy("column", "cell._label").agg(
        F.sum("cell.n").alias("total"),
        F.sum(F.col("cell.n").cast("double") * F.col("cell.n") / F.col("row")).alias("share"),
        F.count_if(F.col("at") == 0).alias("values"),
    )
    scores = parts.groupBy("column").agg(
        F.sum("total").alias("n"),
        (F.sum("total") * (F.sum(F.col("share") / F.col("total")) - 1)).alias("statistic"),
        F.sum("values").alias("values"),
        F.count("*").alias("classes"),
    )
    found = {row["column"]: row for row in scores.collect()}
    rows = []
    for name in columns:
        row = found.get(name)
        if row is None:
            rows.append((name, 0, None, 0, None))
            continue
        freedom = (row["values"] - 1) * (row["classes"] - 1)
        statistic = max(0.0, row["statistic"]) if freedom else 0.0
        rows.append((name, row["n"], statistic, freedom, chi2_tail(statistic, freedom) if freedom else 1.0))
    schema = "column string, n long, statistic double, freedom long, p_value double"
    return frame.sparkSession.createDataFrame(rows, schema)


def anova_scores(frame: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Rows ``(column, n, statistic, between, within, p_value)``: do the classes' means differ.

    One scan and one shuffle of a row per class and task, for all columns. Missing values and
    labels are left out. The statistic is null with fewer than two classes or without spare
    rows, and infinite where all classes are constant but differ.
    """
    require_columns(frame, [*columns, label])
    known = frame.where(~is_missing(frame, label))
    values = [F.when(~is_missing(frame, c), F.col(c).cast("double")) for c in columns]
    grouped = known.groupBy(F.col(label).alias("_label")).agg(
        *[f(v).alias(f"{name}{i}") for i, v in enumerate(values) for name, f in (("n", F.count), ("m", F.avg), ("s", F.var_pop))]
    )
    # One row per class: a class is a group of the label, of which a classifier has few.
    classes = grouped.collect()
    rows = []
    for i, name in enumerate(columns):
        own = [(r[f"n{i}"], r[f"m{i}"], r[f"s{i}"]) for r in classes if r[f"n{i}"]]
        n = sum(k for k, _, _ in own)
        between, within = len(own) - 1, n - len(own)
        if between < 1 or within < 1:
            rows.append((name, n, None, max(between, 0), max(within, 0), None))
            continue
        mean = sum(k * m for k, m, _ in own) / n
        apart = sum(k * (m - mean) ** 2 for k, m, _ in own) / between
        around = sum(k * s for k, _, s in own) / within
        statistic = apart / around if around else (math.inf if apart else 0.0)
        rows.append((name, n, statistic, between, within, f_tail(statistic, between, within)))
    schema = "column string, n long, statistic double, between long, within long, p_value double"
    return frame.sparkSession.createDataFrame(rows, schema)


def best_columns(scores: DataFrame, count: int) -> list[str]:
    """The ``count`` columns of the largest statistics, ties by name; such without one come last."""
    order = [F.desc_nulls_last("statistic"), F.asc("column")]
    return [row["column"] for row in scores.orderBy(*order).limit(count).collect()]


def variance_threshold(frame: DataFrame, columns: Sequence[str], least: float = 0.0) -> DataFrame:
    """Rows ``(column, variance, kept)``: sample variances, kept above ``least``; one scan.

    A column with fewer than two values has no variance and is not kept.
    """
    require_columns(frame, columns)
    one_row = frame.agg(
        *[F.var_samp(F.when(~is_missing(frame, c), F.col(c).cast("double"))).alias(f"v{i}") for i, c in enumerate(columns)]
    )
    structs = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"v{i}").alias("variance"),
            F.coalesce(F.col(f"v{i}") > least, F.lit(False)).alias("kept"),
        )
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*structs)))
