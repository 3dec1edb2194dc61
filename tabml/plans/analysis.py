"""Curve, component and selection queries, and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators import curves, moments, select
from tabml.plans.oracle_views import BLOCKS, LINES
from tabml.sources import blocks, lines

POINTS = 50
PAIR = ["total_ext", "o_totalprice"]
TRIPLE = ["total_ext", "total_qty", "n_lines"]
CATEGORIES = ["l_returnflag", "l_linenumber", "l_discount", "l_tax"]
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _rounded(frame: DataFrame, digits: int, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns})


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select("label", "l_returnflag", F.col("l_extendedprice").alias("score"))


def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct price as a threshold."""
    return _rounded(curves.roc_curve(_scored(spark, sf_dir)), 8, "fpr", "tpr")


def roc_curve_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many ties: thresholds are quantities, one curve for each flag."""
    scored = lines(spark, sf_dir).select("label", "l_returnflag", F.col("l_quantity").alias("score"))
    return _rounded(curves.roc_curve(scored, ["l_returnflag"]), 8, "fpr", "tpr")


def roc_curve_thinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    thin = curves.roc_curve(_scored(spark, sf_dir), ["l_returnflag"], points=POINTS)
    return _rounded(thin, 8, "fpr", "tpr")


def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(curves.pr_curve(_scored(spark, sf_dir)), 8, "recall", "precision")


def roc_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = curves.roc_curve(_scored(spark, sf_dir), ["l_returnflag"])
    return _rounded(curves.roc_area(curve, ["l_returnflag"]), 8, "area")


def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = curves.pr_curve(_scored(spark, sf_dir), ["l_returnflag"])
    return _rounded(curves.average_precision(curve, ["l_returnflag"]), 8, "average_precision")


def covariance_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = moments.covariance_matrix(blocks(spark, sf_dir), TRIPLE)
    # Six significant digits: covariances of prices are large.
    return found.withColumn("covar", F.round(F.col("covar") / 1000, 3))


def _pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, moments.PrincipalComponents]:
    frame = blocks(spark, sf_dir)
    return frame, moments.principal_components(frame, PAIR)


def pca_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, found = _pair(spark, sf_dir)
    table = found.table(frame).withColumn("variance", F.round(F.col("variance") / 1000, 2))
    return _rounded(table, 8, "loading", "explained")


def pca_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, found = _pair(spark, sf_dir)
    return _rounded(found.project(frame).select("o_orderkey", "pc1", "pc2"), 2, "pc1", "pc2")


def pca_standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the correlations of three columns."""
    frame = blocks(spark, sf_dir)
    return _rounded(moments.principal_components(frame, TRIPLE, standardise=True).table(frame), 6, "loading", "variance", "explained")


def select_chi2(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = select.chi2_scores(lines(spark, sf_dir), CATEGORIES, "label")
    return _rounded(scores, 6, "statistic").withColumn("p_value", F.round("p_value", 8))


def select_anova(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = select.anova_scores(lines(spark, sf_dir), NUMBERS, "l_linenumber").drop("p_value")
    kept = select.best_columns(scores, 2)
    return _rounded(scores.withColumn("kept", F.col("column").isin(kept)), 6, "statistic")


def variance_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = select.variance_threshold(lines(spark, sf_dir), NUMBERS, least=1.0)
    return found.select("column", F.round(F.sqrt("variance"), 5).alias("deviation"), "kept")


QUERIES = {
    f.__name__: f
    for f in (
        roc_curve,
        roc_curve_by_group,
        roc_curve_thinned,
        pr_curve,
        roc_area,
        average_precision,
        covariance_matrix,
        pca_components,
        pca_project,
        pca_standardised,
        select_chi2,
        select_anova,
        variance_threshold,
    )
}


def _curve_sql(source: str, score: str, by: str = "") -> str:
    """CTE ``curve``: a row for each distinct score with what it and the higher ones hold."""
    prefix, partition = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    return f"""scores AS (
  SELECT {prefix}{score} AS threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
  FROM {source} GROUP BY ALL),
curve AS (
  SELECT {prefix}threshold, pos, neg,
    CAST(sum(pos) OVER ({partition} ORDER BY threshold DESC) AS BIGINT) AS tp,
    CAST(sum(neg) OVER ({partition} ORDER BY threshold DESC) AS BIGINT) AS fp,
    CAST(sum(pos) OVER ({partition}) AS BIGINT) AS positives, CAST(sum(neg) OVER ({partition}) AS BIGINT) AS negatives
  FROM scores),
started AS (
  SELECT * FROM curve UNION ALL
  SELECT DISTINCT {prefix}NULL::DOUBLE, 0, 0, 0, 0, positives, negatives FROM curve)"""


_ROC = "threshold, pos, neg, tp, fp, round(fp / negatives, 8) AS fpr, round(tp / positives, 8) AS tpr"
_FLAG = "l_returnflag"
_PAIR_SQL = f"""WITH {BLOCKS}, complete AS (SELECT * FROM blocks WHERE total_ext IS NOT NULL AND o_totalprice IS NOT NULL),
m AS (SELECT var_samp(total_ext) AS a, var_samp(o_totalprice) AS c, covar_samp(total_ext, o_totalprice) AS b,
  avg(total_ext) AS x0, avg(o_totalprice) AS y0 FROM complete),
v AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b) AS v1, (a + c) / 2 - sqrt(((a - c) / 2) ** 2 + b * b) AS v2 FROM m),
raw AS (
  SELECT *, unnest([1, 2]) AS component, unnest([v1, v2]) AS variance,
    unnest([b, b]) AS x, unnest([v1 - a, v2 - a]) AS y FROM v),
axes AS (
  SELECT component, variance, variance / (a + c) AS explained, x0, y0,
    x / sqrt(x * x + y * y) * s AS x, y / sqrt(x * x + y * y) * s AS y
  FROM (SELECT *, CASE WHEN abs(x) >= abs(y) THEN sign(x) ELSE sign(y) END AS s FROM raw))"""


def _chi2_sql(column: str, halves: int) -> str:
    """One column: the label has two values, so even degrees of freedom have a finite tail series."""
    return f"""SELECT '{column}' AS "column", CAST(n AS BIGINT) AS n, round(x, 6) AS statistic, CAST({2 * halves} AS BIGINT) AS freedom,
  round(exp(-x / 2) * ({_series(halves)}), 8) AS p_value FROM (
  SELECT any_value(total) AS n, any_value(total) * (sum(cell * cell / (r * c)) - 1) AS x FROM (
    SELECT cell, sum(cell) OVER (PARTITION BY value) AS r, sum(cell) OVER (PARTITION BY label) AS c, sum(cell) OVER () AS total
    FROM (SELECT {column} AS value, label, count(*)::DOUBLE AS cell FROM lines GROUP BY ALL)))"""


def _series(halves: int) -> str:
    terms, factorial = [], 1
    for k in range(halves):
        factorial *= max(1, k)
        terms.append(f"pow(x / 2, {k}) / {factorial}")
    return " + ".join(terms)


def _anova_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(sum(k) AS BIGINT) AS n,
  sum(k * (m - mean) ** 2) / (count(*) - 1) / (sum(k * s) / (sum(k) - count(*))) AS statistic,
  count(*) - 1 AS between, CAST(sum(k) - count(*) AS BIGINT) AS within
FROM (SELECT count({column}) AS k, avg({column}) AS m, var_pop({column}) AS s,
  sum(sum({column})) OVER () / sum(count({column})) OVER () AS mean FROM lines GROUP BY l_linenumber)"""


#: Turns of the power iteration that finds a component of three columns.
_TURNS = 300
_MATRIX = [[f"m.r{min(i, j)}{max(i, j)}" if i != j else "1.0::DOUBLE" for j in range(3)] for i in range(3)]


def _power_cte(name: str, matrix: str, start: tuple[float, float, float]) -> str:
    """Recursive power iteration with a 3 x 3 matrix ``matrix(a00, ..., a22)``; ends in ``name``."""
    products = [" + ".join(f"a{i}{j} * x{j}" for j in range(3)) for i in range(3)]
    return f"""{name}_steps AS (
  SELECT 0 AS turn, {", ".join(f"{v}::DOUBLE AS x{i}" for i, v in enumerate(start))}
  UNION ALL
  SELECT turn + 1, y0 / size, y1 / size, y2 / size FROM (
    SELECT turn, y0, y1, y2, sqrt(y0 * y0 + y1 * y1 + y2 * y2) AS size FROM (
      SELECT turn, {", ".join(f"{p} AS y{i}" for i, p in enumerate(products))} FROM {name}_steps, {matrix} WHERE turn < {_TURNS}))),
{name} AS (
  SELECT x0 * s AS x0, x1 * s AS x1, x2 * s AS x2, {" + ".join(f"x{i} * ({p})" for i, p in enumerate(products))} AS variance
  FROM (SELECT *, CASE WHEN round(abs(x0), 12) >= round(greatest(abs(x1), abs(x2)), 12) THEN sign(x0)
      WHEN round(abs(x1), 12) >= round(abs(x2), 12) THEN sign(x1) ELSE sign(x2) END AS s
    FROM {name}_steps, {matrix} WHERE turn = {_TURNS}))"""


_ALL = " AND ".join(f"{c} IS NOT NULL" for c in TRIPLE)
_ENTRIES = ", ".join(f"{_MATRIX[i][j]} AS a{i}{j}" for i in range(3) for j in range(3))


def _without(matrix: str, axis: str) -> str:
    """The matrix without what a component explains."""
    return ", ".join(f"{matrix}.a{i}{j} - {axis}.variance * {axis}.x{i} * {axis}.x{j} AS a{i}{j}" for i in range(3) for j in range(3))


_TRIPLE_SQL = f"""WITH RECURSIVE {BLOCKS}, m AS (
  SELECT corr({TRIPLE[0]}, {TRIPLE[1]}) AS r01, corr({TRIPLE[0]}, {TRIPLE[2]}) AS r02, corr({TRIPLE[1]}, {TRIPLE[2]}) AS r12
  FROM blocks WHERE {_ALL}),
first_matrix AS (SELECT {_ENTRIES} FROM m),
{_power_cte("one", "first_matrix", (0.61, 0.53, 0.41))},
second_matrix AS (SELECT {_without("first_matrix", "one")} FROM first_matrix, one),
{_power_cte("two", "second_matrix", (0.21, -0.53, 0.71))},
third_matrix AS (SELECT {_without("second_matrix", "two")} FROM second_matrix, two),
{_power_cte("three", "third_matrix", (0.31, 0.43, -0.61))}
""" + " UNION ALL ".join(
    f"""SELECT {k + 1}::INTEGER AS component, '{c}' AS "column", round(x{j}, 6) AS loading, round(variance, 6) AS variance,
  round(variance / 3, 6) AS explained FROM {name}"""
    for k, name in enumerate(("one", "two", "three"))
    for j, c in enumerate(TRIPLE)
)

ORACLES = {
    "roc_curve": f"WITH {LINES}, {_curve_sql('lines', 'l_extendedprice')} SELECT {_ROC} FROM started",
    "roc_curve_by_group": f"WITH {LINES}, {_curve_sql('lines', 'l_quantity', _FLAG)} SELECT {_FLAG}, {_ROC} FROM started",
    "roc_curve_thinned": f"""WITH {LINES}, {_curve_sql("lines", "l_extendedprice", _FLAG)}, cells AS (
  SELECT *, floor(fp / negatives * {POINTS}) AS x, floor(tp / positives * {POINTS}) AS y FROM started),
ends AS (
  SELECT *, min(tp + fp) OVER w AS low, max(tp + fp) OVER w AS high FROM cells WINDOW w AS (PARTITION BY {_FLAG}, x, y))
SELECT {_FLAG}, {_ROC} FROM ends WHERE tp + fp IN (low, high)""",
    "pr_curve": f"""WITH {LINES}, {_curve_sql("lines", "l_extendedprice")}
SELECT threshold, pos, neg, tp, fp, round(tp / positives, 8) AS recall, round(tp / (tp + fp), 8) AS precision FROM curve""",
    "roc_area": f"""WITH {LINES}, {_curve_sql("lines", "l_extendedprice", _FLAG)}, ordered AS (
  SELECT *, lag(fp) OVER w AS fp0, lag(tp) OVER w AS tp0 FROM started WINDOW w AS (PARTITION BY {_FLAG} ORDER BY tp + fp))
SELECT {_FLAG}, round(sum((fp - fp0) * (tp + tp0) / 2.0::DOUBLE / positives / negatives), 8) AS area FROM ordered GROUP BY {_FLAG}""",
    "average_precision": f"""WITH {LINES}, {_curve_sql("lines", "l_extendedprice", _FLAG)}
SELECT {_FLAG}, round(sum(pos / positives * (tp / (tp + fp))), 8) AS average_precision FROM curve GROUP BY {_FLAG}""",
    "covariance_matrix": f"WITH {BLOCKS}, complete AS (SELECT * FROM blocks WHERE {_ALL}) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(covar_samp({a}, {b}) / 1000, 3) AS covar, count(*) AS n FROM complete"
        for a in TRIPLE
        for b in TRIPLE
    ),
    "pca_components": _PAIR_SQL
    + " UNION ALL ".join(
        f"""
SELECT component::INTEGER AS component, '{c}' AS "column", round({axis}, 8) AS loading, round(variance / 1000, 2) AS variance,
  round(explained, 8) AS explained FROM axes"""
        for c, axis in zip(PAIR, ("x", "y"), strict=True)
    ),
    "pca_project": _PAIR_SQL
    + """
SELECT o_orderkey, round(max(p) FILTER (WHERE component = 1), 2) AS pc1, round(max(p) FILTER (WHERE component = 2), 2) AS pc2
FROM (SELECT o_orderkey, component, (total_ext - x0) * x + (o_totalprice - y0) * y AS p FROM blocks, axes) GROUP BY o_orderkey""",
    "pca_standardised": _TRIPLE_SQL,
    # The halves of the degrees of freedom: two classes, so one less than the column's values.
    "select_chi2": f"WITH {LINES} "
    + " UNION ALL ".join(_chi2_sql(c, k) for c, k in zip(CATEGORIES, (1, 3, 5, 4), strict=True)),
    "select_anova": f"WITH {LINES}, scores AS ("
    + " UNION ALL ".join(_anova_sql(c) for c in NUMBERS)
    + """) SELECT * REPLACE (round(statistic, 6) AS statistic), row_number() OVER (ORDER BY statistic DESC, "column") <= 2 AS kept
FROM scores""",
    "variance_threshold": f"WITH {LINES} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(stddev_samp({c}), 5) AS deviation, var_samp({c}) > 1.0 AS kept FROM lines"
        for c in NUMBERS
    ),
}
