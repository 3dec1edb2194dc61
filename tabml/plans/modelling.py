"""Model and metric queries and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators import models
from tabml.operators.evaluate import auc_score as score_auc
from tabml.operators.evaluate import classification_metrics as metrics_of_classes
from tabml.operators.evaluate import regression_metrics as metrics_of_numbers
from tabml.operators.evaluate import score_models
from tabml.operators.features import add_ratios, assemble, one_hot
from tabml.operators.spec import FeatureSpec
from tabml.operators.split import train_test_split
from tabml.plans import workflows
from tabml.plans.oracle_views import LABELLED, LINES, in_train
from tabml.plans.tree_oracle import boosted_ctes, leaf_mean, tree_ctes
from tabml.sources import blocks, lines, load_table, spread, stage
from tabml.sources.views import BLOCK_RATIOS

KEY = "o_orderkey"
LINE_KEY = "l_orderkey"
LINEAR_FEATURES = ["n_lines", "total_qty"]
# Predictors with few values, each of which is then a possible cut.
DISCRETE = ["n_lines", "total_qty", "o_year"]
DISCRETE_LINES = ["l_quantity", "l_linenumber", "l_discount", "l_tax"]
# Enough bins for every value, and leaves too large for two cuts to part them alike.
EXACT = {"maxBins": 2048, "minInstancesPerNode": 50}
STUMP = {"maxDepth": 1, "maxBins": 64}
ONE_TREE = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all"}

REGRESSION = FeatureSpec(
    key=KEY,
    label="total_ext",
    numeric=("o_totalprice", "o_year", "c_acctbal", "n_lines", "total_qty", *BLOCK_RATIOS),
    categorical=("o_orderpriority",),
)
CLASSIFICATION = FeatureSpec(
    key=LINE_KEY,
    label="label",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_returnflag", "l_linestatus", "l_linenumber"),
    numeric_first=False,
)


def labelled_blocks(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """``(key, label, features)``, without preparation."""
    frame = blocks(spark, sf_dir).where(F.col("total_ext").isNotNull())
    return assemble(frame, columns).select(KEY, F.col("total_ext").alias("label"), "features")


def labelled_lines(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    return assemble(lines(spark, sf_dir), columns).select(LINE_KEY, "label", "features")


def linenumber_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = one_hot(lines(spark, sf_dir), ["l_linenumber"])
    return encoded.select(LINE_KEY, "label", F.col("l_linenumber_onehot").alias("features"))


def prepared_blocks(spark: SparkSession, sf_dir: str, prefit: bool = False) -> workflows.Prepared:
    frame = add_ratios(blocks(spark, sf_dir), BLOCK_RATIOS)
    return workflows.prepare(frame, REGRESSION, prefit=prefit)


def prepared_lines(spark: SparkSession, sf_dir: str) -> workflows.Prepared:
    return workflows.prepare(lines(spark, sf_dir), CLASSIFICATION, impute=[], restage=False)


def _split(frame: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Staged first, as training reads it more than once."""
    train, test = train_test_split(stage(frame, "vectors"), key)
    return spread(train, key), test


def _rounded(frame: DataFrame, digits: int, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns})


# --- linear ------------------------------------------------------------------------------


def _linear(spark: SparkSession, sf_dir: str):
    train, test = _split(labelled_blocks(spark, sf_dir, LINEAR_FEATURES), KEY)
    return models.fit_linear(train), test


def linear_regression_coef(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = _linear(spark, sf_dir)
    return _rounded(models.linear_terms(model, test, LINEAR_FEATURES), 4, "value")


def linear_regression_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = _linear(spark, sf_dir)
    return _rounded(models.predict(model, test, [KEY]), 2, "label", "prediction")


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = _linear(spark, sf_dir)
    return _rounded(metrics_of_numbers(models.predict(model, test, [KEY])), 5, "value")


def _linear_report(prepared: workflows.Prepared) -> DataFrame:
    report = workflows.regression_report(prepared, {"linear": models.linear_regression()})
    return _rounded(report, 4, "value")


def linear_regression_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regression workload with its linear model, raw tables to metrics."""
    return _linear_report(prepared_blocks(spark, sf_dir))


def linear_regression_prefit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the preparation fitted on all rows before the split.

    Least squares does not depend on the scale of a predictor or the order of the
    categories, and labelled blocks lack no predictor, so the result is the same.
    """
    return _linear_report(prepared_blocks(spark, sf_dir, prefit=True))


# --- regression trees --------------------------------------------------------------------


def _regression(spark: SparkSession, sf_dir: str, estimator, columns: list[str]) -> DataFrame:
    train, test = _split(labelled_blocks(spark, sf_dir, columns), KEY)
    predictions = models.predict(estimator.fit(train), test, [KEY])
    # A mean of cents over n rows is hardly ever half way between two tenths.
    return _rounded(predictions, 2, "label").withColumn("prediction", F.round("prediction", 1))


def tree_regression_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regression(spark, sf_dir, models.tree_regression(**STUMP), ["n_lines"])


def forest_regression_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regression(spark, sf_dir, models.forest_regression(**STUMP, **ONE_TREE), ["n_lines"])


def gbt_regression_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regression(spark, sf_dir, models.gbt_regression(**STUMP | {"maxIter": 1}), ["n_lines"])


def tree_regression_discrete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default depth, three predictors of which every value is a possible cut."""
    return _regression(spark, sf_dir, models.tree_regression(**EXACT), DISCRETE)


def forest_regression_discrete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default trees and depth; without resampling every tree sees the same rows."""
    same_rows = {"bootstrap": False, "featureSubsetStrategy": "all"}
    return _regression(spark, sf_dir, models.forest_regression(**EXACT, **same_rows), DISCRETE)


def gbt_regression_discrete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default rounds, at depth 3."""
    return _regression(spark, sf_dir, models.gbt_regression(**EXACT, maxDepth=3), DISCRETE)


def _full_regression(spark: SparkSession, sf_dir: str, estimator) -> DataFrame:
    prepared = prepared_blocks(spark, sf_dir)
    return models.predict(estimator.fit(prepared.train), prepared.test, [KEY])


def tree_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_regression(spark, sf_dir, models.tree_regression())


def forest_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_regression(spark, sf_dir, models.forest_regression())


def gbt_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_regression(spark, sf_dir, models.gbt_regression())


def regression_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regression workload with its four models."""
    return workflows.regression_report(prepared_blocks(spark, sf_dir))


# --- classification metrics --------------------------------------------------------------


def _ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed rule as the classifier: quantity is the score, a threshold the prediction."""
    rule = (F.col("l_quantity") > 25).cast("double")
    return lines(spark, sf_dir).select(
        "label", "l_returnflag", rule.alias("prediction"), F.col("l_quantity").alias("score")
    )


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics_of_classes(_ruled(spark, sf_dir)), 8, "value")


def classification_metrics_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = metrics_of_classes(_ruled(spark, sf_dir), ["l_returnflag"])
    return _rounded(metrics, 8, "value")


def auc_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = metrics_of_classes(_ruled(spark, sf_dir)).where(F.col("metric") == "auc_hard")
    return _rounded(metrics, 8, "value")


def auc_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(score_auc(_ruled(spark, sf_dir)), 8, "value")


def auc_score_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many distinct scores, several groups of predictions in one job."""
    scored = lines(spark, sf_dir).select("label", "l_returnflag", F.col("l_extendedprice").alias("score"))
    return _rounded(score_auc(scored, ["l_returnflag"]), 8, "value")


# --- classifiers -------------------------------------------------------------------------


def logistic_saturated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category, no penalty: the fitted probability is the rate of the group."""
    orders = load_table(spark, sf_dir, "orders")
    encoded = one_hot(orders, ["o_orderpriority"]).select(
        KEY,
        "o_orderpriority",
        (F.col("o_orderstatus") == "F").cast("double").alias("label"),
        F.col("o_orderpriority_onehot").alias("features"),
    )
    staged = spread(stage(encoded, "vectors"), KEY)
    model = models.logistic_regression(tol=1e-10).fit(staged)
    predictions = models.predict(model, staged, [KEY, "o_orderpriority"])
    return _rounded(predictions, 5, "probability")


def _line_predictions(spark: SparkSession, sf_dir: str, estimator, columns: list[str]) -> DataFrame:
    train, test = _split(labelled_lines(spark, sf_dir, columns), LINE_KEY)
    return models.predict(estimator.fit(train), test, [LINE_KEY])


def tree_classifier_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = _line_predictions(spark, sf_dir, models.tree_classifier(**STUMP), ["l_quantity"])
    return _rounded(predictions, 6, "probability")


def forest_classifier_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    estimator = models.forest_classifier(**STUMP, **ONE_TREE)
    return _rounded(_line_predictions(spark, sf_dir, estimator, ["l_quantity"]), 6, "probability")


def tree_classifier_discrete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default depth; the hard prediction, as equal leaves are merged after training."""
    predictions = _line_predictions(spark, sf_dir, models.tree_classifier(**EXACT), DISCRETE_LINES)
    return predictions.drop("probability")


def forest_classifier_discrete(spark: SparkSession, sf_dir: str) -> DataFrame:
    estimator = models.forest_classifier(**EXACT, bootstrap=False, featureSubsetStrategy="all")
    return _line_predictions(spark, sf_dir, estimator, DISCRETE_LINES).drop("probability")


def model_comparison_discrete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A logistic model of one category, a tree and a forest, ranked on F1."""
    slots_train, slots_test = _split(linenumber_slots(spark, sf_dir), LINE_KEY)
    logistic = models.logistic_regression(tol=1e-10).fit(slots_train)
    train, test = _split(labelled_lines(spark, sf_dir, DISCRETE_LINES), LINE_KEY)
    forest = models.forest_classifier(**EXACT, bootstrap=False, featureSubsetStrategy="all", maxDepth=2)
    fitted = {"tree": models.tree_classifier(**EXACT).fit(train), "forest": forest.fit(train)}
    scored = score_models(fitted, test).unionByName(score_models({"logistic": logistic}, slots_test))
    ranked = workflows.compare_models(metrics_of_classes(scored, ["model"]), "f1")
    return _rounded(ranked, 8, "value")


def _full_classification(spark: SparkSession, sf_dir: str, estimator) -> DataFrame:
    prepared = prepared_lines(spark, sf_dir)
    return models.predict(estimator.fit(prepared.train), prepared.test, [LINE_KEY])


def logistic_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_classification(spark, sf_dir, models.logistic_regression())


def tree_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_classification(spark, sf_dir, models.tree_classifier())


def forest_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_classification(spark, sf_dir, models.forest_classifier())


QUERIES = {
    f.__name__: f
    for f in (
        linear_regression_coef,
        linear_regression_predict,
        regression_metrics,
        linear_regression_report,
        linear_regression_prefit,
        tree_regression_stump,
        forest_regression_stump,
        gbt_regression_stump,
        tree_regression_discrete,
        forest_regression_discrete,
        gbt_regression_discrete,
        tree_regression,
        forest_regression,
        gbt_regression,
        regression_report,
        classification_metrics,
        classification_metrics_by_group,
        auc_hard,
        auc_score,
        auc_score_by_group,
        logistic_saturated,
        tree_classifier_stump,
        forest_classifier_stump,
        tree_classifier_discrete,
        forest_classifier_discrete,
        model_comparison_discrete,
        logistic_regression,
        tree_classifier,
        forest_classifier,
    )
}


# --- oracles -----------------------------------------------------------------------------

_BLOCK_SPLIT = f"""{LABELLED}, split AS (
  SELECT *, total_ext AS label, {in_train(KEY)} AS is_train FROM labelled)"""
_LINE_SPLIT = f"""{LINES}, split AS (SELECT *, {in_train(LINE_KEY)} AS is_train FROM lines)"""

# Two predictors: the normal equations by Cramer's rule.
_LINEAR = f"""{_BLOCK_SPLIT}, moments AS (
  SELECT var_samp(n_lines) AS v1, var_samp(total_qty) AS v2, covar_samp(n_lines, total_qty) AS c12,
         covar_samp(n_lines, label) AS c1, covar_samp(total_qty, label) AS c2,
         avg(n_lines) AS m1, avg(total_qty) AS m2, avg(label) AS my
  FROM split WHERE is_train),
slopes AS (
  SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1,
         (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM moments),
fitted AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM slopes),
predicted AS (
  SELECT split.*, b0 + b1 * n_lines + b2 * total_qty AS p, b0, b1, b2 FROM split, fitted)"""


def _least_squares_ctes(source: str, predictors: dict[str, str]) -> list[str]:
    """``residuals``: ``source`` with the residual ``y`` of the label on all predictors.

    Any number of predictors: each in turn is projected out of the later ones and of
    the label, with the sums taken over the training rows.
    """
    terms = {f"x{i}": expression for i, expression in enumerate(predictors.values())} | {"y": "label"}
    total = "sum({}) FILTER (WHERE is_train) OVER ()"
    centred = ", ".join(f"{e} - avg({e}) FILTER (WHERE is_train) OVER () AS {n}" for n, e in terms.items())
    ctes = [f"step_0 AS MATERIALIZED (SELECT label, is_train, {centred} FROM {source})"]
    names = list(terms)
    for i, x in enumerate(names[:-1]):
        later = ", ".join(
            f"{n} - {x} * ({total.format(f'{x} * {n}')} / {total.format(f'{x} * {x}')}) AS {n}"
            for n in names[i + 1 :]
        )
        ctes.append(f"step_{i + 1} AS MATERIALIZED (SELECT label, is_train, {later} FROM step_{i})")
    return [*ctes, f"residuals AS (SELECT label, is_train, y FROM step_{len(names) - 1})"]


def _linear_report_sql() -> str:
    predictors = {n: f"{n}::DOUBLE" for n in REGRESSION.numeric if n not in BLOCK_RATIOS}
    predictors |= {n: f"({a} / nullif({b}, 0))" for n, (a, b) in BLOCK_RATIOS.items()}
    # All but one of the five priorities; which one is left out does not matter.
    predictors |= {p: f"(o_orderpriority LIKE '{p}%')::INTEGER::DOUBLE" for p in "1234"}
    return f"""WITH {_BLOCK_SPLIT}, {", ".join(_least_squares_ctes("split", predictors))},
test AS (SELECT * FROM residuals WHERE NOT is_train)
SELECT 'linear' AS model, 'rmse' AS metric, round(sqrt(avg(y * y)), 4) AS value FROM test
UNION ALL SELECT 'linear', 'mae', round(avg(abs(y)), 4) FROM test
UNION ALL SELECT 'linear', 'r2', round(1 - sum(y * y) / (count(*) * var_pop(label)), 4) FROM test"""


def _tree_sql(predictors: list[str], depth: int, min_rows: int = 1) -> str:
    chain = ", ".join(tree_ctes("t", "split", predictors, depth, min_rows=min_rows))
    return f"""WITH {_BLOCK_SPLIT}, {chain}
SELECT {KEY}, round(label, 2) AS label, round(p, 1) AS prediction
FROM (SELECT *, {leaf_mean()} AS p FROM t_{depth}) WHERE NOT is_train"""


def _class_tree_ctes(name: str, predictors: list[str], depth: int, min_rows: int) -> str:
    chain = tree_ctes(name, "split", predictors, depth, kind="gini", min_rows=min_rows)
    chain.append(f"""{name}_predicted AS (
  SELECT {LINE_KEY}, label, (p > 0.5)::INTEGER::DOUBLE AS prediction, p AS probability
  FROM (SELECT *, {leaf_mean()} AS p FROM {name}_{depth}) WHERE NOT is_train)""")
    return ", ".join(chain)


def metrics_sql(source: str, by: str = "") -> str:
    """Rows ``(by, metric, value)`` of 0/1 labels and predictions, from the four counts."""
    prefix = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""

    def weighted(zero: str, one: str) -> str:
        return f"((tn + fp) * {zero} + (tp + fn) * {one}) / total"

    def rate(part: str, whole: str) -> str:
        return f"coalesce({part} / nullif({whole}, 0), 0)"

    values = {
        "accuracy": "(tp + tn) / total",
        "f1": weighted(rate("2 * tn", "2 * tn + fp + fn"), rate("2 * tp", "2 * tp + fp + fn")),
        "weightedPrecision": weighted(rate("tn", "tn + fn"), rate("tp", "tp + fp")),
        "weightedRecall": weighted(rate("tn", "tn + fp"), rate("tp", "tp + fn")),
        "auc_hard": "(tp / (tp + fn) + tn / (tn + fp)) / 2",
    }
    rows = " UNION ALL ".join(
        f"SELECT {prefix}'{metric}' AS metric, {value} AS value FROM counts"
        for metric, value in values.items()
    )
    return f"""(WITH counts AS (
  SELECT {prefix}count(*)::DOUBLE AS total,
         (count(*) FILTER (WHERE label = 1 AND prediction = 1))::DOUBLE AS tp,
         (count(*) FILTER (WHERE label = 0 AND prediction = 1))::DOUBLE AS fp,
         (count(*) FILTER (WHERE label = 1 AND prediction = 0))::DOUBLE AS fn,
         (count(*) FILTER (WHERE label = 0 AND prediction = 0))::DOUBLE AS tn
  FROM {source} {group}) {rows})"""


def auc_sql(source: str, by: str = "") -> str:
    """``(by, auc)`` by mid-ranks."""
    prefix, partition = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    group = f"GROUP BY {by}" if by else ""
    return f"""(SELECT {prefix}(sum(CASE WHEN label = 1 THEN mid ELSE 0 END) - p * (p + 1) / 2) / (p * n) AS auc
FROM (SELECT *, rank() OVER ({partition} ORDER BY score)
               + (count(*) OVER ({partition + ", score" if by else "PARTITION BY score"}) - 1) / 2.0::DOUBLE AS mid,
             (sum(label) OVER ({partition}))::DOUBLE AS p,
             (sum(1 - label) OVER ({partition}))::DOUBLE AS n
      FROM {source}) {group + ", p, n" if by else "GROUP BY p, n"})"""


_RULED = f"""{LINES}, ruled AS (
  SELECT label, l_returnflag, (l_quantity > 25)::INTEGER::DOUBLE AS prediction, l_quantity AS score,
         l_extendedprice FROM lines)"""
_STUMP_SQL = _tree_sql(["n_lines"], 1)
_CLASS_STUMP_SQL = f"""WITH {_LINE_SPLIT}, {_class_tree_ctes("t", ["l_quantity"], 1, 1)}
SELECT {LINE_KEY}, label, prediction, round(probability, 6) AS probability FROM t_predicted"""
_CLASS_TREE_SQL = f"""WITH {_LINE_SPLIT}, {_class_tree_ctes("t", DISCRETE_LINES, 5, 50)}
SELECT {LINE_KEY}, label, prediction FROM t_predicted"""

ORACLES = {
    "linear_regression_coef": f"""WITH {_LINEAR}
SELECT 'n_lines' AS term, round(b1, 4) AS value FROM fitted
UNION ALL SELECT 'total_qty', round(b2, 4) FROM fitted
UNION ALL SELECT 'intercept', round(b0, 4) FROM fitted
UNION ALL SELECT 'rmse', round(sqrt(avg((label - p) * (label - p))), 4) FROM predicted WHERE is_train""",
    "linear_regression_predict": f"""WITH {_LINEAR}
SELECT {KEY}, round(label, 2) AS label, round(p, 2) AS prediction FROM predicted WHERE NOT is_train""",
    "regression_metrics": f"""WITH {_LINEAR}, test AS (SELECT * FROM predicted WHERE NOT is_train)
SELECT 'rmse' AS metric, round(sqrt(avg((label - p) * (label - p))), 5) AS value FROM test
UNION ALL SELECT 'mae', round(avg(abs(label - p)), 5) FROM test
UNION ALL SELECT 'r2', round(1 - sum((label - p) * (label - p)) / (count(*) * var_pop(label)), 5) FROM test""",
    "linear_regression_report": _linear_report_sql(),
    "linear_regression_prefit": _linear_report_sql(),
    "tree_regression_stump": _STUMP_SQL,
    "forest_regression_stump": _STUMP_SQL,
    "gbt_regression_stump": _STUMP_SQL,
    "tree_regression_discrete": _tree_sql(DISCRETE, 5, 50),
    "forest_regression_discrete": _tree_sql(DISCRETE, 10, 50),
    "gbt_regression_discrete": f"""WITH {_BLOCK_SPLIT},
{", ".join(boosted_ctes("g", "split", DISCRETE, 3, 10, min_rows=50))}
SELECT {KEY}, round(label, 2) AS label, round(p, 1) AS prediction FROM g_round_10 WHERE NOT is_train""",
    "classification_metrics": f"WITH {_RULED} SELECT metric, round(value, 8) AS value FROM {metrics_sql('ruled')}",
    "classification_metrics_by_group": f"""WITH {_RULED}
SELECT l_returnflag, metric, round(value, 8) AS value FROM {metrics_sql("ruled", "l_returnflag")}""",
    "auc_hard": f"""WITH {_RULED}
SELECT metric, round(value, 8) AS value FROM {metrics_sql("ruled")} WHERE metric = 'auc_hard'""",
    "auc_score": f"WITH {_RULED} SELECT 'auc_score' AS metric, round(auc, 8) AS value FROM {auc_sql('ruled')}",
    "auc_score_by_group": f"""WITH {_RULED},
priced AS (SELECT label, l_returnflag, l_extendedprice AS score FROM ruled)
SELECT l_returnflag, 'auc_score' AS metric, round(auc, 8) AS value FROM {auc_sql("priced", "l_returnflag")}""",
    "logistic_saturated": f"""WITH rated AS (
  SELECT {KEY}, o_orderpriority, (o_orderstatus = 'F')::INTEGER::DOUBLE AS label,
         avg((o_orderstatus = 'F')::INTEGER) OVER (PARTITION BY o_orderpriority) AS rate FROM orders)
SELECT {KEY}, o_orderpriority, label, (rate > 0.5)::INTEGER::DOUBLE AS prediction,
  round(rate, 5) AS probability FROM rated""",
    "tree_classifier_stump": _CLASS_STUMP_SQL,
    "forest_classifier_stump": _CLASS_STUMP_SQL,
    "tree_classifier_discrete": _CLASS_TREE_SQL,
    "forest_classifier_discrete": _CLASS_TREE_SQL,
    "model_comparison_discrete": f"""WITH {_LINE_SPLIT},
{_class_tree_ctes("tree", DISCRETE_LINES, 5, 50)}, {_class_tree_ctes("forest", DISCRETE_LINES, 2, 50)},
logistic AS (SELECT * FROM (
  SELECT label, is_train, (avg(label) FILTER (WHERE is_train)
                           OVER (PARTITION BY l_linenumber) > 0.5)::INTEGER::DOUBLE AS prediction
  FROM split) WHERE NOT is_train),
scored AS (SELECT 'tree' AS model, label, prediction FROM tree_predicted
  UNION ALL SELECT 'forest', label, prediction FROM forest_predicted
  UNION ALL SELECT 'logistic', label, prediction FROM logistic),
metrics AS (SELECT * FROM {metrics_sql("scored", "model")}),
ranks AS (SELECT model, row_number() OVER (ORDER BY value DESC, model)::INTEGER AS rank
          FROM metrics WHERE metric = 'f1')
SELECT model, metric, round(value, 8) AS value, rank FROM metrics JOIN ranks USING (model)""",
}
