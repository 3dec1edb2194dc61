import math

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

from tabml.operators.evaluate import (
    auc_score,
    classification_metrics,
    confusion_matrix,
    regression_metrics,
)
from tabml.sources import lines

BUILTIN = {"accuracy": "accuracy", "f1": "f1", "weightedPrecision": "weightedPrecision", "weightedRecall": "weightedRecall"}


def values(frame):
    return {r["metric"]: r["value"] for r in frame.collect()}


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    return lines(spark, sf_dir).select(
        "label",
        "l_returnflag",
        F.col("l_linenumber").cast("double").alias("number"),
        (F.col("l_quantity") > 25).cast("double").alias("prediction"),
        F.col("l_quantity").alias("score"),
    )


def test_classification_metrics_equal_the_builtin(scored):
    got = values(classification_metrics(scored))
    for name, builtin in BUILTIN.items():
        expected = MulticlassClassificationEvaluator(metricName=builtin).evaluate(scored)
        assert math.isclose(got[name], expected, rel_tol=1e-12), name
    hard = BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(scored)
    assert math.isclose(got["auc_hard"], hard, rel_tol=1e-12)


def test_many_classes_one_never_predicted(scored):
    classes = scored.select(
        F.col("number").alias("label"),
        F.when(F.col("score") > 25, F.col("number")).otherwise((F.col("number") * 5) % 6 + 1).alias("prediction"),
    )
    got = values(classification_metrics(classes))
    for name, builtin in BUILTIN.items():
        expected = MulticlassClassificationEvaluator(metricName=builtin).evaluate(classes)
        assert math.isclose(got[name], expected, rel_tol=1e-12), name


def test_groups_equal_their_rows_alone(scored):
    grouped = classification_metrics(scored, ["l_returnflag"]).where("l_returnflag = 'R'")
    alone = values(classification_metrics(scored.where("l_returnflag = 'R'")))
    assert values(grouped) == pytest.approx(alone)
    grouped = auc_score(scored, ["l_returnflag"]).where("l_returnflag = 'R'")
    assert values(grouped) == pytest.approx(values(auc_score(scored.where("l_returnflag = 'R'"))))


@pytest.mark.parametrize("score", ["score", "number"])
def test_auc_equals_the_exact_builtin(scored, score):
    frame = scored.withColumn("score", F.col(score))
    expected = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(frame)
    assert math.isclose(values(auc_score(frame))["auc_score"], expected, rel_tol=1e-12)


def test_auc_over_several_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(5000).select(
            F.col("id").cast("double").alias("score"), (F.hash("id") % 3 == 0).cast("double").alias("label")
        )
        expected = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(frame)
        assert math.isclose(values(auc_score(frame))["auc_score"], expected, rel_tol=1e-12)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_class_has_no_auc(scored):
    only = scored.where("label = 1")
    assert values(auc_score(only))["auc_score"] is None
    assert values(classification_metrics(only))["auc_hard"] is None


def test_regression_metrics_equal_the_builtin(scored):
    frame = scored.select(F.col("score").alias("label"), (F.col("number") * 7).alias("prediction"))
    got = values(regression_metrics(frame))
    for name in ("rmse", "mae", "r2"):
        expected = RegressionEvaluator(metricName=name).evaluate(frame)
        assert math.isclose(got[name], expected, rel_tol=1e-9), name


def test_confusion_matrix_counts_every_row(scored):
    assert confusion_matrix(scored).agg(F.sum("n")).head()[0] == scored.count()
