"""Metrics as long rows ``(by..., metric, value)``.

``by`` evaluates many sets of predictions (models, folds, candidates) in one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.classification import ClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.operators.ranking import running_totals

REGRESSION_METRICS = ("rmse", "mae", "r2")
CLASSIFICATION_METRICS = ("accuracy", "f1", "weightedPrecision", "weightedRecall", "auc_hard")


def _long_metrics(wide: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return wide.unpivot(list(by), list(metrics), "metric", "value")


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R2 of ``(label, prediction)`` rows, in one aggregate."""
    error = F.col("label") - F.col("prediction")
    squares = F.avg(error * error)
    wide = predictions.groupBy(*by).agg(
        F.sqrt(squares).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(squares, F.var_pop("label"))).alias("r2"),
    )
    return _long_metrics(wide, by, REGRESSION_METRICS)


def confusion_matrix(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by..., label, prediction, n)``: one pass, one row per pair of classes."""
    return predictions.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))


def classification_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, class-weighted F1, precision and recall, and AUC of the hard prediction.

    All of them come from one confusion matrix. ``auc_hard`` is the area under the
    two-segment ROC curve of the 0/1 prediction, i.e. the mean recall of both classes.
    """
    n = F.col("n")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(0)
    as_label = F.struct(
        F.col("label").alias("class"), n.alias("support"), hit.alias("hits"), F.lit(0).alias("called")
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"), F.lit(0).alias("support"), F.lit(0).alias("hits"), n.alias("called")
    )
    classes = (
        confusion_matrix(predictions, by)
        .select(*by, F.inline(F.array(as_label, as_prediction)))
        .groupBy(*by, "class")
        .agg(F.sum("support").alias("support"), F.sum("hits").alias("hits"), F.sum("called").alias("called"))
    )
    hits, support, called = F.col("hits"), F.col("support"), F.col("called")
    recall = F.coalesce(F.try_divide(hits, support), F.lit(0.0))
    precision = F.coalesce(F.try_divide(hits, called), F.lit(0.0))

    def weighted(score: Column) -> Column:
        return F.sum(score * support) / F.sum(support)

    def recall_of(value: int) -> Column:
        return F.max(F.when(F.col("class") == value, F.try_divide(hits, support)))

    wide = classes.groupBy(*by).agg(
        (F.sum(hits) / F.sum(support)).alias("accuracy"),
        # 2pr / (p + r) = 2 hits / (support + called)
        weighted(F.coalesce(F.try_divide(2 * hits, support + called), F.lit(0.0))).alias("f1"),
        weighted(precision).alias("weightedPrecision"),
        weighted(recall).alias("weightedRecall"),
        ((recall_of(0) + recall_of(1)) / 2).alias("auc_hard"),
    )
    return _long_metrics(wide, by, CLASSIFICATION_METRICS)


def score_models(
    models: Mapping[object, Model],
    frame: DataFrame,
    name: str = "model",
    score_column: str = "rawPrediction",
) -> DataFrame:
    """Every model's prediction for every row, in one pass over ``frame``.

    Rows are ``(name, label, prediction)``, for classifiers with ``score``, the
    class-1 entry of ``rawPrediction`` or ``probability``.
    """
    wide, predictions = frame.select("label", "features"), []
    for i, (model_name, model) in enumerate(models.items()):
        outputs = {"predictionCol": f"prediction_{i}"}
        fields = [F.lit(model_name).alias(name), F.col(f"prediction_{i}").alias("prediction")]
        if isinstance(model, ClassificationModel):
            vectors = {"rawPrediction": f"raw_{i}", "probability": f"probability_{i}"}
            outputs |= {f"{column}Col": output for column, output in vectors.items()}
            score = vector_to_array(vectors[score_column])[1]
            fields.append(score.alias("score"))
        wide = model.transform(wide, {model.getParam(k): v for k, v in outputs.items()})
        predictions.append(F.struct(*fields))
    return wide.select("label", F.inline(F.array(*predictions)))


def auc_score(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve of ``score`` against a 0/1 ``label``.

    Equal scores are counted together first; the number of negatives scored lower
    is a running total over the distinct scores; the area is the share of
    (positive, negative) pairs in the right order, ties counting half.
    """
    positive = F.col("label") == 1
    scores = predictions.groupBy(*by, "score").agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranked = running_totals(scores, [F.asc("score")], {"neg_below": F.col("neg")}, by)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    won = F.sum(pos * (F.col("neg_below") + neg / 2))
    wide = ranked.groupBy(*by).agg(F.try_divide(won, F.sum(pos) * F.sum(neg)).alias("auc_score"))
    return _long_metrics(wide, by, ["auc_score"])
