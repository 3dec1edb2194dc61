"""ROC and precision-recall curves over every distinct score, and their areas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.operators.ranking import running_totals
from tabml.sources.staging import stage


def _cumulated(predictions: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Per distinct score what it and the higher ones hold, and the totals of each group."""
    by = list(by)
    positive = F.col("label") == 1
    known = predictions.where(F.col("label").isNotNull() & F.col("score").isNotNull())
    scores = known.groupBy(*by, "score").agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    scores = stage(scores, "scores")
    ranked = running_totals(
        scores, [F.desc("score")], {"tp_above": F.col("pos"), "fp_above": F.col("neg")}, by
    )
    totals = scores.groupBy(*by).agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    if by:
        # The groups' names are on both sides, nulls as groups of their own.
        right = totals.select(*[F.col(name).alias(f"_of_{name}") for name in by], "positives", "negatives")
        same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in by])
        ranked = ranked.join(right, same).drop(*[f"_of_{name}" for name in by])
    else:
        row = totals.head()
        ranked = ranked.select("*", F.lit(row["positives"]).alias("positives"), F.lit(row["negatives"]).alias("negatives"))
    counted = ranked.select(
        *by,
        F.col("score").alias("threshold"),
        "pos",
        "neg",
        (F.col("tp_above") + F.col("pos")).alias("tp"),
        (F.col("fp_above") + F.col("neg")).alias("fp"),
        "positives",
        "negatives",
    )
    return counted, totals


def _thinned(curve: DataFrame, by: Sequence[str], x: str, y: str, points: int | None) -> DataFrame:
    """First and last point of every cell of a grid of ``points`` by ``points``.

    So a point that goes is within one cell, ``1 / points`` in both directions, of one that
    stays; how many points a stretch of the curve had does not matter. No order is needed.
    """
    if points is None:
        return curve
    if points < 1:
        raise ValueError(f"points is a positive number, not {points}")
    cells = [F.floor(F.col(axis) * points).alias(f"_cell_{axis}") for axis in (x, y)]
    names = [name for name in curve.columns if name not in by]
    whole = F.struct((F.col("tp") + F.col("fp")).alias("_at"), *names)
    grouped = curve.select(*by, *cells, whole.alias("_point")).groupBy(*by, f"_cell_{x}", f"_cell_{y}")
    ends = grouped.agg(F.min("_point").alias("first"), F.max("_point").alias("last"))
    kept = ends.select(*by, F.explode(F.array_distinct(F.array("first", "last"))).alias("_point"))
    return kept.select(*by, *[F.col(f"_point.{name}").alias(name) for name in names])


def roc_curve(predictions: DataFrame, by: Sequence[str] = (), points: int | None = None) -> DataFrame:
    """Rows ``(by..., threshold, pos, neg, tp, fp, fpr, tpr)``, one for each distinct ``score``.

    A point counts the rows that score ``threshold`` or higher; equal scores are one point, so
    ties are a slanted line. The start of the curve has a null threshold. ``pos`` and ``neg``
    are the rows at the threshold itself. Without rows of a class its rate is null. Rows without
    label or score are left out.

    ``points`` thins the curve by error: see :func:`_thinned`.
    """
    counted, totals = _cumulated(predictions, by)
    zero = F.lit(0).cast("long")
    kind = counted.schema["threshold"].dataType
    starts = totals.select(
        *by, F.lit(None).cast(kind).alias("threshold"), zero.alias("pos"), zero.alias("neg"), zero.alias("tp"),
        zero.alias("fp"), "positives", "negatives",
    )
    curve = counted.unionByName(starts.where("positives + negatives > 0")).select(
        *by,
        "threshold",
        "pos",
        "neg",
        "tp",
        "fp",
        F.try_divide("fp", "negatives").alias("fpr"),
        F.try_divide("tp", "positives").alias("tpr"),
    )
    return _thinned(curve, by, "fpr", "tpr", points)


def pr_curve(predictions: DataFrame, by: Sequence[str] = (), points: int | None = None) -> DataFrame:
    """Rows ``(by..., threshold, pos, neg, tp, fp, recall, precision)``, as :func:`roc_curve`.

    There is no point above the highest score, where no row is called positive.
    """
    counted, _ = _cumulated(predictions, by)
    curve = counted.select(
        *by,
        "threshold",
        "pos",
        "neg",
        "tp",
        "fp",
        F.try_divide("tp", "positives").alias("recall"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
    )
    return _thinned(curve, by, "recall", "precision", points)


def roc_area(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., area)`` of an unthinned ROC curve by trapezoids, in one aggregate.

    A trapezoid's sides are a point and the one before, which its own counts take it back to.
    """
    height = F.col("tp") - F.col("pos") / 2
    area = F.try_divide(F.sum(F.col("neg") * height), F.sum("pos").cast("double") * F.sum("neg"))
    return curve.groupBy(*by).agg(area.alias("area"))


def average_precision(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., average_precision)`` of an unthinned precision-recall curve: precision at each gain of recall."""
    gained = F.sum(F.col("pos") * F.col("precision"))
    return curve.groupBy(*by).agg(F.try_divide(gained, F.sum("pos")).alias("average_precision"))
