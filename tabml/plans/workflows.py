"""The two modelled workloads from raw table to report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import Estimator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.operators import models
from tabml.operators.evaluate import classification_metrics, regression_metrics, score_models
from tabml.operators.features import feature_pipeline, training_frame
from tabml.operators.spec import FeatureSpec
from tabml.operators.split import train_test_split
from tabml.operators.tune import Candidate, compare_models, cross_validate, param_grid, stage_folds
from tabml.sources.staging import spread, stage

# The grids the workloads search.
FOREST_REGRESSION_GRID = {"maxDepth": [1, 5, 10], "numTrees": [5, 10, 15]}
LOGISTIC_GRID = {"regParam": [0.01, 0.05], "elasticNetParam": [0.01, 0.05]}
TREE_GRID = {"maxDepth": [5, 6, 7]}
FOREST_GRID = {
    "featureSubsetStrategy": ["auto", "all", "sqrt"],
    "minInstancesPerNode": [1, 2, 3],
}


@dataclass(frozen=True)
class Prepared:
    """``(key, label, features)`` frames of a split.

    ``vectors`` are the training rows as written, which cross-validation lays out by fold
    itself; ``train`` is their training layout, which is held from its first use on.
    """

    vectors: DataFrame
    test: DataFrame
    key: str
    partitions: int | None = None

    @cached_property
    def train(self) -> DataFrame:
        return spread(self.vectors, self.key, self.partitions)


def prepare(
    frame: DataFrame,
    spec: FeatureSpec,
    impute: Sequence[str] | None = None,
    prefit: bool = False,
    fraction: float = 0.8,
    restage: bool = True,
    unseen: str = "rarest",
    partitions: int | None = None,
) -> Prepared:
    """Split, then fit the feature pipeline on the training rows.

    ``prefit`` fits it on all rows before the split, which leaks test rows into
    medians, scales and category orders. A category that only the test rows have counts
    as the rarest of the training rows, unless ``unseen`` is "error".

    The training vectors are staged because every model reads them many times. So
    are the raw columns, which each fitted stage reads, unless ``restage`` says that
    ``frame`` is as good as a written table. ``partitions`` is that of ``spread``.
    """
    spec.check(frame)
    columns = [spec.key, spec.label, *spec.numeric, *spec.categorical]
    raw = frame.select(*columns).where(F.col(spec.label).isNotNull())
    if restage:
        raw = stage(raw, "input")
    train, test = train_test_split(raw, spec.key, fraction)
    pipeline = feature_pipeline(spec, impute, unseen=unseen).fit(raw if prefit else train)
    vectors = stage(training_frame(pipeline, train, spec), "train")
    return Prepared(vectors, training_frame(pipeline, test, spec), spec.key, partitions)


def regression_report(prepared: Prepared, estimators: Mapping[str, Estimator] | None = None) -> DataFrame:
    """``(model, metric, value)`` on the test rows, all models scored in one job."""
    estimators = estimators or {
        "linear": models.linear_regression(),
        "tree": models.tree_regression(),
        "forest": models.forest_regression(),
        "boosted": models.gbt_regression(),
    }
    fitted = {
        name: models.fit_linear(prepared.train, estimator)
        if isinstance(estimator, LinearRegression)
        else estimator.fit(prepared.train)
        for name, estimator in estimators.items()
    }
    return regression_metrics(score_models(fitted, prepared.test), ["model"])


def tuned_classifiers(
    prepared: Prepared,
    key: str,
    searches: Mapping[str, tuple[Estimator, Sequence[Candidate]]] | None = None,
) -> dict:
    """The best model of each search, chosen by cross-validated AUC of scores, on the same folds."""
    searches = searches or {
        "logistic": (models.logistic_regression(), param_grid(LOGISTIC_GRID)),
        "tree": (models.tree_classifier(), param_grid(TREE_GRID)),
        "forest": (models.forest_classifier(), param_grid(FOREST_GRID)),
    }
    staged = stage_folds(prepared.vectors, key)
    return {
        name: cross_validate(prepared.vectors, estimator, grid, "auc_score", key, staged=staged).best_model
        for name, (estimator, grid) in searches.items()
    }


def classification_report(fitted: Mapping[str, object], test: DataFrame, rank_by: str = "f1") -> DataFrame:
    """``(model, metric, value, rank)`` on the test rows, all models scored in one job."""
    metrics = classification_metrics(score_models(fitted, test), ["model"])
    return compare_models(metrics, rank_by)
