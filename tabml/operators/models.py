"""Estimators with the settings of the modelled workloads, and what is read off them.

Seeds are always set. Training itself is ``pyspark.ml``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 42
# The closed-form solver holds a square matrix of the features.
MAX_NORMAL_FEATURES = 4096


def linear_regression(**params) -> LinearRegression:
    """Closed-form least squares.

    ``maxIter`` is kept as a setting, but only the iterative solver reads it.
    """
    return LinearRegression(**{"solver": "normal", "maxIter": 10} | params)


def tree_regression(**params) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(**{"seed": SEED} | params)


def forest_regression(**params) -> RandomForestRegressor:
    defaults = {"numTrees": 25, "maxDepth": 10, "featureSubsetStrategy": "auto", "seed": SEED}
    return RandomForestRegressor(**defaults | params)


def gbt_regression(**params) -> GBTRegressor:
    return GBTRegressor(**{"maxIter": 10, "seed": SEED} | params)


def logistic_regression(**params) -> LogisticRegression:
    return LogisticRegression(**{"maxIter": 50} | params)


def tree_classifier(**params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(**{"seed": SEED} | params)


def forest_classifier(**params) -> RandomForestClassifier:
    return RandomForestClassifier(**{"numTrees": 50, "seed": SEED} | params)


def n_features(frame: DataFrame, column: str = "features") -> int | None:
    """Vector length from the column's attributes, without reading a row."""
    attributes = frame.schema[column].metadata.get("ml_attr", {})
    return attributes.get("num_attrs")


def fit_linear(frame: DataFrame, estimator: LinearRegression | None = None) -> LinearRegressionModel:
    """Fit; a table too wide for the closed form is refused, not fitted another way."""
    estimator = estimator or linear_regression()
    width = n_features(frame, estimator.getFeaturesCol())
    if width is None:
        first = frame.select(estimator.getFeaturesCol()).head()
        width = first[0].size if first else 0
    if estimator.getSolver() == "normal" and width > MAX_NORMAL_FEATURES:
        raise ValueError(
            f"{width} features are more than the closed form's {MAX_NORMAL_FEATURES}: "
            'choose solver="l-bfgs" and its maxIter'
        )
    return estimator.fit(frame)


def linear_terms(model: LinearRegressionModel, frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows ``(term, value)``: each coefficient, the intercept and the training RMSE."""
    rows = [(name, float(c)) for name, c in zip(names, model.coefficients, strict=True)]
    rows.append(("intercept", float(model.intercept)))
    rows.append(("rmse", float(model.summary.rootMeanSquaredError)))
    return frame.sparkSession.createDataFrame(rows, "term string, value double")


def predict(model: Model, frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys..., label, prediction[, probability])``, probability being that of class 1."""
    scored = model.transform(frame)
    columns = [*keys, "label", "prediction"]
    if "probability" in scored.columns:
        return scored.select(*columns, vector_to_array("probability")[1].alias("probability"))
    return scored.select(*columns)
