import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabml.operators import models
from tabml.operators.evaluate import score_models
from tabml.operators.features import slots
from tabml.plans import modelling
from tabml.sources import load_table, spread, stage

SMALL = {"maxBins": 64, "seed": 1}


def as_arrays(frame):
    rows = [(r["label"], r["features"].toArray()) for r in frame.select("label", "features").collect()]
    return np.array([x for _, x in rows]), np.array([y for y, _ in rows])


def grow(x, y, depth, score):
    """Brute-force tree over every cut of every column; returns a predictor of rows."""
    cuts = [
        (column, (low + high) / 2)
        for column in range(x.shape[1])
        for low, high in zip(np.unique(x[:, column]), np.unique(x[:, column])[1:], strict=False)
    ]

    def node(rows, level):
        best = None
        if level:
            for column, cut in cuts:
                left = rows & (x[:, column] <= cut)
                right = rows & (x[:, column] > cut)
                if left.sum() >= 20 and right.sum() >= 20:
                    gain = score(y[left]) + score(y[right])
                    if gain > score(y[rows]) * (1 + 1e-12) and (best is None or gain > best[0] * (1 + 1e-12)):
                        best = (gain, column, cut, left, right)
        if best is None:
            mean = y[rows].mean()
            return lambda row: mean
        _, column, cut, left, right = best
        low, high = node(left, level - 1), node(right, level - 1)
        return lambda row: low(row) if row[column] <= cut else high(row)

    return node(np.ones(len(y), bool), depth)


def squares(y):
    return y.sum() ** 2 / len(y) if len(y) else 0.0


@pytest.fixture(scope="module")
def block_vectors(spark, sf_dir):
    return stage(spread(modelling.labelled_blocks(spark, sf_dir, ["n_lines", "o_year"]), "o_orderkey"), "blocks")


@pytest.fixture(scope="module")
def line_vectors(spark, sf_dir):
    return stage(modelling.labelled_lines(spark, sf_dir, ["l_quantity", "l_linenumber", "l_discount"]), "lines")


def test_tree_equals_brute_force(block_vectors):
    x, y = as_arrays(block_vectors)
    model = models.tree_regression(**SMALL, maxDepth=3, minInstancesPerNode=20).fit(block_vectors)
    expected = grow(x, y, 3, squares)
    got = np.array([r["prediction"] for r in model.transform(block_vectors).collect()])
    assert np.allclose(got, [expected(row) for row in x])


def test_boosting_equals_brute_force(block_vectors):
    x, y = as_arrays(block_vectors)
    model = models.gbt_regression(**SMALL, maxIter=3, maxDepth=2, minInstancesPerNode=20).fit(block_vectors)
    predicted, target, weight = np.zeros(len(y)), y, 1.0
    for _ in range(3):
        tree = grow(x, target, 2, squares)
        predicted = predicted + weight * np.array([tree(row) for row in x])
        target, weight = 2 * (y - predicted), 0.1
    got = np.array([r["prediction"] for r in model.transform(block_vectors).collect()])
    assert np.allclose(got, predicted)


def test_logistic_equals_newton(spark, sf_dir):
    # Without the line number, which would make the classes separable and the optimum infinite.
    vectors = stage(modelling.labelled_lines(spark, sf_dir, ["l_quantity", "l_discount"]), "lines")
    x, y = as_arrays(vectors)
    design = np.hstack([x, np.ones((len(y), 1))])
    beta = np.zeros(design.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ beta))
        beta += np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design, design.T @ (y - p))
    model = models.logistic_regression(tol=1e-9).fit(vectors)
    assert np.allclose(np.append(model.coefficients.toArray(), model.intercept), beta, rtol=1e-4, atol=1e-5)


def test_linear_equals_least_squares(block_vectors):
    x, y = as_arrays(block_vectors)
    beta, *_ = np.linalg.lstsq(np.hstack([x, np.ones((len(y), 1))]), y, rcond=None)
    model = models.fit_linear(block_vectors)
    assert np.allclose([*model.coefficients, model.intercept], beta)
    terms = {r["term"]: r["value"] for r in models.linear_terms(model, block_vectors, ["n", "year"]).collect()}
    assert np.isclose(terms["intercept"], beta[-1]) and terms["rmse"] > 0


def test_too_wide_for_the_closed_form(block_vectors, monkeypatch):
    closed = models.fit_linear(block_vectors)
    monkeypatch.setattr(models, "MAX_NORMAL_FEATURES", 1)
    with pytest.raises(ValueError, match="l-bfgs"):
        models.fit_linear(block_vectors)
    asked = models.linear_regression(solver="l-bfgs", maxIter=100, tol=1e-12)
    iterative = models.fit_linear(block_vectors, asked)
    assert np.allclose(iterative.coefficients, closed.coefficients, rtol=1e-4)


@pytest.mark.parametrize(
    ("make", "params"),
    [(models.tree_regression, {}), (models.forest_regression, {"numTrees": 5, "maxDepth": 4})],
)
def test_regression_predictions_stay_in_the_label_range(block_vectors, make, params):
    predictions = models.predict(make(**params).fit(block_vectors), block_vectors, ["o_orderkey"])
    row = predictions.agg(
        F.min("label"), F.max("label"), F.min("prediction"), F.max("prediction"), F.count("prediction")
    ).head()
    assert row[0] - 1e-6 <= row[2] <= row[3] <= row[1] + 1e-6 and row[4] == block_vectors.count()


@pytest.mark.parametrize(
    ("make", "params"),
    [(models.logistic_regression, {}), (models.tree_classifier, {}), (models.forest_classifier, {"numTrees": 5})],
)
def test_probabilities(line_vectors, make, params):
    model = make(**params).fit(line_vectors)
    predictions = models.predict(model, line_vectors, ["l_orderkey"])
    assert predictions.where("probability NOT BETWEEN 0 AND 1 OR prediction NOT IN (0, 1)").count() == 0
    assert predictions.count() == line_vectors.count()


def test_a_forest_repeats(spark, sf_dir):
    """Whatever the files are cut into: a read cuts them by cores."""

    def total(parts):
        frame = modelling.labelled_blocks(spark, sf_dir, ["n_lines", "o_year", "o_totalprice"])
        staged = spread(stage(frame.repartition(parts), "repeat"), "o_orderkey", 6)
        model = models.forest_regression(numTrees=5, maxDepth=4).fit(staged)
        return sorted(r["prediction"] for r in models.predict(model, staged, []).collect())

    assert total(1) == total(1) == total(5)


def test_spread_splits_missing_and_frequent_keys(spark):
    frame = spark.range(1000).selectExpr("CAST(NULL AS LONG) AS k", "id AS `a.b`", "map(id, id) AS m")
    parts = spread(frame, "k", 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 4 and min(r["count"] for r in parts) > 150


def test_embeddings_are_a_ready_feature_matrix(spark, sf_dir):
    embeddings = load_table(spark, sf_dir, "embeddings").select(
        "vec_id", (F.col("label") < 5).cast("double").alias("label"), array_to_vector("embedding").alias("features")
    )
    model = models.logistic_regression(regParam=0.1).fit(embeddings)
    assert model.numFeatures == 64
    assert slots(embeddings, ["vec_id"]).count() == 64 * embeddings.count()


def test_scoring_together_equals_scoring_alone(line_vectors):
    fitted = {
        "tree": models.tree_classifier().fit(line_vectors),
        "logistic": models.logistic_regression().fit(line_vectors),
    }
    together = score_models(fitted, line_vectors, score_column="probability")
    for name, model in fitted.items():
        alone = models.predict(model, line_vectors, []).withColumnRenamed("probability", "score")
        mine = together.where(F.col("model") == name).select("label", "prediction", "score")
        assert mine.exceptAll(alone).count() == 0 and mine.count() == alone.count()


def test_raw_prediction_of_a_tree_counts_rows(line_vectors):
    """Why tuning can rank trees by ``probability`` instead."""
    scored = models.tree_classifier(maxDepth=2).fit(line_vectors).transform(line_vectors)
    sizes = scored.groupBy("rawPrediction").count().collect()
    assert all(sum(r["rawPrediction"]) == r["count"] for r in sizes) and len(sizes) > 1
