"""Whitening next to a dense eigendecomposition."""

import numpy as np
import pytest

from tabml.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def dense(vectors, count=4):
    x = np.floor(256 * np.array(vectors))
    fit = np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    values, axes = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    order = np.argsort(values)[::-1]
    values, axes = values[order], axes[:, order]
    white = (x - mean) @ axes[:, :count] / np.sqrt(values[:count])
    whole = [[int(v) for v in row] for row in fit]
    sums = [sum(column) for column in zip(*whole, strict=True)]
    deviations = [sum((len(fit) * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return values, white, deviations, len(fit)


def check(spark, vectors, count=4):
    frame = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(vectors)], SCHEMA)
    got = whitening.whiten(frame).toPandas()
    values, white, deviations, n = dense(vectors, count)
    assert len(got) == count * len(vectors) and set(got["n"]) == {n}
    assert got["identity_error"].max() < 1e-9
    for k in range(count):
        own = got[got["component"] == k + 1].sort_values("vec_id")
        numbers = own["whitened"].to_numpy()
        sign = np.sign(numbers @ white[:, k])
        assert np.abs(sign * numbers - white[:, k]).max() < 1e-9
        assert own["deviation"].tolist() == deviations
        assert abs(own["explained"].iloc[0] / (values[k] / values.sum()) - 1) < 1e-10


def test_like_dense(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((300, 12)) * np.linspace(0.1, 3, 12) + rng.standard_normal(12)
    check(spark, np.concatenate([vectors, np.repeat(vectors[:1], 150, axis=0)]))


def test_vectors_of_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("embedding").collect()
    check(spark, [r[0] for r in rows])


def test_low_rank_and_equal_variances(spark):
    rng = np.random.default_rng(4)
    flat = rng.standard_normal((80, 2)) @ rng.standard_normal((2, 6)) * 40
    # Whole multiples of 1/256 keep the rank at two.
    frame = spark.createDataFrame([(k, [float(round(v)) for v in row[:2]] + [0.0] * 4) for k, row in enumerate(flat)], SCHEMA)
    got = whitening.whiten(frame).toPandas()
    assert sorted(set(got["component"])) == [1, 2] and got["identity_error"].max() < 1e-9
    corners = [(k, [float(k == j) - float(k == j + 4) for j in range(4)]) for k in range(8)]
    got = whitening.whiten(spark.createDataFrame(corners, SCHEMA)).toPandas()
    assert sorted(set(got["component"])) == [1, 2, 3, 4]
    assert np.allclose(got["explained"], 0.25) and got["identity_error"].max() < 1e-9


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], "a"), (1, [1.0, 2.0], "a"), (None, [3.0, 1.0], "b"), (2, None, "c"), (3, [], "c"), (4, [1.0, None], "c"),
        (5, [nan, 1.0], "c"), (6, [1.0, inf], "c"), (7, [1.0, 2.0, 3.0], "c"), (8, [1e300, -1e300], "c"), (9, [0.0, -0.001], "c"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string")
    got = whitening.whiten(frame).toPandas()
    assert sorted(got["vec_id"].fillna(-1)) == sorted([-1, 1, 1, 8, 9] * (len(got) // 5))
    assert got["deviation"].isna().any() and set(got["n"]) == {4}
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.whiten(frame.filter("vec_id = 1")).count() == 0


@pytest.mark.parametrize("steps", [6, 12])
def test_bidiagonal_form(spark, steps):
    rng = np.random.default_rng(5)
    x = rng.integers(-50, 50, (40, 12))
    fit = spark.createDataFrame([([int(v) for v in row],) for row in x], "x array<long>")
    mean = x.mean(axis=0)
    right, band = whitening.bidiagonal(fit, 12, mean, steps)
    assert np.abs(right.T @ right - np.eye(steps)).max() < 1e-12
    product = (x - mean) @ right
    assert np.abs(product.T @ product - band.T @ band).max() < 1e-8
