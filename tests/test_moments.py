import numpy as np
import pytest

from tabml.operators import moments


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 30)) @ rng.standard_normal((30, 30)) + 1e6
    x[:, 7] = 5.0
    names = [f"c.{k}" for k in range(30)]
    return spark.createDataFrame([tuple(map(float, r)) for r in x], names), x, names


def test_like_dense(table):
    frame, x, names = table
    found = moments.moments(frame, names)
    assert found.n == 400 and np.allclose(found.means, x.mean(axis=0))
    assert np.allclose(found.covariances(), np.cov(x.T), atol=1e-6)
    corr = {(r[0], r[1]): r[2] for r in moments.correlation_matrix(frame, names).collect()}
    assert corr["c.7", "c.7"] is None and corr["c.3", "c.3"] == 1.0 and len(corr) == 900
    assert abs(corr["c.1", "c.2"] - np.corrcoef(x[:, 1], x[:, 2])[0, 1]) < 1e-9


def test_components_like_dense(table):
    frame, x, names = table
    for standardise in (False, True):
        found = moments.principal_components(frame, names, 4, standardise)
        scales = np.where(x.std(axis=0, ddof=1) > 0, x.std(axis=0, ddof=1), 1) if standardise else np.ones(30)
        z = (x - x.mean(axis=0)) / scales
        values, vectors = np.linalg.eigh(np.cov(z.T))
        assert np.allclose(found.variances, values[::-1][:4])
        assert np.allclose(np.abs(np.sum(found.axes * vectors[:, ::-1][:, :4].T, axis=1)), 1)
        assert (found.axes[np.arange(4), np.abs(found.axes).argmax(axis=1)] > 0).all()
        projected = np.array(found.project(frame).select("pc1", "pc2", "pc3", "pc4").collect())
        # Rows keep their order here, as nothing is shuffled.
        assert np.allclose(projected, z @ found.axes.T, atol=1e-6)
        assert found.table(frame).count() == 120


def test_missing_and_too_few_rows(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, float("nan")), (4.0, 7.0)]
    frame = spark.createDataFrame(rows, "a double, b double")
    found = moments.principal_components(frame, ["a", "b"], 1)
    assert found.n == 2 and [r[0] is None for r in found.project(frame).select("pc1").collect()] == [False, True, True, False]
    assert {r["covar"] for r in moments.covariance_matrix(frame.limit(1), ["a", "b"]).collect()} == {None}
    with pytest.raises(ValueError, match="two complete rows"):
        moments.principal_components(frame.limit(0), ["a", "b"])


def test_two_hundred_columns(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 200))
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], [f"c{k}" for k in range(200)])
    assert np.allclose(moments.moments(frame, frame.columns).covariances(), np.cov(x.T))
