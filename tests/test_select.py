import math
import random

import numpy as np
from pyspark.ml.feature import StringIndexer
from pyspark.ml.stat import ChiSquareTest

from tabml.operators import features, select


def test_chi2_like_the_builtin(spark):
    draw = random.Random(5)
    rows = [(draw.choice("abc"), draw.choice("xyzw"), float(draw.randint(0, 2))) for _ in range(800)]
    rows = [(a if y or draw.random() < 0.5 else "a", b, y) for a, b, y in rows]
    frame = spark.createDataFrame(rows, "a string, b string, y double")
    own = {r["column"]: r for r in select.chi2_scores(frame, ["a", "b"], "y").collect()}
    indexed = StringIndexer(inputCols=["a", "b"], outputCols=["i", "j"]).fit(frame).transform(frame)
    builtin = ChiSquareTest.test(features.assemble(indexed, ["i", "j"]), "features", "y").first()
    for k, name in enumerate(("a", "b")):
        assert own[name]["freedom"] == builtin["degreesOfFreedom"][k] and own[name]["n"] == 800
        assert math.isclose(own[name]["statistic"], builtin["statistics"][k], rel_tol=1e-9)
        assert math.isclose(own[name]["p_value"], builtin["pValues"][k], rel_tol=1e-6, abs_tol=1e-12)


def test_anova_like_sums_of_squares(spark):
    draw = random.Random(6)
    rows = [(draw.gauss(0, 1) + (y == 1) * 0.3, draw.gauss(5, 2), y) for y in (draw.randint(0, 2) for _ in range(300))]
    frame = spark.createDataFrame(rows, "a double, b double, y int")
    own = {r["column"]: r for r in select.anova_scores(frame, ["a", "b"], "y").collect()}
    x = np.array(rows)
    for k, name in enumerate(("a", "b")):
        groups = [x[x[:, 2] == y, k] for y in range(3)]
        between = sum(len(g) * (g.mean() - x[:, k].mean()) ** 2 for g in groups) / 2
        statistic = between / (sum(((g - g.mean()) ** 2).sum() for g in groups) / 297)
        assert math.isclose(own[name]["statistic"], statistic, rel_tol=1e-9)
        # With 2 degrees of freedom between, the tail has a closed form.
        assert math.isclose(own[name]["p_value"], (1 + 2 * statistic / 297) ** -148.5, rel_tol=1e-8)
    assert select.best_columns(select.anova_scores(frame, ["a", "b"], "y"), 1) == ["a"]


def test_tails_like_sums():
    for x in (0.1, 1.0, 4.0, 30.0):
        assert math.isclose(select.chi2_tail(x, 2), math.exp(-x / 2), rel_tol=1e-10)
        assert math.isclose(select.chi2_tail(x, 1), math.erfc(math.sqrt(x / 2)), rel_tol=1e-9)
        # With 2 and k degrees of freedom the tail has a closed form.
        assert math.isclose(select.f_tail(x, 2, 7), (1 + 2 * x / 7) ** -3.5, rel_tol=1e-9)
    assert select.chi2_tail(0.0, 3) == 1.0 and select.f_tail(math.inf, 1, 5) == 0.0


def test_missing_constant_and_empty(spark):
    rows = [("a", None, 1.0, 0), ("a", None, float("nan"), 1), (None, None, 3.0, 1), ("a", None, 4.0, None)]
    frame = spark.createDataFrame(rows, "a string, b string, x double, y int")
    got = {r["column"]: tuple(r)[1:] for r in select.chi2_scores(frame, ["a", "b"], "y").collect()}
    assert got == {"a": (2, 0.0, 0, 1.0), "b": (0, None, 0, None)}
    assert tuple(select.anova_scores(frame, ["x"], "y").first())[1:] == (2, None, 1, 0, None)
    kept = {r["column"]: (r["variance"], r["kept"]) for r in select.variance_threshold(frame, ["x", "y"], 0.5).collect()}
    assert math.isclose(kept["x"][0], np.var([1.0, 3.0, 4.0], ddof=1)) and kept["x"][1] and not kept["y"][1]
    assert select.chi2_scores(frame.limit(0), ["a"], "y").first()["n"] == 0
