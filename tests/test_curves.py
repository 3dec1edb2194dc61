import math
import random

import pytest

from tabml.operators import curves
from tabml.operators.evaluate import auc_score

SCHEMA = "model string, label double, score double"


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(4)
    rows = [(m, float(draw.random() < 0.3), float(draw.randint(0, top))) for m, top in (("ties", 5), ("fine", 10**6)) for _ in range(700)]
    rows += [(None, 1.0, 2.0), (None, 0.0, 1.0), ("ties", None, 1.0), ("ties", 1.0, None), ("one", 1.0, 3.0)]
    return spark.createDataFrame(rows, SCHEMA), rows


def points(rows, model):
    own = [(s, y) for m, y, s in rows if m == model and y is not None and s is not None]
    p, n = sum(y for _, y in own), sum(1 - y for _, y in own)
    for t in [math.inf, *sorted({s for s, _ in own}, reverse=True)]:
        tp, fp = sum(y for s, y in own if s >= t), sum(1 - y for s, y in own if s >= t)
        yield t, int(tp), int(fp), fp / n if n else None, tp / p if p else None


def test_roc_like_counting(scored):
    frame, rows = scored
    got = curves.roc_curve(frame, ["model"]).collect()
    for model in ("ties", "fine", None, "one"):
        own = {(math.inf if r["threshold"] is None else r["threshold"], r["tp"], r["fp"], r["fpr"], r["tpr"]) for r in got if r["model"] == model}
        assert own == set(points(rows, model))


def test_area_is_the_auc(scored):
    frame, _ = scored
    known = frame.where("label is not null and score is not null")
    area = {r["model"]: r["area"] for r in curves.roc_area(curves.roc_curve(frame, ["model"]), ["model"]).collect()}
    auc = {r["model"]: r["value"] for r in auc_score(known, ["model"]).collect()}
    assert area.keys() == auc.keys() and area["one"] is None
    assert all(area[m] == auc[m] or math.isclose(area[m], auc[m]) for m in area)


def test_thinning_keeps_every_point_near(scored):
    frame, rows = scored
    fine = frame.where("model = 'fine'")
    thin = [(r["fpr"], r["tpr"]) for r in curves.roc_curve(fine, points=20).collect()]
    assert len(thin) <= 4 * 20 + 4 and (0.0, 0.0) in thin and (1.0, 1.0) in thin
    for _, _, _, x, y in points(rows, "fine"):
        assert min(max(abs(x - a), abs(y - b)) for a, b in thin) <= 1 / 20
    near = curves.pr_curve(fine, points=20).collect()
    assert len(near) < curves.pr_curve(fine).count()
    with pytest.raises(ValueError, match="positive"):
        curves.roc_curve(fine, points=0)


def test_average_precision(scored):
    frame, rows = scored
    got = curves.average_precision(curves.pr_curve(frame.where("model = 'ties'"))).first()[0]
    last, want = 0.0, 0.0
    for _, tp, fp, _, recall in points(rows, "ties"):
        if tp + fp:
            want += (recall - last) * tp / (tp + fp)
            last = recall
    assert math.isclose(got, want)


def test_empty(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert curves.roc_curve(nothing).count() == 0 and curves.pr_curve(nothing, ["model"], points=3).count() == 0
