"""Fitted and unfitted pipelines come back from their files."""

import pytest
from pyspark.ml import Pipeline, PipelineModel

from tabml.operators import features
from tabml.plans.preparation import MATRIX
from tabml.sources import blocks, shared_dir, stage
from tabml.sources.views import BLOCK_RATIOS


@pytest.mark.parametrize("driver_bytes", [features.MAX_DRIVER_BYTES, 0])
def test_saved_pipelines_prepare_alike(spark, sf_dir, driver_bytes):
    frame = stage(features.add_ratios(blocks(spark, sf_dir), BLOCK_RATIOS), "saving")
    pipeline = features.feature_pipeline(MATRIX)
    for step in pipeline.getStages():
        if isinstance(step, features.CategoryIndexer):
            step.driver_bytes = driver_bytes
    path = f"{shared_dir(spark)}/saved-{driver_bytes}"
    pipeline.save(f"{path}-unfitted")
    fitted = Pipeline.load(f"{path}-unfitted").fit(frame)
    fitted.save(f"{path}-fitted")
    loaded = PipelineModel.load(f"{path}-fitted")
    wanted = features.CategoryJoinModel if driver_bytes == 0 else features.CategoryListModel
    assert any(isinstance(step, wanted) for step in loaded.stages)
    one, two = (features.slots(features.training_frame(m, frame, MATRIX), ["o_orderkey"]) for m in (fitted, loaded))
    assert one.count() > 0 and one.exceptAll(two).count() == two.exceptAll(one).count() == 0


def test_join_index_of_a_table_with_maps_and_dots(spark, monkeypatch):
    rows = [(1, {"a": 1}, "x", "p"), (2, {"a": 1}, "y", "q"), (3, {"b": 1}, "x", None), (4, {"b": 1}, None, "q")]
    frame = spark.createDataFrame(rows, "i int, m map<string,int>, `c.d` string, e string")
    indexer = features.CategoryIndexer(inputCols=["c.d", "e"], outputCols=["c_idx", "e_idx"], unseen="rarest")
    indexer.driver_bytes = 0
    want = [(1, 0.0, 1.0), (2, 1.0, 0.0), (3, 0.0, 1.0), (4, 1.0, 0.0)]
    for head in (features.HEAD_VALUES, 0):
        monkeypatch.setattr(features, "HEAD_VALUES", head)
        indexed = indexer.fit(frame).transform(frame)
        assert indexed.columns == ["i", "m", "c.d", "e", "c_idx", "e_idx"]
        assert [(r["i"], r["c_idx"], r["e_idx"]) for r in indexed.orderBy("i").collect()] == want


def test_join_index_moves_the_table_once(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        columns = ["l_partkey", "l_suppkey", "l_extendedprice"]
        indexer = features.CategoryIndexer(inputCols=columns, outputCols=[f"{c}_idx" for c in columns])
        indexer.driver_bytes = 0
        text = indexer.fit(lineitem).transform(lineitem)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Rows by number twice (the table and its indices), cells and mapping by text once each.
    assert text.count("Exchange hashpartitioning(_row") == 2
    assert text.count("Exchange hashpartitioning(_at") == 2
