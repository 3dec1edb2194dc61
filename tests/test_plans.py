"""What the plans must and must not contain."""

import re

import pytest

from __spark_entry__ import queries
from tabml.operators import features, profile
from tabml.plans import datasets, modelling, workflows
from tabml.sources import blocks, load_table, read_csv
from tabml.sources.staging import stage_path
from tabml.sources.views import BLOCK_RATIOS

LAZY = [
    "row_count", "filter_count", "describe_all", "multi_frequency", "missing_counts", "correlation_matrix",
    "group_avg", "ratio_features", "one_hot", "string_index_join", "train_test_split",
    "classification_metrics", "auc_score",
]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_workers_and_no_cross_join(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("function", [profile.missing_counts, profile.describe, profile.column_profile])
def test_profiling_all_columns_is_one_scan(spark, sf_dir, function):
    text = plan(function(load_table(spark, sf_dir, "orders")))
    assert len(re.findall(r"FileScan", text)) == 1


def test_frequency_table_is_one_scan_and_one_shuffle(spark, sf_dir):
    text = plan(profile.frequency_table(load_table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"]))
    assert len(re.findall(r"FileScan", text)) == 1 and len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert re.search(r"ReadSchema: struct<l_returnflag:string,l_linestatus:string>", text)


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    lineitem = load_table(spark, sf_dir, "lineitem")
    text = plan(profile.filtered_count(lineitem, lineitem.l_quantity > 49))
    assert "GreaterThan(l_quantity,49.0)" in text and "ReadSchema: struct<l_quantity:double>" in text


def test_blocks_share_the_shuffle_of_sum_and_join(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(blocks(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", text)) == 1


def test_housing_csv_through_the_regression_workload(spark, sf_dir):
    """The driver tables under the columns of the published housing file."""
    path = stage_path(spark, "housing")
    renamed = blocks(spark, sf_dir).where("total_ext IS NOT NULL").selectExpr(
        "o_orderkey", "o_totalprice AS longitude", "c_acctbal AS latitude", "o_year AS housing_median_age",
        "n_lines AS total_rooms", "IF(o_orderkey % 10 = 0, NULL, total_qty) AS total_bedrooms",
        "total_qty AS population", "n_lines AS households", "o_totalprice AS median_income",
        "total_ext AS median_house_value", "o_orderpriority AS ocean_proximity",
    )
    renamed.write.option("header", True).csv(path)
    raw = read_csv(spark, path, "o_orderkey LONG, " + datasets.HOUSING_SCHEMA)
    frame, spec = datasets.housing_table(raw, key="o_orderkey")
    assert len(spec.numeric) == 11 and spec.numeric[-3:] == tuple(datasets.HOUSING_RATIOS)
    missing = {r["column"]: r["n_missing"] for r in profile.missing_counts(frame, spec.numeric).collect()}
    assert {c for c, n in missing.items() if n} == set(datasets.HOUSING_IMPUTED)
    prepared = workflows.prepare(frame, spec, datasets.HOUSING_IMPUTED)
    report = workflows.regression_report(prepared, {"linear": modelling.models.linear_regression()})
    assert {r["metric"]: r["value"] for r in report.collect()}["r2"] > 0.5


def test_credit_spec_puts_one_hots_first(spark):
    rows = [(i, i % 2, *[float(i + j) for j in range(14)], *[str(i % 3) for _ in range(9)]) for i in range(60)]
    raw = spark.createDataFrame(rows, ["ID", "DEFAULT", *datasets.CREDIT_NUMBERS, *datasets.CREDIT_CATEGORIES])
    frame, spec = datasets.credit_table(raw)
    model = features.feature_pipeline(spec, impute=[]).fit(frame)
    slots = features.slots(features.training_frame(model, frame, spec), ["ID"]).collect()
    assert {r["slot"] for r in slots} == set(range(9 * 2 + 14))
    assert {r["value"] for r in slots if r["slot"] < 18} == {0.0, 1.0}


def test_ratios_are_imputed_after_they_are_derived(spark, sf_dir):
    derived = features.add_ratios(blocks(spark, sf_dir), BLOCK_RATIOS)
    columns = ["total_qty", "acctbal_per_qty"]
    model = features.median_imputer(columns).fit(derived)
    filled = model.transform(derived).where("n_lines IS NULL")
    assert filled.select("acctbal_per_qty").distinct().collect() == [(model.surrogates["acctbal_per_qty"],)]
