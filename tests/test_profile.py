import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.functions import ratio
from tabml.operators import moments, profile
from tabml.operators.features import add_ratios, drop, rename
from tabml.operators.spec import FeatureSpec
from tabml.sources import load_table, read_csv, stage
from tabml.sources.staging import stage_path

NAN = float("nan")


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(1, 1.0, "b"), (2, None, "a"), (3, NAN, None), (4, 5.0, "a"), (None, 9.0, "b")]
    return spark.createDataFrame(rows, "i int, x double, s string")


def test_null_and_nan_are_missing(edges):
    counts = {r["column"]: r["n_missing"] for r in profile.missing_counts(edges).collect()}
    assert counts == {"i": 1, "x": 2, "s": 1}


def test_missing_counts_of_chosen_columns(edges):
    assert profile.missing_counts(edges, ["x"]).collect() == [("x", 2)]
    with pytest.raises(ValueError, match="no such column: y"):
        profile.missing_counts(edges, ["y"])


def test_describe_mixed_columns(edges):
    rows = {(r["column"], r["stat"]): r for r in profile.describe(edges, ["i", "s"]).collect()}
    assert rows["i", "mean"]["value"] == 2.5
    assert math.isclose(rows["i", "stddev"]["value"], math.sqrt(5 / 3))
    assert rows["s", "count"]["value"] == 4
    assert (rows["s", "min"]["text_value"], rows["s", "max"]["text_value"]) == ("a", "b")
    assert rows["s", "mean"]["value"] is None and rows["i", "max"]["text_value"] is None


def test_describe_agrees_with_builtin(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    builtin = {r["summary"]: r for r in orders.describe().collect()}
    for row in profile.describe(orders).collect():
        expected = builtin[row["stat"]][row["column"]]
        if row["text_value"] is not None:
            assert row["text_value"] == expected
        elif row["value"] is None:
            assert expected is None
        else:
            assert math.isclose(row["value"], float(expected), rel_tol=1e-12)


def test_missing_value_is_a_group(edges):
    sizes = {r["s"]: r["count"] for r in profile.category_sizes(edges, "s").collect()}
    assert sizes == {"a": 2, "b": 2, None: 1}


def test_group_count_ties_go_by_value(edges):
    ordered = [r["s"] for r in profile.group_count_desc(edges.dropna(subset=["s"]), "s").collect()]
    assert ordered == ["a", "b"]


def test_frequency_table_keeps_missing_values(edges):
    rows = {(r["column"], r["value"]): r["freq"] for r in profile.frequency_table(edges, ["s", "i"]).collect()}
    assert rows["s", None] == 1 and rows["s", "a"] == 2 and rows["i", "4"] == 1


def test_preview_is_in_order(edges):
    assert [r["i"] for r in profile.preview(edges, [F.desc("i")], 2).collect()] == [4, 3]


def test_column_profile(edges):
    spec = FeatureSpec(label="x", numeric=("i",), categorical=("s",))
    rows = {r["name"]: r for r in profile.column_profile(edges, spec).collect()}
    assert (rows["x"]["role"], rows["s"]["role"], rows["i"]["role"]) == ("label", "categorical", "numeric")
    assert (rows["x"]["pos"], rows["x"]["type"], rows["x"]["n_missing"], rows["x"]["n_rows"]) == (1, "double", 2, 5)


def test_correlation_of_constant_and_empty_columns(spark):
    rows = [(float(i), float(i * i), 7.0) for i in range(9)]
    frame = spark.createDataFrame(rows, "a double, b double, c double")

    def found(data):
        return {(r[0], r[1]): r[2] for r in moments.correlation_matrix(data, ["a", "b", "c"]).collect()}

    wide = found(frame)
    assert len(wide) == 9
    assert wide["c", "c"] is None and wide["a", "c"] is None and wide["a", "a"] == 1.0
    assert math.isclose(wide["a", "b"], np.corrcoef([r[0] for r in rows], [r[1] for r in rows])[0, 1])
    assert set(found(frame.limit(0)).values()) == {None}



def test_correlation_uses_complete_rows(spark):
    rows = [(1.0, 2.0, 1.0), (2.0, 4.0, 0.0), (3.0, 6.0, 5.0), (9.0, None, 1.0), (NAN, 1.0, 2.0)]
    frame = spark.createDataFrame(rows, "a double, b double, c double")
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in moments.correlation_matrix(frame, ["a", "b"]).collect()}
    assert math.isclose(corr["a", "b"], 1.0) and corr["a", "a"] == 1.0


def test_zero_divisor_and_missing_operand_give_null(spark):
    frame = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in frame.select(ratio("a", "b")).collect()] == [None, None, 1.5]
    assert [r["q"] for r in add_ratios(frame, {"q": ("a", "b")}).collect()] == [None, None, 1.5]


def test_rename_and_drop_reject_unknown_names(edges):
    assert rename(edges, {"x": "label"}).columns == ["i", "label", "s"]
    assert drop(edges, "i", "s").columns == ["x"]
    with pytest.raises(ValueError, match="nope"):
        rename(edges, {"nope": "label"})
    with pytest.raises(ValueError, match="nope"):
        drop(edges, "nope")


def test_spec_from_schema(edges):
    spec = FeatureSpec.from_schema(edges.schema, "x", ("s",))
    assert spec.numeric == ("i",)
    with pytest.raises(ValueError, match="without a role: s"):
        FeatureSpec.from_schema(edges.schema, "x")
    with pytest.raises(ValueError, match="no such column"):
        FeatureSpec(label="y", numeric=("i",)).check(edges)


def test_csv_schema_and_inference(spark, edges):
    path = stage_path(spark, "csv")
    edges.where("x IS NOT NULL").write.option("header", True).csv(path)
    typed = read_csv(spark, path, "i LONG, x DOUBLE, s STRING")
    assert dict(typed.dtypes) == {"i": "bigint", "x": "double", "s": "string"}
    assert dict(read_csv(spark, path).dtypes) == {"i": "int", "x": "double", "s": "string"}
    assert typed.count() == 4


def test_csv_header_that_disagrees_is_an_error(spark, edges):
    path = stage_path(spark, "csv")
    edges.write.option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, "i LONG, wrong DOUBLE, s STRING").collect()


def test_stage_keeps_rows_and_order(spark):
    staged = stage(spark.range(100, numPartitions=4).select(-F.col("id").alias("id")).toDF("id"), "t", sort_within=["id"])
    assert sorted(r["id"] for r in staged.collect()) == list(range(-99, 1))
