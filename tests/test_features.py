import numpy as np
import pytest
from pyspark.ml.feature import Imputer
from pyspark.sql import Row
from pyspark.sql import functions as F

from tabml.operators import features
from tabml.operators.ranking import exact_medians, running_totals
from tabml.operators.spec import FeatureSpec
from tabml.sources import load_table

NAN = float("nan")


def test_imputer_fills_null_and_nan_with_the_median(spark):
    frame = spark.createDataFrame([(x,) for x in (1.0, None, NAN, 5.0, 9.0, 11.0)], "a double")
    filled = features.median_imputer(["a"]).fit(frame).transform(frame)
    assert [r["a"] for r in filled.collect()] == [1.0, 5.0, 5.0, 5.0, 9.0, 11.0]
    builtin = Imputer(strategy="median", inputCols=["a"], outputCols=["a"], relativeError=0.0)
    assert builtin.fit(frame).transform(frame).collect() == filled.collect()


def test_imputer_with_an_error_is_the_builtin(spark):
    assert isinstance(features.median_imputer(["a"], 0.01), Imputer)


def test_imputer_keeps_fractions_of_an_integer_column(spark):
    frame = spark.createDataFrame([(1,), (None,), (5,), (2,)], "a int")
    assert [r["a"] for r in features.median_imputer(["a"]).fit(frame).transform(frame).collect()] == [1, 2, 5, 2]


def test_column_without_values_cannot_be_imputed(spark):
    frame = spark.createDataFrame([(None,), (NAN,)], "a double")
    model = features.median_imputer(["a"]).fit(frame)
    with pytest.raises(ValueError, match="no value in column a"):
        model.transform(frame)


@pytest.mark.parametrize("direct_rows", [1, 7, 1_000_000])
def test_medians_of_repeated_and_skewed_values(spark, direct_rows):
    rng = np.random.default_rng(0)
    columns = {
        "even": np.arange(20_000.0),
        "hot": np.where(rng.random(20_000) < 0.4, 3.25, rng.normal(0, 1e6, 20_000)),
        "hot_median": np.where(rng.random(20_000) < 0.6, 7.0, rng.random(20_000) * 100),
        "heavy": np.exp(rng.normal(0, 20, 20_000)),
        "two": (rng.random(20_000) < 0.5).astype(float),
    }
    import pandas as pd

    frame = spark.createDataFrame(pd.DataFrame(columns)).repartition(4)
    medians = exact_medians(frame, list(columns), direct_rows)
    for name, values in columns.items():
        assert medians[name] == np.sort(values)[(len(values) + 1) // 2 - 1], name


def test_running_totals_restart_per_group(spark):
    # More ranges than rows of a group, so that groups cross ranges and ranges hold several.
    rows = spark.range(3000).select(
        (F.col("id") % 3).alias("g"), F.col("id").alias("x"), (F.col("id") % 7).alias("w")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        result = running_totals(rows, [F.desc("x")], {"before": F.col("w"), "rank": F.lit(1)}, ["g"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(result) == 3000
    for g in range(3):
        total = 0
        for rank, row in enumerate(sorted((r for r in result if r["g"] == g), key=lambda r: -r["x"])):
            assert (row["before"], row["rank"]) == (total, rank)
            total += row["w"]


def test_assembler_rejects_null_and_nan(spark):
    for bad in (None, NAN):
        frame = spark.createDataFrame([(1.0,), (bad,)], "a double")
        with pytest.raises(Exception, match="(?i)null|nan"):
            features.assemble(frame, ["a"]).collect()


def test_index_ties_are_alphabetical(spark):
    frame = spark.createDataFrame([(s,) for s in "bbaaccd"], "s string")
    for bytes_allowed in (features.MAX_DRIVER_BYTES, 0):
        indexer = features.CategoryIndexer(inputCols=["s"], outputCols=["i"])
        indexer.driver_bytes = bytes_allowed
        indexed = indexer.fit(frame).transform(frame).distinct().collect()
        assert {r["s"]: r["i"] for r in indexed} == {"a": 0, "b": 1, "c": 2, "d": 3}


@pytest.mark.parametrize("bad", [None, "z"])
def test_missing_or_unseen_category_is_an_error(spark, bad):
    frame = spark.createDataFrame([("a",), ("b",)], "s string")
    other = spark.createDataFrame([("a",), (bad,)], "s string")
    for bytes_allowed in (features.MAX_DRIVER_BYTES, 0):
        indexer = features.CategoryIndexer(inputCols=["s"], outputCols=["i"])
        indexer.driver_bytes = bytes_allowed
        model = indexer.fit(frame)
        with pytest.raises(Exception, match="(?i)unseen|null"):
            model.transform(other).collect()


@pytest.mark.parametrize("driver_bytes", [features.MAX_DRIVER_BYTES, 0])
def test_unseen_category_counts_as_the_rarest(spark, driver_bytes):
    frame = spark.createDataFrame([(s,) for s in "aaabbc"], "s string")
    other = spark.createDataFrame([("a",), ("b",), (None,), ("zzz",)], "s string")
    indexer = features.CategoryIndexer(inputCols=["s"], outputCols=["i"], unseen="rarest")
    indexer.driver_bytes = driver_bytes
    indexed = indexer.fit(frame).transform(other)
    assert {r["s"]: r["i"] for r in indexed.collect()} == {"a": 0, "b": 1, None: 2, "zzz": 2}
    assert indexed.schema["i"].metadata == {"ml_attr": {"type": "nominal", "name": "i", "num_vals": 3}}


def test_joined_index_equals_string_indexer(spark, sf_dir, monkeypatch):
    """Values in the broadcast head, in the shuffled tail, a hot one, a long one."""
    monkeypatch.setattr(features, "HEAD_VALUES", 5)
    monkeypatch.setattr(features, "HEAD_TEXT_LENGTH", 3)
    lineitem = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_orderkey") % 3 == 0, "hot value").otherwise(F.col("l_partkey").cast("string")).alias("s"),
    )
    small = features.CategoryIndexer(inputCols=["s"], outputCols=["i"])
    large = features.CategoryIndexer(inputCols=["s"], outputCols=["i"])
    large.driver_bytes = 0
    expected, got = (e.fit(lineitem).transform(lineitem) for e in (small, large))
    assert expected.exceptAll(got).count() == 0 and got.exceptAll(expected).count() == 0


def test_one_hot_drops_the_rarest(spark):
    frame = spark.createDataFrame([(s,) for s in "aaabbc"], "s string")
    encoded = features.slots(features.one_hot(frame, ["s"]).distinct(), ["s"], "s_onehot").collect()
    assert {(r["s"], r["slot"]): r["value"] for r in encoded} == {
        ("a", 0): 1, ("a", 1): 0, ("b", 0): 0, ("b", 1): 1, ("c", 0): 0, ("c", 1): 0,
    }


def test_slot_order_follows_the_spec(spark):
    rows = [Row(k=i, y=float(i), n=float(i), c="ab"[i % 2]) for i in range(4)]
    frame = spark.createDataFrame(rows)
    for first, slot in ((True, 0), (False, 1)):
        spec = FeatureSpec(key="k", label="y", numeric=("n",), categorical=("c",), numeric_first=first)
        model = features.feature_pipeline(spec).fit(frame)
        rows = features.slots(features.training_frame(model, frame, spec), ["k"]).where(f"slot = {slot}")
        scaled = {r["k"]: r["value"] for r in rows.collect()}
        assert np.allclose([scaled[k] for k in range(4)], np.arange(4) / np.std(np.arange(4), ddof=1))


def test_rows_without_a_label_are_left_out(spark):
    frame = spark.createDataFrame([(1, 2.0, 1.0), (2, None, 3.0), (3, NAN, 2.0)], "k int, y double, n double")
    spec = FeatureSpec(key="k", label="y", numeric=("n",))
    model = features.feature_pipeline(spec).fit(frame)
    assert [r["k"] for r in features.training_frame(model, frame, spec).collect()] == [1]
