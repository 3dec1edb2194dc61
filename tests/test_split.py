import pytest
from pyspark.sql import functions as F

from tabml.operators.split import fold_column, random_split, split_column, train_test_split, with_row_identity
from tabml.sources import load_table


def test_split_is_a_partition_and_repeats(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = train_test_split(orders, "o_orderkey")
    assert train.intersect(test).count() == 0
    assert train.count() + test.count() == orders.count()
    assert abs(train.count() / orders.count() - 0.8) < 0.05
    again = train_test_split(orders.repartition(7), "o_orderkey")[0]
    assert again.exceptAll(train).count() == 0
    labelled = split_column(orders, "o_orderkey").where(F.col("split") == "train")
    assert labelled.drop("split").exceptAll(train).count() == 0


def test_rows_of_a_key_stay_together(spark, sf_dir):
    lineitem = load_table(spark, sf_dir, "lineitem")
    sides = split_column(lineitem, "l_orderkey").groupBy("l_orderkey").agg(F.count_distinct("split").alias("n"))
    assert sides.where("n > 1").count() == 0


def test_folds_are_even_and_independent_of_the_split(spark):
    folds = split_column(fold_column(spark.range(30_000), "id"), "id")
    counts = {(r["fold"], r["split"]): r["count"] for r in folds.groupBy("fold", "split").count().collect()}
    assert {fold for fold, _ in counts} == {0, 1, 2}
    for fold in range(3):
        assert abs(counts[fold, "train"] - 8000) < 300 and abs(counts[fold, "test"] - 2000) < 200


def test_random_split_with_a_seed(spark):
    frame = spark.range(1000)
    train, test = random_split(frame)
    assert train.count() + test.count() == 1000
    assert random_split(frame)[0].collect() == train.collect()


def test_unknown_key(spark):
    with pytest.raises(ValueError, match="no such column"):
        train_test_split(spark.range(3), "nope")


def test_rows_without_a_key_are_kept(spark):
    frame = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    train, test = train_test_split(frame, "k")
    assert train.count() + test.count() == 3
    assert fold_column(frame, "k").where("fold IS NULL").count() == 0


def test_rows_with_null_keys_are_split_by_their_other_columns(spark):
    frame = spark.range(1000).selectExpr("CAST(NULL AS INT) AS k", "id AS x")
    train, test = train_test_split(frame, "k")
    assert train.count() + test.count() == 1000 and 740 < train.count() < 860
    folds = {r["fold"]: r["count"] for r in fold_column(frame, "k").groupBy("fold").count().collect()}
    assert set(folds) == {0, 1, 2} and all(270 < n < 400 for n in folds.values())


def test_equal_rows_without_a_key_are_split_one_by_one(spark, monkeypatch):
    monkeypatch.setattr("tabml.operators.split.COPIES", 70)
    frame = spark.range(1000).selectExpr("CAST(NULL AS INT) AS k", "'same' AS `a.b`")
    train, test = train_test_split(frame, None)
    assert train.columns == ["k", "a.b"] and train.count() + test.count() == 1000
    assert 740 < train.count() < 860
    ids = with_row_identity(frame)
    assert ids.select("row_id").distinct().count() == 1000
    assert ids.exceptAll(with_row_identity(frame.repartition(7))).count() == 0
    with pytest.raises(ValueError, match="already"):
        with_row_identity(ids)


def test_null_and_empty_text_are_different_rows(spark):
    frame = spark.createDataFrame([(None, "x"), ("", "x"), ("", "x")], "a string, b string")
    assert sorted(r["n"] for r in with_row_identity(frame).groupBy(F.substring("row_id", 1, 32)).agg(F.count("*").alias("n")).collect()) == [1, 2]
