"""Input views over the driver tables.

``blocks`` plays the part of a housing table (one row per order, naturally
missing measures, one small category), ``docs`` that of a table with coded
categories and an unbalanced binary label, ``lines`` that of a long numeric
table with a learnable binary label.

Joins carry no hints: Spark broadcasts a side only when its statistics are under
``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits skewed
partitions of the sort-merge join otherwise. The line items are summed per order
before they meet the join, on the same key, so that sum and join share one
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.sources.tables import load_table

BLOCK_RATIOS = {
    "qty_per_line": ("total_qty", "n_lines"),
    "acctbal_per_qty": ("c_acctbal", "total_qty"),
    "price_per_line": ("o_totalprice", "n_lines"),
}


def blocks(spark: SparkSession, directory: str) -> DataFrame:
    orders = load_table(spark, directory, "orders")
    customer = load_table(spark, directory, "customer")
    per_order = (
        load_table(spark, directory, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("l_quantity").alias("total_qty"),
            F.sum("l_extendedprice").alias("total_ext"),
        )
    )
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
        .select(
            "o_orderkey",
            "o_orderpriority",
            "o_totalprice",
            F.year("o_orderdate").alias("o_year"),
            "c_acctbal",
            "n_lines",
            "total_qty",
            "total_ext",
        )
    )


def docs(spark: SparkSession, directory: str) -> DataFrame:
    documents = load_table(spark, directory, "documents")
    labels = load_table(spark, directory, "labels")
    return documents.join(labels, "doc_id").select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic"
    )


def lines(spark: SparkSession, directory: str) -> DataFrame:
    signal = F.col("l_quantity") + 5 * F.col("l_linenumber") > 45
    return load_table(spark, directory, "lineitem").withColumn("label", signal.cast("double"))
