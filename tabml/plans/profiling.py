"""Profiling queries and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators import moments, profile
from tabml.operators.spec import FeatureSpec
from tabml.plans.oracle_views import BLOCKS
from tabml.sources import blocks, column_types, load_table, read_csv, read_csv_checked, register_view, write_csv
from tabml.sources.staging import stage_path

MEASURES = ["total_qty", "n_lines", "total_ext", "o_totalprice"]
CODES = ["l_returnflag", "l_linestatus", "l_linenumber"]
BLOCK_TYPES = {
    "o_orderkey": "bigint",
    "o_orderpriority": "string",
    "o_totalprice": "double",
    "o_year": "int",
    "c_acctbal": "double",
    "n_lines": "bigint",
    "total_qty": "double",
    "total_ext": "double",
}
BLOCK_ROLES = {"o_orderkey": "key", "o_orderpriority": "categorical", "total_ext": "label"}
CSV_SCHEMA = "o_orderkey BIGINT, o_orderpriority STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ"


def _rounded(frame: DataFrame, digits: int, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns})


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate"]
    path = stage_path(spark, "orders-csv")
    load_table(spark, sf_dir, "orders").select(*columns).write.option("header", True).csv(path)
    return read_csv(spark, path, CSV_SCHEMA)


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "orders-csv")
    orders = load_table(spark, sf_dir, "orders")
    orders.select("o_orderpriority", "o_totalprice").write.option("header", True).csv(path)
    inferred = read_csv(spark, path)
    return _rounded(
        profile.global_aggregates(
            inferred,
            {
                "n_rows": F.count("*"),
                "n_priorities": F.count_distinct("o_orderpriority"),
                "max_price": F.max("o_totalprice"),
                "avg_price": F.avg("o_totalprice"),
            },
        ),
        4,
        "avg_price",
    )


CSV_TYPES = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"


def _awkward_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the orders, some texts and numbers made hard to write as CSV."""
    n = F.col("o_orderkey") % 7
    text = F.when(n == 0, F.lit(None)).when(n == 1, "").when(n == 2, F.concat("o_orderpriority", F.lit(' "x", y')))
    return load_table(spark, sf_dir, "orders").withColumns(
        {
            "o_orderpriority": text.when(n == 3, F.concat(F.lit("a\nb,"), "o_orderpriority")).otherwise(F.col("o_orderpriority")),
            "o_totalprice": F.when(n != 4, F.col("o_totalprice")),
            "o_custkey": F.when(n != 5, F.col("o_custkey")).cast("long"),
        }
    )


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empty texts, quotes, separators and line ends come back as they were written."""
    path = stage_path(spark, "orders-csv")
    write_csv(_awkward_orders(spark, sf_dir), path)
    return read_csv_checked(spark, path, CSV_TYPES)[0]


def csv_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh order has a price that is no number: its line is set apart."""
    path = stage_path(spark, "orders-csv")
    broken = F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    write_csv(load_table(spark, sf_dir, "orders").select("o_orderkey", broken.alias("o_totalprice"), "o_orderstatus"), path)
    good, bad = read_csv_checked(spark, path, "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING")
    counted = good.select(F.lit("good").alias("part"), F.length("o_orderstatus").alias("size"))
    return counted.unionByName(bad.select(F.lit("bad").alias("part"), F.length("line").alias("size"))).groupBy("part").agg(
        F.count("*").alias("n"), F.sum("size").alias("size")
    )


def csv_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types that a reader infers from all lines."""
    path = stage_path(spark, "orders-csv")
    load_table(spark, sf_dir, "orders").write.option("header", True).csv(path)
    return column_types(read_csv(spark, path))


def multi_frequency_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sorted_frequency_table(load_table(spark, sf_dir, "lineitem"), CODES)


def describe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longs beyond the whole numbers of a double keep all their digits."""
    big = load_table(spark, sf_dir, "orders").select((F.col("o_orderkey") + F.lit(2**60 + 1)).alias("key.big"), "o_orderstatus")
    return profile.describe(big, exact=True).where(F.col("stat").isin("count", "min", "max")).select("column", "stat", "exact_value", "text_value")


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_count(blocks(spark, sf_dir))


def preview_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.preview(blocks(spark, sf_dir), ["o_orderkey"], 5)


def filter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.filtered_count(blocks(spark, sf_dir), F.col("total_qty") > 100)


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = blocks(spark, sf_dir)
    spec = FeatureSpec.from_schema(frame.schema, "total_ext", ("o_orderpriority",), "o_orderkey")
    return profile.column_profile(frame, spec)


def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = profile.describe(blocks(spark, sf_dir), MEASURES)
    return _rounded(described, 4, "value")


def describe_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.describe(blocks(spark, sf_dir)), 4, "value")


def global_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggregates = {
        "max_year": F.max("o_year"),
        "min_qty": F.min("total_qty"),
        "avg_ext": F.avg("total_ext"),
    }
    return _rounded(profile.global_aggregates(blocks(spark, sf_dir), aggregates), 4, "avg_ext")


def group_count_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.group_count_desc(blocks(spark, sf_dir), "o_orderpriority")


def category_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.category_sizes(blocks(spark, sf_dir), "o_orderpriority")


def multi_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.frequency_table(load_table(spark, sf_dir, "lineitem"), CODES)


def group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = profile.group_average(blocks(spark, sf_dir), "o_orderpriority", "total_ext")
    return _rounded(averages, 4, "avg_value")


def sql_group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = profile.sql_group_average(blocks(spark, sf_dir), "o_orderpriority", "total_ext")
    return _rounded(averages, 4, "avg_value")


def sql_view_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_view(blocks(spark, sf_dir), "blocks")
    return spark.sql(
        "SELECT o_orderpriority, round(avg(total_ext), 4) AS avg_value FROM blocks GROUP BY o_orderpriority"
    )


def missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_counts(blocks(spark, sf_dir))


def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(moments.correlation_matrix(blocks(spark, sf_dir), MEASURES), 8, "corr")


QUERIES = {
    f.__name__: f
    for f in (
        csv_scan,
        csv_scan_inferred,
        csv_round_trip,
        csv_bad_rows,
        csv_types,
        multi_frequency_sorted,
        describe_exact,
        row_count,
        preview_topn,
        filter_count,
        column_profile,
        describe_numeric,
        describe_all,
        global_agg,
        group_count_desc,
        category_sizes,
        multi_frequency,
        group_avg,
        sql_group_avg,
        sql_view_avg,
        missing_counts,
        correlation_matrix,
    )
}


def _describe_sql(source: str, columns: dict[str, str]) -> str:
    def one(column: str, stat: str) -> str:
        number, text = "any_value(NULL)", "any_value(NULL)"
        if stat == "count":
            number = f"count({column})"
        elif columns[column] == "string":
            if stat in ("min", "max"):
                text = f"{stat}({column})"
        else:
            function = {"mean": "avg", "stddev": "stddev_samp"}.get(stat, stat)
            number = f"round({function}({column}::DOUBLE), 4)"
        return (
            f"SELECT '{column}' AS \"column\", '{stat}' AS stat, CAST({number} AS DOUBLE) AS value, "
            f"CAST({text} AS VARCHAR) AS text_value FROM {source}"
        )

    stats = ("count", "mean", "stddev", "min", "max")
    return " UNION ALL ".join(one(column, stat) for column in columns for stat in stats)


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in MEASURES)
_GROUP_AVG = f"""WITH {BLOCKS}
SELECT o_orderpriority, round(avg(total_ext), 4) AS avg_value FROM blocks GROUP BY o_orderpriority"""
_SIZES = f"""WITH {BLOCKS}
SELECT o_orderpriority, count(*) AS count FROM blocks GROUP BY o_orderpriority"""

ORACLES = {
    "csv_scan": "SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderdate FROM orders",
    "csv_scan_inferred": """SELECT count(*) AS n_rows, count(DISTINCT o_orderpriority) AS n_priorities,
  max(o_totalprice) AS max_price, round(avg(o_totalprice), 4) AS avg_price FROM orders""",
    "csv_round_trip": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 5 THEN o_custkey END AS o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 7 <> 4 THEN o_totalprice END AS o_totalprice, o_orderdate,
  CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN o_orderpriority || ' "x", y'
    WHEN 3 THEN 'a' || chr(10) || 'b,' || o_orderpriority ELSE o_orderpriority END AS o_orderpriority
FROM orders""",
    "csv_bad_rows": """SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'bad' ELSE 'good' END AS part, count(*) AS n,
  CAST(sum(length(CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey || ',n/a,' || o_orderstatus ELSE o_orderstatus END)) AS BIGINT) AS size
FROM orders GROUP BY part""",
    "csv_types": "SELECT * FROM (VALUES "
    + ", ".join(
        f"({i}::INTEGER, '{name}', '{kind}')"
        for i, (name, kind) in enumerate(
            {"o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "string", "o_totalprice": "double",
             "o_orderdate": "timestamp", "o_orderpriority": "string"}.items()
        )
    )
    + ") AS types(pos, name, type)",
    "multi_frequency_sorted": f"""SELECT "column", value, count(*) AS freq FROM (
  UNPIVOT (SELECT {", ".join(f"{c}::VARCHAR AS {c}" for c in CODES)} FROM lineitem)
  ON {", ".join(CODES)} INTO NAME "column" VALUE value) GROUP BY "column", value ORDER BY "column", freq DESC, value""",
    "describe_exact": " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", '{stat}' AS stat, CAST({stat}({value}) AS VARCHAR) AS exact_value,
  {f"CAST({stat}({value}) AS VARCHAR)" if text and stat != "count" else "CAST(NULL AS VARCHAR)"} AS text_value FROM orders"""
        for name, value, text in (("key.big", f"o_orderkey + {2**60 + 1}", False), ("o_orderstatus", "o_orderstatus", True))
        for stat in ("count", "min", "max")
    ),
    "row_count": f"WITH {BLOCKS} SELECT count(*) AS n_rows FROM blocks",
    "preview_topn": f"WITH {BLOCKS} SELECT * FROM blocks ORDER BY o_orderkey LIMIT 5",
    "filter_count": f"WITH {BLOCKS} SELECT count(*) AS n_rows FROM blocks WHERE total_qty > 100",
    "column_profile": f"WITH {BLOCKS} "
    + " UNION ALL ".join(
        f"SELECT {i} AS pos, '{name}' AS name, '{kind}' AS type, "
        f"'{BLOCK_ROLES.get(name, 'numeric')}' AS role, count(*) - count({name}) AS n_missing, "
        "count(*) AS n_rows FROM blocks"
        for i, (name, kind) in enumerate(BLOCK_TYPES.items())
    ),
    "describe_numeric": f"WITH {BLOCKS} " + _describe_sql("blocks", {c: "number" for c in MEASURES}),
    "describe_all": f"WITH {BLOCKS} " + _describe_sql("blocks", BLOCK_TYPES),
    "global_agg": f"""WITH {BLOCKS}
SELECT max(o_year) AS max_year, min(total_qty) AS min_qty, round(avg(total_ext), 4) AS avg_ext
FROM blocks""",
    "group_count_desc": _SIZES + " ORDER BY count DESC, o_orderpriority",
    "category_sizes": _SIZES,
    "multi_frequency": f"""SELECT "column", value, count(*) AS freq FROM (
  UNPIVOT (SELECT {", ".join(f"{c}::VARCHAR AS {c}" for c in CODES)} FROM lineitem)
  ON {", ".join(CODES)} INTO NAME "column" VALUE value) GROUP BY "column", value""",
    "group_avg": _GROUP_AVG,
    "sql_group_avg": _GROUP_AVG,
    "sql_view_avg": _GROUP_AVG,
    "missing_counts": f"WITH {BLOCKS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing FROM blocks"
        for c in BLOCK_TYPES
    ),
    "correlation_matrix": f"WITH {BLOCKS}, complete AS (SELECT * FROM blocks WHERE {_COMPLETE}) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
        + f"round(corr({a}, {b}), 8) AS corr FROM complete"
        for a in MEASURES
        for b in MEASURES
    ),
}
