"""Feature-preparation queries and their oracles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators import features
from tabml.operators.ranking import exact_medians
from tabml.operators.spec import FeatureSpec
from tabml.operators.split import fold_column, split_column, with_row_identity
from tabml.plans.oracle_views import BLOCKS, LABELLED, fold, in_train
from tabml.sources import blocks, docs, load_table, stage
from tabml.sources.views import BLOCK_RATIOS

KEY = "o_orderkey"
CATEGORY = "o_orderpriority"
NUMBERS = ["total_qty", "n_lines", "c_acctbal", "o_totalprice"]
CODES = ["l_returnflag", "l_linestatus", "l_linenumber"]
MANY = ["l_partkey", "l_suppkey", "l_extendedprice"]
MEDIAN_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]
# Predictors with missing values and a label without.
MATRIX = FeatureSpec(
    key=KEY,
    label="o_totalprice",
    numeric=("o_year", "c_acctbal", "n_lines", "total_qty", "total_ext", "acctbal_per_qty"),
    categorical=(CATEGORY,),
)
DOC_MATRIX = FeatureSpec(
    key="doc_id",
    label="toxic",
    numeric=("n_chars",),
    categorical=("lang", "source"),
    numeric_first=False,
)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks(spark, sf_dir).where(F.col("total_ext").isNotNull())


def _rounded(frame: DataFrame, digits: int, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns})


def ratio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_ratios = features.add_ratios(blocks(spark, sf_dir), BLOCK_RATIOS)
    return with_ratios.select(KEY, *BLOCK_RATIOS)


def rename_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = features.rename(blocks(spark, sf_dir), {"total_ext": "label"})
    return _rounded(features.drop(renamed, "c_acctbal", "o_year"), 2, "label")


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["total_qty", "acctbal_per_qty"]
    derived = features.add_ratios(blocks(spark, sf_dir), BLOCK_RATIOS).select(KEY, *columns)
    return features.median_imputer(columns).fit(derived).transform(derived)


def column_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Few rows per task, so that the search runs its narrowing rounds at any size.
    medians = exact_medians(load_table(spark, sf_dir, "lineitem"), MEDIAN_COLUMNS, direct_rows=100)
    return spark.createDataFrame(list(medians.items()), "column string, median double")


def assemble_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = features.assemble(_labelled(spark, sf_dir), NUMBERS)
    return features.slots(vectors, [KEY])


def assemble_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category codes put straight into a vector, without indexing."""
    codes = features.assemble(load_table(spark, sf_dir, "embeddings"), ["label"], "features_cat")
    return features.slots(codes, ["vec_id"], "features_cat")


def _scaled(spark: SparkSession, sf_dir: str, with_mean: bool) -> DataFrame:
    vectors = features.assemble(_labelled(spark, sf_dir), NUMBERS, "numbers")
    scaled = features.scaler("numbers", "scaled", with_mean).fit(vectors).transform(vectors)
    return _rounded(features.slots(scaled, [KEY], "scaled"), 5, "value")


def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, with_mean=False)


def standard_scale_centred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, with_mean=True)


def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = features.index_categories(blocks(spark, sf_dir), [CATEGORY])
    return indexed.select(KEY, CATEGORY, f"{CATEGORY}_idx")


def string_index_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = features.index_categories(load_table(spark, sf_dir, "lineitem"), CODES)
    return indexed.select("l_orderkey", *CODES, *[f"{c}_idx" for c in CODES])


def string_index_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with many values, indexed without bringing them to the driver."""
    lineitem = load_table(spark, sf_dir, "lineitem")
    indexer = features.CategoryIndexer(inputCols=["l_partkey"], outputCols=["l_partkey_idx"])
    indexer.driver_bytes = 0
    indexed = indexer.fit(lineitem).transform(lineitem)
    return indexed.select("l_orderkey", "l_linenumber", "l_partkey", "l_partkey_idx")


def string_index_join_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns with many values, all of them in one join."""
    lineitem = load_table(spark, sf_dir, "lineitem")
    indexer = features.CategoryIndexer(inputCols=MANY, outputCols=[f"{c}_idx" for c in MANY])
    indexer.driver_bytes = 0
    indexed = indexer.fit(lineitem).transform(lineitem)
    return indexed.select("l_orderkey", "l_linenumber", *MANY, *[f"{c}_idx" for c in MANY])


def index_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.category_mapping(load_table(spark, sf_dir, "lineitem"), CODES)


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = features.one_hot(blocks(spark, sf_dir), [CATEGORY])
    return features.slots(encoded, [KEY], f"{CATEGORY}_onehot")


def _matrix(frame: DataFrame, spec: FeatureSpec, impute: Sequence[str]) -> DataFrame:
    """Several fitted stages read the input, so it is staged before the first."""
    staged = stage(frame.select(spec.key, spec.label, *spec.numeric, *spec.categorical), "matrix")
    model = features.feature_pipeline(spec, impute).fit(staged)
    prepared = features.training_frame(model, staged, spec)
    return _rounded(features.slots(prepared, [spec.key, "label"]), 5, "value")


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = features.add_ratios(blocks(spark, sf_dir), BLOCK_RATIOS)
    return _matrix(derived, MATRIX, ["n_lines", "total_qty", "total_ext", "acctbal_per_qty"])


def feature_matrix_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix(docs(spark, sf_dir), DOC_MATRIX, [])


def feature_matrix_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared on the urgent half of the categories only: the others count as the rarest."""
    frame = stage(blocks(spark, sf_dir).where(F.col("n_lines").isNotNull()), "matrix")
    spec = FeatureSpec(key=KEY, label="o_totalprice", numeric=("n_lines",), categorical=(CATEGORY,))
    model = features.feature_pipeline(spec, impute=[]).fit(frame.where(F.col(CATEGORY) < "3"))
    prepared = features.training_frame(model, frame, spec)
    return _rounded(features.slots(prepared, [KEY, "label"]), 5, "value")


def split_no_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without a key and with many equal rows: each row is split on its own."""
    rows = with_row_identity(load_table(spark, sf_dir, "lineitem").select(*CODES))
    sides = split_column(fold_column(rows, "row_id"), "row_id")
    return sides.groupBy(*CODES, "split", "fold").agg(F.count("*").alias("n"))


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_column(blocks(spark, sf_dir), KEY).select(KEY, "split")


def fold_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_column(load_table(spark, sf_dir, "orders"), KEY).select(KEY, "fold")


QUERIES = {
    f.__name__: f
    for f in (
        ratio_features,
        rename_label,
        impute_median,
        column_medians,
        assemble_vector,
        assemble_codes,
        standard_scale,
        standard_scale_centred,
        string_index,
        string_index_multi,
        string_index_join,
        string_index_join_multi,
        index_labels,
        one_hot,
        feature_matrix,
        feature_matrix_codes,
        feature_matrix_unseen,
        split_no_key,
        train_test_split,
        fold_assignment,
    )
}


def _indexed_sql(source: str, column: str) -> str:
    """Rows ``(value, idx, freq)`` of one column, most frequent first."""
    return f"""SELECT {column}::VARCHAR AS value, count(*) AS freq,
  (row_number() OVER (ORDER BY count(*) DESC, {column}::VARCHAR) - 1)::DOUBLE AS idx
  FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}::VARCHAR"""


def _slot_rows(source: str, keys: str, values: Sequence[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, {slot} AS slot, {value} AS value FROM {source}"
        for slot, value in enumerate(values)
    )


def _median_sql(column: str, source: str) -> str:
    return f"(SELECT quantile_disc({column}, 0.5) FROM {source})"


def _scale_sql(column: str) -> str:
    return f"round({column} / stddev_samp({column}) OVER (), 5)"


def _onehot_sql(index: str, slot: int) -> str:
    return f"CASE WHEN {index} = {slot} THEN 1.0 ELSE 0.0 END::DOUBLE"


_RATIOS = ", ".join(f"{a} / nullif({b}, 0) AS {name}" for name, (a, b) in BLOCK_RATIOS.items())
_DERIVED = f"{BLOCKS}, derived AS (SELECT *, {_RATIOS} FROM blocks)"
_DOCS = """docs AS (SELECT doc_id, lang, source, n_chars, toxic
  FROM documents JOIN labels USING (doc_id))"""

ORACLES = {
    "ratio_features": f"WITH {_DERIVED} SELECT {KEY}, "
    + ", ".join(BLOCK_RATIOS)
    + " FROM derived",
    "rename_label": f"""WITH {BLOCKS} SELECT o_orderkey, o_orderpriority, o_totalprice, n_lines,
  total_qty, round(total_ext, 2) AS label FROM blocks""",
    "impute_median": f"""WITH {_DERIVED} SELECT {KEY},
  coalesce(total_qty, {_median_sql("total_qty", "derived")}) AS total_qty,
  coalesce(acctbal_per_qty, {_median_sql("acctbal_per_qty", "derived")}) AS acctbal_per_qty
FROM derived""",
    "column_medians": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", quantile_disc({c}, 0.5) AS median FROM lineitem"
        for c in MEDIAN_COLUMNS
    ),
    "assemble_vector": f"WITH {LABELLED} "
    + _slot_rows("labelled", KEY, [f"{c}::DOUBLE" for c in NUMBERS]),
    "assemble_codes": _slot_rows("embeddings", "vec_id", ["label::DOUBLE"]),
    "standard_scale": f"WITH {LABELLED} "
    + _slot_rows("labelled", KEY, [_scale_sql(c) for c in NUMBERS]),
    "standard_scale_centred": f"WITH {LABELLED} "
    + _slot_rows(
        "labelled",
        KEY,
        [f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 5)" for c in NUMBERS],
    ),
    "string_index": f"""WITH {BLOCKS}, mapping AS ({_indexed_sql("blocks", CATEGORY)})
SELECT {KEY}, {CATEGORY}, idx AS {CATEGORY}_idx FROM blocks JOIN mapping ON {CATEGORY} = value""",
    "string_index_multi": "WITH "
    + ", ".join(f"m_{c} AS ({_indexed_sql('lineitem', c)})" for c in CODES)
    + f" SELECT l_orderkey, {', '.join(CODES)}, {', '.join(f'm_{c}.idx AS {c}_idx' for c in CODES)}"
    + " FROM lineitem "
    + " ".join(f"JOIN m_{c} ON m_{c}.value = {c}::VARCHAR" for c in CODES),
    "string_index_join": f"""WITH mapping AS ({_indexed_sql("lineitem", "l_partkey")})
SELECT l_orderkey, l_linenumber, l_partkey, idx AS l_partkey_idx
FROM lineitem JOIN mapping ON l_partkey::VARCHAR = value""",
    "string_index_join_multi": "WITH "
    + ", ".join(f"m_{c} AS ({_indexed_sql('lineitem', c)})" for c in MANY)
    + f" SELECT l_orderkey, l_linenumber, {', '.join(MANY)}, {', '.join(f'm_{c}.idx AS {c}_idx' for c in MANY)}"
    + " FROM lineitem "
    + " ".join(f"JOIN m_{c} ON m_{c}.value = {c}::VARCHAR" for c in MANY),
    "feature_matrix_unseen": f"""WITH {BLOCKS}, used AS (SELECT * FROM blocks WHERE n_lines IS NOT NULL),
fitted AS (SELECT * FROM used WHERE {CATEGORY} < '3'), mapping AS ({_indexed_sql("fitted", CATEGORY)}),
coded AS (SELECT {KEY}, o_totalprice AS label, n_lines / (SELECT stddev_samp(n_lines) FROM fitted) AS scaled,
  coalesce(idx, (SELECT max(idx) FROM mapping)) AS idx FROM used LEFT JOIN mapping ON {CATEGORY} = value),
sizes AS (SELECT count(*) - 1 AS n FROM mapping)
SELECT {KEY}, label, slot::INTEGER AS slot, round(CASE WHEN slot = 0 THEN scaled ELSE (slot - 1 = idx)::INTEGER::DOUBLE END, 5) AS value
FROM coded, sizes, unnest(range(n + 1)) AS slots(slot)""",
    "split_no_key": f"""WITH numbered AS (
  SELECT *, md5(concat_ws('|', {", ".join(f"coalesce({c}::VARCHAR, chr(0))" for c in sorted(CODES))})) || '-'
    || row_number() OVER (PARTITION BY {", ".join(CODES)}) AS row_id FROM lineitem),
sides AS (SELECT *, CASE WHEN {in_train("row_id")} THEN 'train' ELSE 'test' END AS split, ({fold("row_id")})::INTEGER AS fold
  FROM numbered)
SELECT {", ".join(CODES)}, split, fold, count(*) AS n FROM sides GROUP BY ALL""",
    "index_labels": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", value, idx, freq FROM ({_indexed_sql('lineitem', c)})"
        for c in CODES
    ),
    "one_hot": f"""WITH {BLOCKS}, mapping AS ({_indexed_sql("blocks", CATEGORY)}),
coded AS (SELECT {KEY}, idx FROM blocks JOIN mapping ON {CATEGORY} = value) """
    + _slot_rows("coded", KEY, [_onehot_sql("idx", j) for j in range(4)]),
    "feature_matrix": f"WITH {_DERIVED}, mapping AS ({_indexed_sql('blocks', CATEGORY)}), "
    + f"imputed AS (SELECT {KEY}, o_totalprice AS label, idx, "
    + ", ".join(f"coalesce({c}, {_median_sql(c, 'derived')})::DOUBLE AS {c}" for c in MATRIX.numeric)
    + f" FROM derived JOIN mapping ON {CATEGORY} = value) "
    + _slot_rows(
        "imputed",
        f"{KEY}, label",
        [_scale_sql(c) for c in MATRIX.numeric] + [_onehot_sql("idx", j) for j in range(4)],
    ),
    # The slot count of a category is data: one less than its values.
    "feature_matrix_codes": f"""WITH {_DOCS},
langs AS ({_indexed_sql("docs", "lang")}), sources AS ({_indexed_sql("docs", "source")}),
coded AS (SELECT doc_id, toxic::DOUBLE AS label, langs.idx AS lang_idx, sources.idx AS source_idx,
  {_scale_sql("n_chars")} AS scaled
  FROM docs JOIN langs ON lang = langs.value JOIN sources ON source = sources.value),
sizes AS (SELECT (SELECT count(*) FROM langs) - 1 AS n_lang, (SELECT count(*) FROM sources) - 1 AS n_source)
SELECT doc_id, label, slot::INTEGER AS slot,
  CASE WHEN slot < n_lang THEN (slot = lang_idx)::INTEGER::DOUBLE
       WHEN slot < n_lang + n_source THEN (slot - n_lang = source_idx)::INTEGER::DOUBLE
       ELSE scaled END AS value
FROM coded, sizes, unnest(range(n_lang + n_source + 1)) AS slots(slot)""",
    "train_test_split": f"""WITH {BLOCKS}
SELECT {KEY}, CASE WHEN {in_train(KEY)} THEN 'train' ELSE 'test' END AS split FROM blocks""",
    "fold_assignment": f"SELECT {KEY}, ({fold(KEY)})::INTEGER AS fold FROM orders",
}
