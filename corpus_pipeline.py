"""The corpus pipeline: documents through five operators, each stage written before the next.

Every stage works on all that the stage before it kept. The rows of one ``doc_id`` are one
document. ``run`` gives the last stage's rows. Every stage reads whole texts of any length, gives
the same result for any layout of the files, and takes an empty table to an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from tabml.llm.common import col, semi_join, table
from tabml.sources.staging import stage, stage_path

#: Texts of a lower score go.
LEAST_QUALITY = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects.

    Texts without words (null, empty, blank) score 0 and go. Equal texts score alike, so
    repeated rows stay or go together, and a score of exactly ``LEAST_QUALITY`` stays. Other
    columns are neither read nor changed.
    """
    _, scorer = quality.fit(docs)
    return docs.filter(quality.score_column(docs, scorer) >= LEAST_QUALITY)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without repeated lines; documents whose lines are all repeated elsewhere go.

    ``n_chars`` follows the text where it was cut, other columns come back unchanged. A null text
    has no lines and stays. Of equal lines the first by key stays, then by text and position;
    rows that are equal in key and text are treated alike, and a null key sorts first.
    """
    cleaned = line_dedup.dedup_lines(docs, empty=False)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.length("text").cast(kind))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that of the smallest key.

    Rows without a key stay, as do null and empty texts, which link with nothing. All rows of
    the key that stays do, repeated ones too; other columns come back unchanged.
    """
    groups = stage(ngram_join.jaccard_components(docs), "groups")
    gone = groups.filter("doc_id != component_id").select("doc_id").distinct()
    return anti_join(docs, gone, "doc_id")


def anti_join(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``gone``, columns in their order."""
    kept = semi_join(docs, gone, key, how="left_anti")
    return kept.select(*[col(name) for name in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item.

    Null and empty texts hold nothing and stay; repeated rows go together. Columns come back as
    they were, whatever their names.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source at the same share of characters; ``copy`` numbers a document's copies.

    A null source is a source. A source without characters gives nothing, and rows equal in key
    and text draw alike. A table that has a column ``copy`` gets the number as ``copy_``.
    """
    return mixing.mix(docs, copy="copy")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: SQL cannot express the classifier, SimHash and the latent space; ``tests/llm/test_pipeline.py``
#: holds each stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = stage_path(spark, name)
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
