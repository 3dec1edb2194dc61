"""The operators as registered queries over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm import (
    chat,
    content_sort,
    decontaminate,
    language,
    line_dedup,
    minhash,
    mixing,
    ngram_join,
    pii,
    quality,
    repair,
    token_counts,
    whitening,
)
from tabml.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op4_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.content_groups(table(spark, sf_dir, "documents"), keep="largest")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), copy="copy")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.prefix_counts(table(spark, sf_dir, "documents"), limits=(2048,))
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"), "fits_2048"
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    return chat.read_back(chat.format_turns(turns.union(own))).drop("valid")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    _, scorer = quality.fit(docs)
    score = quality.score_column(docs, scorer)
    return docs.select("doc_id", score.alias("score")).withColumn("keep", F.col("score") >= 0.5)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, counts=True)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_pii,
        op2_decontaminate,
        op3_ngram_join,
        op4_content_sort,
        op5_mixing,
        op6_token_counts,
        op7_language,
        op8_chat,
        op9_quality,
        op10_line_dedup,
        op11_repair,
        op12_whitening,
        op13_minhash,
    )
}

def _jaccard_sql(words: int, percent: int, more: str = "") -> str:
    """Groups of texts linked by the Jaccard similarity of their shingle sets."""
    shingle = " || ' ' || ".join(["w[i]", *(f"w[i + {k}]" for k in range(1, words))])
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+') if x <> ''] AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([{shingle} for i in range(1, len(w) - {words - 2})]) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (
  SELECT DISTINCT a AS root, a AS node FROM links
  UNION
  SELECT r.root, l.b FROM reach r JOIN links l ON l.a = r.node),
least AS (SELECT root, min(node) AS component_id FROM reach GROUP BY root)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id{more}
FROM sets s LEFT JOIN least l ON l.root = s.doc_id"""


ORACLES = {
    "op3_ngram_join": _jaccard_sql(5, 75),
    "op13_minhash": _jaccard_sql(4, 80, ", s.doc_id = coalesce(l.component_id, s.doc_id) AS kept"),
    "op4_content_sort": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op5_mixing": """
WITH RECURSIVE counts AS (
  SELECT source, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS n_chars FROM documents GROUP BY source),
sized AS (SELECT source, n_chars, CASE WHEN n_chars > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weight FROM counts),
rates AS (
  SELECT source, CASE WHEN weight > 0 THEN weight / (SELECT sum(weight) FROM sized)
    * (SELECT CAST(sum(n_chars) AS DOUBLE) FROM sized) / n_chars ELSE 0 END AS rate FROM sized),
pieces AS (
  SELECT source, greatest(ceil(rate / 16.0), 1) AS pieces, rate / greatest(ceil(rate / 16.0), 1) AS mean FROM rates),
terms AS (
  SELECT source, pieces, mean, 0 AS j, exp(-mean) AS p, exp(-mean) AS c FROM pieces
  UNION ALL
  SELECT source, pieces, mean, j + 1, p * mean / (j + 1), c + p * mean / (j + 1) FROM terms WHERE j < 79),
draws AS (
  SELECT d.*, s.pieces, unnest(generate_series(1, CAST(s.pieces AS BIGINT))) AS i
  FROM documents d JOIN pieces s ON d.source IS NOT DISTINCT FROM s.source),
numbers AS (
  SELECT *, (CAST('0x' || left(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), chr(0)) || '|'
    || md5(coalesce(text, chr(0))) || '|' || i), 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM draws),
drawn AS (
  SELECT n.doc_id, n.text, n.lang, n.source, n.n_chars, n.i, count(*) FILTER (WHERE t.c < n.u) AS k
  FROM numbers n JOIN terms t ON n.source IS NOT DISTINCT FROM t.source
  GROUP BY ALL),
totals AS (SELECT doc_id, text, lang, source, n_chars, CAST(sum(k) AS BIGINT) AS k FROM drawn GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(generate_series(1, k)) AS INTEGER) AS copy
FROM totals WHERE k > 0""",
    "op8_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
written AS (
  SELECT *, role || chr(10) || text || chr(10) AS said,
    CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned,
    '### ' || CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
      ELSE '=' || replace(replace(replace(replace(role, '\', '\\'), '###', '#\##'), '</turn>', '<\/turn>'), ':', '\:') END
    || ': ' || replace(replace(replace(text, '\', '\\'), '###', '#\##'), '</turn>', '<\/turn>')
    || ' </turn>' || chr(10) AS formatted
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(said, '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(length(learned)) AS BIGINT) AS loss_chars,
  sha256(string_agg(learned, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id""",
}
