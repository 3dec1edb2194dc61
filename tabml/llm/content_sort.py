"""Exact copies by sorting content: equal texts become neighbours and are compared in full."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.llm.common import arrow_map, col
from tabml.sources.staging import stage

#: Bytes of a text that the sampled splitters hold; a hash of the whole text follows them.
SPLITTER_BYTES = 48

_RUNS = pa.schema(
    [
        ("id", pa.int64()),
        ("n", pa.int64()),
        ("low", pa.int64()),
        ("high", pa.int64()),
        ("digest", pa.string()),
        ("fresh", pa.bool_()),
        ("part", pa.int32()),
        ("run", pa.int64()),
        ("edge", pa.bool_()),
        ("edge_content", pa.binary()),
    ]
)
_RUNS_DDL = (
    "id long, n long, low long, high long, digest string, fresh boolean, part int, run long, "
    "edge boolean, edge_content binary"
)


def _rows(ids: list, content: bytes, part: int, run: int, edge: bool) -> list[tuple]:
    """The rows of one run; ``ids`` is sorted, nulls first."""
    known = [i for i in ids if i is not None]
    low, high = (known[0], known[-1]) if known else (None, None)
    digest = hashlib.sha256(content).hexdigest()
    return [
        (
            key, len(ids), low, high, digest, place == 0 or key != ids[place - 1],
            part, run, edge, content if edge and place == 0 else None,
        )
        for place, key in enumerate(ids)
    ]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk a sorted partition and compare each text in full with the one before it."""
    part = TaskContext.get().partitionId()
    run, content, ids, out = 0, None, [], []

    def flush() -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RUNS, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=_RUNS)

    for rows in batches:
        for key, text in zip(rows["id"].to_pylist(), rows["content"].to_pylist(), strict=True):
            if text != content and content is not None:
                out += _rows(ids, content, part, run, edge=run == 0)
                run, ids = run + 1, []
                if len(out) >= 5000:
                    yield flush()
            content = text
            ids.append(key)
    if content is not None:
        out += _rows(ids, content, part, run, edge=True)
    if out:
        yield flush()


def content_groups(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    normalise: Callable[[Column], Column] | None = None,
    keep: str = "smallest",
) -> DataFrame:
    """Groups of equal texts: ``key, keep_id, group_size, kept, text_sha256``, a row per row.

    ``normalise`` maps the text column before it is compared. ``keep`` is ``smallest`` or
    ``largest``: which key of a group stays.

    Sampled splitters over (first bytes, hash of the whole text, key) range-partition the
    rows, so the sample is small however long the texts are, and a text that a third of all
    rows share is spread over many partitions. Inside a partition Spark's external sort puts
    equal texts next to each other. Only the first and the last run of a partition can go on
    in another one; their texts, two per partition at most, are grouped once more.

    Null text counts as empty. A null key sorts before all others and stays only in a group
    without any key. Rows equal in key and text are one document: the group counts each of
    them and one stays. An empty table gives no rows; other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep: smallest or largest")
    value = F.coalesce(col(text).cast("string"), F.lit(""))
    rows = docs.select(
        col(key).cast("long").alias("id"),
        (normalise(value) if normalise else value).cast("binary").alias("content"),
    )
    rows = rows.withColumns(
        {"head": F.substring("content", 1, SPLITTER_BYTES), "mark": F.xxhash64("content")}
    )
    ordered = rows.repartitionByRange("head", "mark", "id")
    ordered = ordered.sortWithinPartitions("head", "mark", "content", "id")
    runs = stage(arrow_map(ordered.select("id", "content"), _neighbours, _RUNS_DDL), "runs")

    same = Window.partitionBy("edge_content")
    totals = runs.filter("edge_content is not null").select(
        "part",
        "run",
        F.sum("n").over(same).alias("n"),
        F.min("low").over(same).alias("low"),
        F.max("high").over(same).alias("high"),
    )
    names = ["id", "digest", "fresh", "n", "low", "high"]
    edges = runs.filter("edge").drop("n", "low", "high").join(totals, ["part", "run"])
    whole = runs.filter("not edge").select(*names).union(edges.select(*names))
    keep_id = F.col("low" if keep == "smallest" else "high")
    return whole.select(
        F.col("id").alias(key),
        keep_id.alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("fresh") & F.col("id").eqNullSafe(keep_id)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
