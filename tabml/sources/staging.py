"""Written intermediate tables: the one place where lineage is cut.

A staged table lives in the shared folder named by ``spark.checkpoint.dir``. It
is columnar, so later passes read only the columns they need, and it survives
the loss of any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a part of a training table, and parts that every one has.
ROWS_PER_PART, LEAST_PARTS = 500_000, 8

_local_dirs: dict[str, str] = {}
_held: list[DataFrame] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this application, below ``spark.checkpoint.dir``.

    Where the setting is missing, a single-machine session gets a temporary
    folder and a cluster session gets an error.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/tabml-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tabml-")
    return _local_dirs[app]


def spread(
    frame: DataFrame, key: str, partitions: int | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """The fixed training layout: parts by a hash of all columns, each sorted by key and that hash.

    Learners that sample rows or cut candidates do so part by part, so parts of a fixed
    number and order give the same model on any number of cores and for any layout of the
    files. The number follows from the rows alone, one part for ``ROWS_PER_PART`` and
    ``LEAST_PARTS`` at least, unless given; another number may give another model. All columns
    are hashed, as a key may be missing or frequent.

    The rows are shuffled once and held in memory, beyond it on the executors' disks, so that
    no fit and no pass of one shuffles them again; ``frame`` should be a written table, from
    which a lost part is made again. :func:`release` or :func:`drop_stages` lets go of them.
    ``columns`` are those that are held; the layout is the same with all others dropped.
    """
    partitions = partitions or max(LEAST_PARTS, -(-frame.count() // ROWS_PER_PART))
    # A map cannot be hashed.
    fields = [f for f in frame.schema.fields if "map<" not in f.dataType.simpleString()]
    row = F.xxhash64(*[F.col("`" + f.name.replace("`", "``") + "`") for f in fields])
    laid = frame.repartition(partitions, row).sortWithinPartitions(key, row)
    held = (laid.select(*columns) if columns else laid).persist()
    _held.append(held)
    return held


def release(frames: Sequence[DataFrame]) -> None:
    """Let go of what :func:`spread` holds."""
    for frame in frames:
        frame.unpersist()
        _held[:] = [other for other in _held if other is not frame]


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(
    frame: DataFrame,
    name: str,
    partition_by: str | None = None,
    sort_within: Sequence[str] = (),
) -> DataFrame:
    """Write ``frame`` to the shared folder and return it as read back.

    ``sort_within`` fixes the row order inside each file, so that samplers which
    draw row by row (bagging) repeat exactly when a task is run again.
    """
    spark = frame.sparkSession
    path = stage_path(spark, name)
    order = ([partition_by] if partition_by else []) + list(sort_within)
    writer = (frame.sortWithinPartitions(*order) if order else frame).write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def drop_stages(spark: SparkSession) -> bool:
    """Delete every table this application staged, and let go of the training tables."""
    release(list(_held))
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    hadoop_conf = spark.sparkContext._jsc.hadoopConfiguration()
    return path.getFileSystem(hadoop_conf).delete(path, True)
