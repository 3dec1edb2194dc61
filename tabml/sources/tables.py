"""Table readers and named views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.sources.staging import stage


def load_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """CSV with a header line.

    With a schema the file is read once. Without one the column types are
    inferred, which costs an extra pass; ``sampling_ratio`` shortens that pass.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        # With enforceSchema off, a header that disagrees with the schema is an error.
        return reader.option("enforceSchema", False).schema(schema).csv(path)
    return reader.option("inferSchema", True).option("samplingRatio", sampling_ratio).csv(path)


#: Column that takes the text of a line which does not fit its schema.
BAD_LINE = "_bad_line"


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType | str
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit ``schema``, and the lines that do not, as ``(line)``.

    Quoted fields may hold separators, quotes and line ends; an empty field is null, and a
    quoted empty one the empty text. A line with too few or too many fields, or with one that
    is not of its type, is bad as a whole. The file is parsed once, with all its columns, and
    written as a staged table, as a reader that is asked for some columns judges only these.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if BAD_LINE in wanted.names:
        raise ValueError(f"{BAD_LINE} is the column for bad lines")
    whole = T.StructType([*wanted.fields, T.StructField(BAD_LINE, T.StringType())])
    reader = spark.read.options(
        header=True, multiLine=True, escape='"', emptyValue="", nullValue=None, mode="PERMISSIVE",
        columnNameOfCorruptRecord=BAD_LINE, enforceSchema=True,
    )
    rows = stage(reader.schema(whole).csv(path), "csv")
    good = rows.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
    return good, rows.where(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"))


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV with a header that :func:`read_csv_checked` reads back as it was."""
    frame.write.options(
        header=True, escape='"', emptyValue='""', nullValue=None, ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def column_types(frame: DataFrame) -> DataFrame:
    """Rows ``(pos, name, type)``, for instance of what a reader inferred."""
    rows = [(i, field.name, field.dataType.simpleString()) for i, field in enumerate(frame.schema)]
    return frame.sparkSession.createDataFrame(rows, "pos int, name string, type string")


def register_view(frame: DataFrame, name: str) -> DataFrame:
    """Make ``frame`` reachable from SQL under ``name``."""
    frame.createOrReplaceTempView(name)
    return frame
