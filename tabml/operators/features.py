"""Feature preparation: ratios, imputation, scaling, indexing, one-hot slots, vectors."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Params
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.functions import missing_to_null, named, ratio, require_columns
from tabml.operators.profile import frequency_table
from tabml.operators.ranking import exact_medians, running_totals
from tabml.operators.spec import FeatureSpec
from tabml.sources.staging import stage

# Category texts that StringIndexer may bring to the driver, all columns together.
MAX_DRIVER_BYTES = 64 * 1024 * 1024
# The most frequent values of a longer list, and the text length, that a join may broadcast.
HEAD_VALUES = 10_000
HEAD_TEXT_LENGTH = 256


# --- columns -----------------------------------------------------------------------------


def add_ratios(frame: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add ``name = numerator / denominator`` columns, null for a zero divisor."""
    require_columns(frame, [name for pair in ratios.values() for name in pair])
    return frame.withColumns({name: ratio(*pair) for name, pair in ratios.items()})


def rename(frame: DataFrame, names: Mapping[str, str]) -> DataFrame:
    require_columns(frame, names)
    return frame.withColumnsRenamed(dict(names))


def drop(frame: DataFrame, *names: str) -> DataFrame:
    require_columns(frame, names)
    return frame.drop(*names)


# --- saving ------------------------------------------------------------------------------


class _Writer(MLWriter):
    """Settings as metadata, and the parts that are tables or models of Spark's in folders beside it."""

    def __init__(self, instance: Params, data: dict, parts: Mapping[str, DataFrame | Model]):
        super().__init__()
        self.instance, self.data, self.parts = instance, data, parts

    def saveImpl(self, path: str) -> None:
        columns = {"inputCols": self.instance.getInputCols(), "outputCols": self.instance.getOutputCols()}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sc, extraMetadata={"data": columns | self.data})
        for name, part in self.parts.items():
            if isinstance(part, DataFrame):
                part.write.parquet(f"{path}/{name}")
            else:
                part.save(f"{path}/{name}")


class _Reader(MLReader):
    """Makes the instance from its metadata by ``make(path, data, spark)``."""

    def __init__(self, cls: type, make: Callable[[str, dict, SparkSession], Params]):
        super().__init__()
        self.cls, self.make = cls, make

    def load(self, path: str) -> Params:
        metadata = DefaultParamsReader.loadMetadata(path, self.sc)
        instance = self.make(path, metadata["data"], self.sparkSession)
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        return instance


# --- imputation --------------------------------------------------------------------------


class MedianImputer(Estimator, HasInputCols, HasOutputCols, MLWritable, MLReadable):
    """Fill null and NaN with the exact median of the column.

    ``Imputer`` with ``relativeError=0`` would gather every distinct value on the
    driver; this one finds the same medians with aggregates of fixed size.
    """

    @keyword_only
    def __init__(self, *, inputCols: list[str], outputCols: list[str]):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        model = MedianImputerModel(exact_medians(dataset, self.getInputCols()))
        return self._copyValues(model)

    def write(self) -> MLWriter:
        return _Writer(self, {}, {})

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls, lambda path, data, spark: cls(inputCols=data["inputCols"], outputCols=data["outputCols"]))


class MedianImputerModel(Model, HasInputCols, HasOutputCols, MLWritable, MLReadable):
    def __init__(self, surrogates: dict[str, float | None]):
        super().__init__()
        self.surrogates = surrogates

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = {}
        for source, target in zip(self.getInputCols(), self.getOutputCols(), strict=True):
            if self.surrogates[source] is None:
                raise ValueError(f"no value in column {source} to take a median of")
            present = missing_to_null(dataset, source).cast("double")
            filled[target] = F.coalesce(present, F.lit(self.surrogates[source]))
        return dataset.withColumns(filled)

    def write(self) -> MLWriter:
        return _Writer(self, {"surrogates": self.surrogates}, {})

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls, lambda path, data, spark: cls(data["surrogates"]))


def median_imputer(
    columns: Sequence[str], relative_error: float | None = None
) -> MedianImputer | Imputer:
    """In-place median imputer: exact, or approximate when an error is given."""
    columns = list(columns)
    if relative_error is None:
        return MedianImputer(inputCols=columns, outputCols=columns)
    return Imputer(
        strategy="median", inputCols=columns, outputCols=columns, relativeError=relative_error
    )


# --- categories --------------------------------------------------------------------------


def fits_on_driver(frame: DataFrame, columns: Sequence[str], limit: int) -> bool:
    """Whether the distinct texts of ``columns`` surely take less than ``limit`` bytes."""
    row = frame.agg(
        *[
            (F.approx_count_distinct(text) * F.max(F.octet_length(text))).alias(f"b{i}")
            for i, text in enumerate(named(c).cast("string") for c in columns)
        ]
    ).head()
    # The estimate is within a few percent; a factor of two is a safe margin.
    return 2 * sum(size or 0 for size in row) <= limit


def category_mapping(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, value, idx, freq)``: the most frequent value has index 0.

    Ties go by the text. Nothing passes through the driver, so a column may have
    any number of values.
    """
    counts = frequency_table(frame, columns).where(F.col("value").isNotNull())
    ranked = running_totals(
        counts, [F.desc("freq"), F.asc("value")], {"idx": F.lit(1)}, by=["column"]
    )
    return ranked.select("column", "value", F.col("idx").cast("double").alias("idx"), "freq")


class CategoryIndexer(Estimator, HasInputCols, HasOutputCols, MLWritable, MLReadable):
    """``StringIndexer`` by frequency, without a bound on the number of values.

    Where the values fit on the driver this *is* ``StringIndexer``. Beyond, the
    mapping stays a staged table and indexing is a join. Both give the same column: the
    same numbers, and an attribute with how many values there are.

    A value that is missing or was not there when the index was learned is an error, or
    with ``unseen="rarest"`` counts as the rarest category, the one of the last index.
    """

    @keyword_only
    def __init__(self, *, inputCols: list[str], outputCols: list[str], unseen: str = "error"):
        super().__init__()
        if unseen not in ("error", "rarest"):
            raise ValueError(f"unseen is 'error' or 'rarest', not {unseen!r}")
        self.driver_bytes = MAX_DRIVER_BYTES
        self.unseen = unseen
        self._set(inputCols=inputCols, outputCols=outputCols)

    def _fit(self, dataset: DataFrame) -> Model:
        columns = self.getInputCols()
        if fits_on_driver(dataset, columns, self.driver_bytes):
            indexer = StringIndexer(
                inputCols=columns,
                outputCols=self.getOutputCols(),
                stringOrderType="frequencyDesc",
                handleInvalid="error" if self.unseen == "error" else "keep",
            ).fit(dataset)
            sizes = [len(labels) for labels in indexer.labelsArray]
            return self._copyValues(CategoryListModel(indexer, sizes))
        mapping = stage(category_mapping(dataset, columns), "categories")
        found = dict(mapping.groupBy("column").agg(F.count("*")).collect())
        sizes = [found.get(column, 0) for column in columns]
        return self._copyValues(CategoryJoinModel(mapping, sizes, self.unseen))

    def write(self) -> MLWriter:
        return _Writer(self, {"unseen": self.unseen, "driver_bytes": self.driver_bytes}, {})

    @classmethod
    def read(cls) -> MLReader:
        def make(path: str, data: dict, spark: SparkSession) -> CategoryIndexer:
            indexer = cls(inputCols=data["inputCols"], outputCols=data["outputCols"], unseen=data["unseen"])
            indexer.driver_bytes = data["driver_bytes"]
            return indexer

        return _Reader(cls, make)


def _index_column(value: Column, name: str, size: int) -> Column:
    """An index under its name, with the attribute that says how many values it may have."""
    attribute = {"type": "nominal", "name": name, "num_vals": size}
    return value.alias(name, metadata={"ml_attr": attribute})


class CategoryListModel(Model, HasInputCols, HasOutputCols, MLWritable, MLReadable):
    """A fitted ``StringIndexer``; what it keeps as unknown becomes the last index."""

    def __init__(self, indexer: Model, sizes: list[int]):
        super().__init__()
        self.indexer, self.sizes = indexer, sizes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        indexed = self.indexer.transform(dataset)
        last = {name: float(max(0, n - 1)) for name, n in zip(self.getOutputCols(), self.sizes, strict=True)}
        sizes = dict(zip(self.getOutputCols(), self.sizes, strict=True))
        return indexed.select(
            *[
                _index_column(F.least(F.col(name), F.lit(last[name])), name, sizes[name]) if name in sizes else F.col(name)
                for name in indexed.columns
            ]
        )

    def write(self) -> MLWriter:
        return _Writer(self, {"sizes": self.sizes}, {"indexer": self.indexer})

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls, lambda path, data, spark: cls(StringIndexerModel.load(f"{path}/indexer"), data["sizes"]))


class CategoryJoinModel(Model, HasInputCols, HasOutputCols, MLWritable, MLReadable):
    """Looks the categories of all columns up in one mapping table.

    The cells ``(row, column, text)`` of all columns are unpivoted together. Frequent values, a
    list of bounded size, are looked up in a broadcast; the cells that are left meet the
    mapping in one shuffle, where no text can fill more than one part in ``HEAD_VALUES`` of a
    column unless it is longer than ``HEAD_TEXT_LENGTH``, which adaptive execution splits. The
    indices are put together by row before their shuffle, and the table itself, written first
    so that its rows can be numbered, is moved once, however many columns are indexed.
    """

    def __init__(self, mapping: DataFrame, sizes: list[int], unseen: str):
        super().__init__()
        self.mapping, self.sizes, self.unseen = mapping, sizes, unseen

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sources, targets = self.getInputCols(), self.getOutputCols()
        numbered = stage(dataset.withColumn("_row", F.monotonically_increasing_id()), "indexed-rows")
        cells = numbered.select(
            "_row",
            F.inline(F.array(*[
                F.struct(F.lit(i).alias("_at"), named(c).cast("string").alias("_text")) for i, c in enumerate(sources)
            ])),
        ).where(F.col("_text").isNotNull())
        at = F.create_map(*[F.lit(x) for i, c in enumerate(sources) for x in (c, i)])
        mapping = self.mapping.select(at[F.col("column")].alias("_at"), F.col("value").alias("_text"), F.col("idx").alias("_idx"))
        mapping = mapping.where(F.col("_at").isNotNull())
        is_head = (F.col("_idx") < HEAD_VALUES // len(sources)) & (F.length("_text") <= HEAD_TEXT_LENGTH)
        headed = cells.join(F.broadcast(mapping.where(is_head)), ["_at", "_text"], "left")
        answered = headed.where(F.col("_idx").isNotNull()).select("_row", "_at", "_idx")
        rest = headed.where(F.col("_idx").isNull()).select("_row", "_at", "_text")
        looked_up = rest.join(mapping.where(~is_head), ["_at", "_text"]).select("_row", "_at", "_idx")
        by_row = answered.unionByName(looked_up).groupBy("_row").agg(
            *[F.max(F.when(F.col("_at") == i, F.col("_idx"))).alias(f"_idx{i}") for i in range(len(sources))]
        )
        indexed = numbered.join(by_row, "_row", "left")
        columns = []
        for i, (source, target, size) in enumerate(zip(sources, targets, self.sizes, strict=True)):
            unknown = F.lit(float(max(0, size - 1)))
            if self.unseen == "error":
                text = F.coalesce(named(source).cast("string"), F.lit("null"))
                unknown = F.raise_error(F.concat(F.lit(f"missing or unseen value in {source}: "), text)).cast("double")
            columns.append(_index_column(F.coalesce(F.col(f"_idx{i}"), unknown), target, size))
        return indexed.select(*[named(c) for c in dataset.columns if c not in targets], *columns)

    def write(self) -> MLWriter:
        return _Writer(self, {"sizes": self.sizes, "unseen": self.unseen}, {"mapping": self.mapping})

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls, lambda path, data, spark: cls(spark.read.parquet(f"{path}/mapping"), data["sizes"], data["unseen"]))


def index_categories(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_idx`` for each column."""
    require_columns(frame, columns)
    return _indexer(columns).fit(frame).transform(frame)


def _indexer(columns: Sequence[str], unseen: str = "error") -> CategoryIndexer:
    return CategoryIndexer(inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], unseen=unseen)


def _encoder(columns: Sequence[str]) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns],
        outputCols=[f"{c}_onehot" for c in columns],
        dropLast=True,
    )


def one_hot(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_onehot`` vectors of k-1 slots; the rarest category is all zeros."""
    return category_pipeline(columns).fit(frame).transform(frame)


# --- vectors and pipelines ---------------------------------------------------------------


def assemble(frame: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """One vector column; a missing value is an error."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(frame)


def scaler(input_col: str, output_col: str, with_mean: bool = False) -> StandardScaler:
    """Divide by the sample standard deviation; centring is opt-in."""
    return StandardScaler(
        inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=True
    )


def numeric_pipeline(
    columns: Sequence[str],
    impute: Sequence[str] = (),
    relative_error: float | None = None,
    with_mean: bool = False,
) -> Pipeline:
    """Impute in place, assemble into ``numbers``, scale into ``scaled``."""
    stages = [median_imputer(impute, relative_error)] if impute else []
    stages.append(VectorAssembler(inputCols=list(columns), outputCol="numbers"))
    stages.append(scaler("numbers", "scaled", with_mean))
    return Pipeline(stages=stages)


def category_pipeline(columns: Sequence[str], unseen: str = "error") -> Pipeline:
    """Index by frequency into ``<c>_idx``, encode into ``<c>_onehot``."""
    return Pipeline(stages=[_indexer(columns, unseen), _encoder(columns)])


def feature_pipeline(
    spec: FeatureSpec,
    impute: Sequence[str] | None = None,
    relative_error: float | None = None,
    with_mean: bool = False,
    unseen: str = "rarest",
) -> Pipeline:
    """Everything from raw columns to the ``features`` vector, as one flat pipeline.

    ``impute`` defaults to all numeric columns. Categories that only other rows have, and
    missing ones, count as the rarest; ``unseen="error"`` refuses them.
    """
    impute = spec.numeric if impute is None else impute
    numbers = numeric_pipeline(spec.numeric, impute, relative_error, with_mean)
    stages, onehots = list(numbers.getStages()), [f"{c}_onehot" for c in spec.categorical]
    if spec.categorical:
        stages += category_pipeline(spec.categorical, unseen).getStages()
    inputs = ["scaled", *onehots] if spec.numeric_first else [*onehots, "scaled"]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return Pipeline(stages=stages)


def training_frame(model: PipelineModel, frame: DataFrame, spec: FeatureSpec) -> DataFrame:
    """``(key, label, features)``, with the label as a double and rows without one left out."""
    spec.check(frame)
    label = missing_to_null(frame, spec.label).cast("double")
    labelled = frame.withColumn(spec.label, label).where(F.col(spec.label).isNotNull())
    key = [F.col(spec.key)] if spec.key else []
    return model.transform(labelled).select(
        *key, F.col(spec.label).alias("label"), F.col("features")
    )


def slots(frame: DataFrame, keys: Sequence[str], vector: str = "features") -> DataFrame:
    """A vector column as long rows ``(keys..., slot, value)``."""
    return frame.select(*keys, F.posexplode(vector_to_array(vector)).alias("slot", "value"))
