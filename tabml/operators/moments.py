"""Covariances and correlations of any number of columns in one scan, and principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.functions import named, require_columns

#: Columns whose square matrix the driver takes.
MAX_MATRIX = 4000
#: Complete rows whose mean is subtracted from all rows before products are summed.
SHIFT_ROWS = 1000


@dataclass
class Moments:
    """Number of complete rows, means and sums of products of deviations from them."""

    columns: list[str]
    n: int
    means: np.ndarray
    products: np.ndarray

    def covariances(self) -> np.ndarray | None:
        """Sample covariances, or None with fewer than two rows."""
        return self.products / (self.n - 1) if self.n > 1 else None

    def correlations(self) -> list[list[float | None]]:
        """None where a column is constant or there is no row."""
        deviations = np.sqrt(np.diag(self.products))
        scale = np.outer(deviations, deviations)
        size = range(len(self.columns))
        return [
            [None if not scale[i, j] > 0 else 1.0 if i == j else float(self.products[i, j] / scale[i, j]) for j in size]
            for i in size
        ]


def moments(frame: DataFrame, columns: Sequence[str]) -> Moments:
    """First and second moments of the rows in which all columns are present, in one scan.

    Every task sums the outer products of its rows into one packed triangle, and the triangles
    are added in a tree, so a wide table is read once like a narrow one. A column of ones adds
    the sums and the count. Sums of products lose digits where a mean is far from 0, so the
    mean of at most ``SHIFT_ROWS`` rows is subtracted first, which changes no covariance. The
    driver gets one square matrix, of at most ``MAX_MATRIX`` columns.
    """
    columns = list(columns)
    require_columns(frame, columns)
    size = len(columns)
    if size > MAX_MATRIX:
        raise ValueError(f"{size} columns are more than the {MAX_MATRIX} whose square matrix the driver takes")
    numbers = frame.select(*[named(c).cast("double").alias(f"v{k}") for k, c in enumerate(columns)]).dropna()
    *head, seen = numbers.limit(SHIFT_ROWS).agg(*[F.avg(f"v{k}") for k in range(size)], F.count("*")).head()
    if not seen:
        return Moments(columns, 0, np.zeros(size), np.zeros((size, size)))
    shift = np.array([x if x is not None and np.isfinite(x) else 0.0 for x in head])
    # A constant column is exactly 0 then, not nearly.
    shifted = numbers.select(*[(F.col(f"v{k}") - float(shift[k])).alias(f"v{k}") for k in range(size)], F.lit(1.0).alias("one"))
    vectors = VectorAssembler(inputCols=shifted.columns, outputCol="v").transform(shifted).select("v")
    rows = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"), 0, size + 1)
    gram = rows.computeGramianMatrix().toArray()
    n = round(gram[size, size])
    sums = gram[size, :size]
    products = gram[:size, :size] - np.outer(sums, sums) / max(n, 1)
    # What rounding leaves of a constant column is no variance.
    squares = np.diag(gram)[:size]
    constant = np.diag(products) <= squares * 1e-13
    products[constant, :] = products[:, constant] = 0.0
    return Moments(columns, n, sums / max(n, 1) + shift, products)


def correlation_matrix(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, as rows ``(col_a, col_b, corr)``, by :func:`moments`.

    Null where a column is constant or no row is left.
    """
    found = moments(frame, columns)
    table = found.correlations()
    rows = [(a, b, table[i][j]) for i, a in enumerate(found.columns) for j, b in enumerate(found.columns)]
    return frame.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def covariance_matrix(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample covariance of every pair, as rows ``(col_a, col_b, covar, n)``, by :func:`moments`.

    Null where fewer than two rows are complete.
    """
    found = moments(frame, columns)
    table = found.covariances()
    rows = [
        (a, b, None if table is None else float(table[i, j]), found.n)
        for i, a in enumerate(found.columns)
        for j, b in enumerate(found.columns)
    ]
    return frame.sparkSession.createDataFrame(rows, "col_a string, col_b string, covar double, n long")


@dataclass
class PrincipalComponents:
    """``axes`` has a row for each component; ``variances`` fall and are sample variances."""

    columns: list[str]
    means: np.ndarray
    scales: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    total: float
    n: int

    def table(self, frame: DataFrame) -> DataFrame:
        """Rows ``(component, column, loading, variance, explained)``, components from 1 on."""
        rows = [
            (k + 1, name, float(axis[j]), float(variance), float(variance / self.total) if self.total else None)
            for k, (axis, variance) in enumerate(zip(self.axes, self.variances, strict=True))
            for j, name in enumerate(self.columns)
        ]
        schema = "component int, column string, loading double, variance double, explained double"
        return frame.sparkSession.createDataFrame(rows, schema)

    def project(self, frame: DataFrame, prefix: str = "pc") -> DataFrame:
        """Add ``pc1``, ``pc2``, ...: a row's coordinates on the components; null where a column is missing.

        Stays in generated code but for the loop over the columns, and shuffles nothing.
        """
        require_columns(frame, self.columns)
        present = reduce(Column.__and__, [named(c).isNotNull() & ~F.isnan(named(c).cast("double")) for c in self.columns])
        values = F.array(*[named(c).cast("double") for c in self.columns])
        added = {}
        for k, axis in enumerate(self.axes):
            weights = axis / self.scales
            offset = float(-(weights @ self.means))
            terms = F.zip_with(values, F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w)
            score = F.aggregate(terms, F.lit(offset), lambda total, term: total + term)
            added[f"{prefix}{k + 1}"] = F.when(present, score)
        return frame.withColumns(added)


def principal_components(
    frame: DataFrame, columns: Sequence[str], count: int | None = None, standardise: bool = False
) -> PrincipalComponents:
    """The directions of largest variance, from the covariances of one scan.

    With ``standardise`` every column is divided by its sample deviation first, a constant one
    is only centred. A component's largest loading (of equally large ones the first) is
    positive. Rows with a missing value are left out. The driver gets the square matrix of the
    columns, so these are at most ``MAX_MATRIX``.
    """
    found = moments(frame, columns)
    matrix = found.covariances()
    if matrix is None:
        raise ValueError("fewer than two complete rows have no components")
    columns, means, n = found.columns, found.means, found.n
    size = len(columns)
    scales = np.ones(size)
    if standardise:
        deviations = np.sqrt(np.diag(matrix))
        scales = np.where(deviations > 0, deviations, 1.0)
        matrix = matrix / np.outer(scales, scales)
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    order = np.argsort(-values, kind="stable")[: count or size]
    axes = vectors[:, order].T
    largest = np.abs(np.round(axes, 12)).argmax(axis=1)
    axes = axes * np.where(axes[np.arange(len(axes)), largest] < 0, -1.0, 1.0)[:, None]
    return PrincipalComponents(columns, means, scales, axes, np.maximum(values[order], 0.0), float(np.trace(matrix)), n)
