"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors.

Every product with the vectors is a Spark job over the written fit list. The driver holds only
matrices of dimension by steps, never a row of the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import arrow_map, col
from tabml.sources.staging import stage

#: A new direction shorter than this share of the longest one is rounding: the space is used up.
NOTHING = 1e-12
#: Components of a smaller share of the whole variance are rounding and not given.
LEAST_SHARE = 1e-13
_LONG = 2**63 - 1


def integer_vectors(frame: DataFrame, vector: str, key: str, scale: int = 256) -> DataFrame:
    """``id, x``: ``floor(scale * entry)`` of every vector without null or non-finite entries.

    Numbers beyond a long are cut to the longest long. Vectors of no entries are left out.
    """
    raw = frame.select(col(key).cast("long").alias("id"), col(vector).cast("array<double>").alias("v"))
    raw = raw.filter(F.col("v").isNotNull() & (F.size("v") > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            lists = rows["v"]
            entries = lists.flatten()
            numbers = entries.to_numpy(zero_copy_only=False)
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(numbers))])
            keep = bad[bounds[1:]] == bad[bounds[:-1]]
            with np.errstate(over="ignore", invalid="ignore"):
                floors = np.floor(np.where(np.isfinite(numbers), numbers, 0.0) * scale)
            whole = np.where(np.abs(floors) < 2.0**63, floors, 0).astype(np.int64)
            whole = np.where(floors >= 2.0**63, _LONG, np.where(floors <= -(2.0**63), -_LONG, whole))
            out = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(whole))
            batch = pa.RecordBatch.from_arrays([rows["id"], out], names=["id", "x"])
            yield batch.filter(pa.array(keep))

    return arrow_map(raw, run, "id long, x array<long>")


def _matrix(rows: pa.RecordBatch, width: int) -> np.ndarray:
    return rows["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _exact(values: np.ndarray, axis: int, bound: int) -> np.ndarray:
    """Sums as whole numbers, with Python's where a long could overflow."""
    if bound * max(1, values.shape[axis]) > _LONG:
        values = values.astype(object)
    return values.sum(axis=axis)


def _column_sums(fit: DataFrame, width: int) -> tuple[int, list[int], int]:
    """Rows, exact sums of each dimension and the largest absolute entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, most, sums = 0, 0, np.zeros(width, object)
        for rows in batches:
            x = _matrix(rows, width)
            if len(x):
                most = max(most, int(x.max()), -int(x.min()))
                sums = sums + _exact(x, 0, most)
                count += len(x)
        values = [Decimal(count), *(Decimal(int(s)) for s in sums)]
        places = pa.array(range(width + 1), pa.int32())
        tops = pa.array([most] * (width + 1), pa.int64())
        yield pa.RecordBatch.from_arrays([places, pa.array(values, pa.decimal128(38, 0)), tops], names=["at", "value", "most"])

    parts = arrow_map(fit, run, "at int, value decimal(38,0), most long")
    # An empty table has no partition to report.
    found = {r["at"]: r for r in parts.groupBy("at").agg(F.sum("value").alias("value"), F.max("most").alias("most")).collect()}
    if not found:
        return 0, [0] * width, 0
    return int(found[0]["value"]), [int(found[k + 1]["value"]) for k in range(width)], int(found[0]["most"])


def _summed(fit: DataFrame, width: int, size: int, mean: np.ndarray, function) -> np.ndarray:
    """The sum over all centred rows of ``function(rows)``, a vector of ``size`` numbers.

    Each task sends one vector, and these are added by place before they reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for rows in batches:
            x = _matrix(rows, width)
            if len(x):
                total += function(x - mean)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["at", "value"]
        )

    parts = arrow_map(fit, run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    for row in parts.collect():
        out[row["at"]] = row["value"]
    return out


@dataclass
class Whitening:
    """Fitted components. ``vectors`` has a column for each, ``variances`` fall."""

    width: int
    n: int
    sums: list[int]
    most: int
    vectors: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _fresh(rng: np.random.Generator, basis: np.ndarray) -> np.ndarray:
    """A random unit vector that is orthogonal to the columns of ``basis``."""
    while True:
        vector = rng.standard_normal(len(basis))
        size = np.linalg.norm(vector)
        for _ in range(3):
            vector -= basis @ (basis.T @ vector)
        left = np.linalg.norm(vector)
        if left > 1e-8 * size:
            return vector / left


def bidiagonal(fit: DataFrame, width: int, mean: np.ndarray, steps: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """``V`` and the upper bidiagonal ``B`` of ``X V = U B`` for the centred rows ``X``.

    A step multiplies by ``X`` and by its transpose in one job: a left vector is never stored,
    as it is ``X w`` for a column ``w`` of a small matrix and is made again from the rows. Both
    sides are orthogonalised against all earlier vectors, the left side by inner products that
    the same job returns; where that shortens a vector much, another job repeats it. Where a
    side is used up, a random vector orthogonal to ``V`` begins the next block, so equal
    variances are all found.
    """
    rng = np.random.default_rng(seed)
    right = np.zeros((width, 0))
    left = np.zeros((width, 0))  # X @ left are the left vectors
    back = np.zeros((width, 0))  # X' @ (X @ left)
    band = np.zeros((steps, steps))
    vector, longest = _fresh(rng, right), 0.0
    for step in range(steps):
        right = np.column_stack([right, vector])
        now, coefficients = vector.copy(), np.zeros(step)
        for _ in range(3):
            basis = np.column_stack([left, now])

            def products(x: np.ndarray, basis: np.ndarray = basis) -> np.ndarray:
                made = x @ basis
                return np.concatenate([made.T @ made[:, -1], x.T @ made[:, -1]])

            found = _summed(fit, width, basis.shape[1] + width, mean, products)
            along, square, product = found[:step], found[step], found[step + 1 :]
            rest = max(0.0, square - along @ along)
            coefficients += along
            now = now - left @ along
            product = product - back @ along
            if rest > square / 2:
                break
        size = np.sqrt(rest)
        longest = max(longest, size)
        if step:
            band[:step, step] = coefficients
        if size <= NOTHING * longest or size == 0:
            left = np.column_stack([left, np.zeros(width)])
            back = np.column_stack([back, np.zeros(width)])
            following = np.zeros(width)
        else:
            band[step, step] = size
            left = np.column_stack([left, now / size])
            back = np.column_stack([back, product / size])
            following = back[:, -1] - size * vector
        for _ in range(2):
            following = following - right @ (right.T @ following)
        if step + 1 == steps:
            break
        size = np.linalg.norm(following)
        if size > NOTHING * longest:
            vector = following / size
        else:
            vector = _fresh(rng, right)
    return right, band


def fit_whitening(fit: DataFrame, components: int = 4, steps: int | None = None, seed: int = 1) -> Whitening | None:
    """Fitted to every row of ``fit`` (``x``, long arrays of one length); None without rows.

    ``steps`` bounds the bidiagonalisation; by default it goes on until the whole space is
    spanned, so the components are those of the covariance to double precision.
    """
    first = fit.select(F.size("x").alias("width")).head()
    if first is None:
        return None
    width = first["width"]
    n, sums, most = _column_sums(fit, width)
    mean = np.array([s / n for s in sums])
    right, band = bidiagonal(fit, width, mean, min(width, steps or width), seed)
    _, sizes, turned = np.linalg.svd(band)
    variances = sizes**2 / n
    trace = float(_summed(fit, width, 1, mean, lambda x: np.array([np.square(x).sum()]))[0]) / n
    own = [k for k in range(min(components, len(variances))) if variances[k] > LEAST_SHARE * trace and trace > 0]
    vectors = right @ turned[own].T if own else np.zeros((width, 0))
    vectors = vectors / np.linalg.norm(vectors, axis=0) if own else vectors
    variances = variances[own]
    count = len(own)

    def moments(x: np.ndarray) -> np.ndarray:
        white = (x @ vectors) / np.sqrt(variances)
        return np.concatenate([white.sum(0), (white.T @ white).ravel()])

    error = 0.0
    if count:
        found = _summed(fit, width, count + count * count, mean, moments) / n
        covariance = found[count:].reshape(count, count) - np.outer(found[:count], found[:count])
        error = float(np.abs(covariance - np.eye(count)).max())
    return Whitening(width, n, sums, most, vectors, variances, trace, error)


_OUT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_OUT_SCHEMA = pa.schema(
    [
        ("id", pa.int64()),
        ("component", pa.int32()),
        ("n", pa.int64()),
        ("deviation", pa.int64()),
        ("whitened", pa.float64()),
        ("explained", pa.float64()),
        ("identity_error", pa.float64()),
    ]
)


def apply_whitening(rows: DataFrame, model: Whitening) -> DataFrame:
    """One row for each vector of ``rows`` (``id, x``) and component; ``id`` may repeat."""
    count, mean = len(model.variances), model.mean

    def deviations(x: np.ndarray) -> list[int | None]:
        largest = model.n * model.most + max(map(abs, model.sums), default=0)
        kind = object if model.width * largest * largest > _LONG else np.int64
        apart = model.n * x.astype(kind) - np.array(model.sums, kind)
        total = (apart * apart).sum(axis=1)
        return [int(t) if t <= _LONG else None for t in total]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            x = _matrix(rows, model.width)
            size = len(x)
            white = ((x - mean) @ model.vectors) / np.sqrt(model.variances)
            ids = rows["id"].take(pa.array(np.repeat(np.arange(size), count)))
            apart = deviations(x)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, count + 1), size), pa.int32()),
                    pa.array(np.full(size * count, model.n), pa.int64()),
                    pa.array([d for d in apart for _ in range(count)], pa.int64()),
                    pa.array(white.ravel()),
                    pa.array(np.tile(model.variances / model.trace, size)) if count else pa.array([], pa.float64()),
                    pa.array(np.full(size * count, model.identity_error)),
                ],
                schema=_OUT_SCHEMA,
            )

    return arrow_map(rows, run, _OUT)


def whiten(
    frame: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 4, scale: int = 256
) -> DataFrame:
    """Vectors on their main components, each with variance one: a row per vector and component.

    ``key, component, n, deviation, whitened, explained, identity_error``. A vector counts as
    the longs ``floor(scale * entry)``; the components are fitted to every distinct vector
    once, so copies, however many, weigh as one. ``n`` is their number, ``deviation`` the exact
    sum over dimensions of ``(n * x - sum)^2`` (null beyond a long), ``explained`` a component's
    share of the variance, ``identity_error`` how far the covariance of the whitened distinct
    vectors is from the identity.

    Null vectors, empty ones and such with null, NaN or infinite entries are left out. Where
    lengths differ, the commonest (of equally common ones the longest) is the dimension and
    the other vectors are left out. Null and repeated keys come back as they are; extra columns
    are ignored. Components without variance are not given: a table of one distinct vector, or
    of none, has no rows.
    """
    raw = stage(integer_vectors(frame, vector, key, scale), "vectors")
    lengths = raw.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"))
    commonest = lengths.orderBy(F.desc("n"), F.desc("width")).head()
    rows = raw.filter(F.size("x") == (commonest["width"] if commonest else 0))
    fit = stage(rows.select("x").distinct(), "fit-list")
    model = fit_whitening(fit, components)
    if model is None:
        found = rows.sparkSession.createDataFrame([], _OUT)
    else:
        found = apply_whitening(rows, model)
    return found.withColumnRenamed("id", key)
