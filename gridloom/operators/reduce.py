"""Principal components and singular values of a table of vectors.

The sums of products of the features are added up on the executors. The matrix is symmetric,
so the driver takes eigenvectors of it with a symmetric solver; where its square of numbers is
too large for the driver, the components come from block power iteration, one pass over the rows a step, with a block of
``features x n`` numbers. Rows are projected by column expressions, so they keep their keys.
The sign of a component is free: here its largest entry is positive.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.categories import feature_width
from gridloom.functions.columns import WRITTEN_OUT, dot

# Above this many features their square of sums is too large for the driver and for a task.
MATRIX_LIMIT = 2000
# Block power iteration: spare directions, and the change of the values at which it ends.
SPARE, TOLERANCE, STEPS = 8, 1e-12, 500


def _projection(v: np.ndarray) -> Column:
    x = vector_to_array("features")
    limit = WRITTEN_OUT if v.size <= 10 * WRITTEN_OUT else 0
    return array_to_vector(F.array(*[dot(x, column.tolist(), limit=limit) for column in v.T]))


def batch_sums(rows: DataFrame, size: int, add: Callable[[np.ndarray, np.ndarray], None]) -> tuple[np.ndarray, int]:
    """The sum of ``size`` numbers that ``add`` puts into an array for each batch of rows, and the row count.

    Every task gives one array. They are added up in a tree: about the root of the number of tasks meets
    in one task, and as many arrays come to the driver.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size), 0
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                add(total, flat.reshape(batch.num_rows, -1))
                n += batch.num_rows
        yield _sum_row(total, n)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size), 0
        for batch in batches:
            for i in range(batch.num_rows):
                total += batch.column(0)[i].values.to_numpy()
            n += sum(batch.column(1).to_pylist())
        yield _sum_row(total, n)

    shape = "part array<double>, n bigint"
    sums = rows.select(vector_to_array("features").alias("x")).mapInArrow(partial, shape)
    branches = math.isqrt(sums.rdd.getNumPartitions())
    if branches > 3:
        sums = sums.repartition(branches).mapInArrow(added, shape)
    found = sums.toArrow()
    parts = [found.column("part")[i].values.to_numpy() for i in range(found.num_rows)]
    return np.sum(parts, axis=0) if parts else np.zeros(size), sum(found.column("n").to_pylist())


def _sum_row(total: np.ndarray, n: int) -> pa.RecordBatch:
    part = pa.ListArray.from_arrays(pa.array([0, len(total)], pa.int32()), pa.array(total))
    return pa.RecordBatch.from_arrays([part, pa.array([n], pa.int64())], names=["part", "n"])


@dataclass
class Scatter:
    """Sums of products of features around ``centre``, which is their mean or zero."""
    n: int
    centre: np.ndarray
    matrix: np.ndarray


def _by_columns(rows: DataFrame, width: int, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums and sums of products of ``features - shift`` in one generated aggregate."""
    x = vector_to_array("features")
    names = [f"x{i}" for i in range(width)]
    plain = rows.select(*[(x[i] - F.lit(float(shift[i]))).alias(n) for i, n in enumerate(names)])
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    found = plain.agg(F.count(F.lit(1)), *[F.sum(n) for n in names],
                      *[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]).first()
    matrix = np.zeros((width, width))
    for (i, j), value in zip(pairs, found[1 + width:]):
        matrix[i, j] = matrix[j, i] = value or 0.0
    return np.array([v or 0.0 for v in found[1: 1 + width]]), matrix, found[0]


def _by_batches(rows: DataFrame, width: int, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The same by one matrix product for each Arrow batch."""
    def add(total: np.ndarray, x: np.ndarray) -> None:
        x = x - shift
        total[:width] += x.sum(0)
        total[width:] += (x.T @ x).ravel()
    total, n = batch_sums(rows, width + width * width, add)
    return total[:width], total[width:].reshape(width, width), n


def _start(rows: DataFrame, width: int) -> np.ndarray:
    """A row's features: sums around them do not lose the digits that a large mean would cost."""
    first = rows.select("features").first()
    return np.zeros(width) if first is None else first[0].toArray()


def scatter(rows: DataFrame, centred: bool) -> Scatter:
    """The sums of all rows in one pass, around the mean or around zero."""
    width = feature_width(rows)
    shift = _start(rows, width) if centred else np.zeros(width)
    small = width * (width + 3) // 2 <= WRITTEN_OUT
    sums, matrix, n = (_by_columns if small else _by_batches)(rows, width, shift)
    if not centred or not n:
        return Scatter(n, np.zeros(width), matrix)
    mean = sums / n
    return Scatter(n, shift + mean, matrix - n * np.outer(mean, mean))


def _signed(v: np.ndarray) -> np.ndarray:
    top = v[np.abs(v).argmax(0), np.arange(v.shape[1])]
    return v * np.where(top < 0, -1.0, 1.0)


def _leading(rows: DataFrame, n: int, centred: bool, matrix_limit: int) -> tuple[np.ndarray, np.ndarray, float, int]:
    """The ``n`` largest eigenvalues of the scatter with their vectors, its trace and the row count."""
    width = feature_width(rows)
    if width <= matrix_limit:
        found = scatter(rows, centred)
        values, vectors = np.linalg.eigh(found.matrix)
        return values[::-1][:n], _signed(vectors[:, ::-1][:, :n]), float(np.trace(found.matrix)), found.n
    return _by_power(rows, n, width, centred)


def _by_power(rows: DataFrame, n: int, width: int, centred: bool) -> tuple[np.ndarray, np.ndarray, float, int]:
    """The same without the matrix: each step multiplies a block by all rows and makes it orthonormal again."""
    shift = _start(rows, width) if centred else np.zeros(width)

    def squares(total: np.ndarray, x: np.ndarray) -> None:
        x = x - shift
        total[:width] += x.sum(0)
        total[width:] += (x * x).sum(0)
    total, count = batch_sums(rows, 2 * width, squares)
    mean = total[:width] / max(count, 1) if centred else np.zeros(width)
    centre = shift + mean
    trace = float(total[width:].sum() - count * (mean @ mean))
    size = min(n + SPARE, width)
    block = np.linalg.qr(np.random.default_rng(0).standard_normal((width, size)))[0]
    values = np.zeros(size)
    for _ in range(STEPS):
        def product(sums: np.ndarray, x: np.ndarray, block: np.ndarray = block) -> None:
            x = x - centre
            sums += (x.T @ (x @ block)).ravel()
        image = batch_sums(rows, width * size, product)[0].reshape(width, size)
        # eigenvectors inside the block, then the next block
        inner, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        before, values = values, inner[::-1]
        vectors = block @ turn[:, ::-1]
        if np.abs(values[:n] - before[:n]).max() <= TOLERANCE * max(values[0], 1e-300):
            break
        block = np.linalg.qr(image @ turn[:, ::-1])[0]
    return values[:n], _signed(vectors[:, :n]), trace, count


@dataclass
class Components:
    v: np.ndarray          # features x n
    explained: list[float]  # share of the variance per component
    variance: float = 0.0  # of all features together

    def transform(self, rows: DataFrame) -> DataFrame:
        """Rows times the components (not centred) in ``projected``."""
        return rows.withColumn("projected", _projection(self.v))


def fit_components(rows: DataFrame, n: int, matrix_limit: int = MATRIX_LIMIT) -> Components:
    """The first ``n`` principal components; without variance the shares are 0."""
    values, v, trace, count = _leading(rows, n, True, matrix_limit)
    shares = np.maximum(values, 0.0) / trace if trace > 0 else np.zeros(len(values))
    return Components(v, shares.tolist(), trace / max(count - 1, 1))


def project(rows: DataFrame, n: int) -> DataFrame:
    return fit_components(rows, n).transform(rows)


def project_features(rows: DataFrame, n: int) -> DataFrame:
    """The projection in place of ``features``; label and key stay."""
    names = rows.columns
    return (project(rows, n).drop("features").withColumnRenamed("projected", "features")
            .select(*names))


@dataclass
class SingularValues:
    values: list[float]
    v: np.ndarray  # features x n
    u: DataFrame   # the input's other columns and the vector ``u``


def singular_values(rows: DataFrame, n: int, rcond: float = 1e-9,
                    matrix_limit: int = MATRIX_LIMIT) -> SingularValues:
    """Top ``n`` singular values with U and V; fewer where a value is below ``rcond`` times the largest.

    ``len(values)`` says how many there are. Values near 1e-8 of the largest are at the level of the
    solver's rounding: a caller who must not see them gives a larger ``rcond``.
    """
    squares, v, _, _ = _leading(rows, n, False, matrix_limit)
    values = np.sqrt(np.maximum(squares, 0.0))
    keep = values > rcond * (values[0] if len(values) else 0.0)
    values, v = values[keep], v[:, keep]
    u = rows.withColumn("u", _projection(v / values)).drop("features")
    return SingularValues(values.tolist(), v, u)
