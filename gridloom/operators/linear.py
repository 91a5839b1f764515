"""Linear models: SVM and least squares by gradient descent, logistic regression by L-BFGS."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.categories import feature_width
from gridloom.functions.columns import WRITTEN_OUT, at_least_zero, dot
from gridloom.operators.split import mini_batch

HINGE = "hinge"
SQUARED = "squared"
START_INTERCEPT = 1.0  # fixed value: the descent starts at weight 0 and intercept 1


@dataclass
class LinearModel:
    """Weights of a linear model; ``hinge`` models predict 0/1, the others the margin."""

    loss: str
    weights: list[float]
    intercept: float = 0.0
    iterations: int = 0
    params: dict[str, str] = field(default_factory=dict)

    def margin(self, features: str = "features") -> Column:
        return dot(vector_to_array(features), self.weights, self.intercept)

    def transform(self, rows: DataFrame) -> DataFrame:
        scored = rows.withColumn("margin", self.margin())
        prediction = at_least_zero("margin") if self.loss == HINGE else F.col("margin")
        return scored.withColumn("prediction", prediction)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        row = [(self.loss, self.weights, self.intercept, self.iterations)]
        schema = "loss string, weights array<double>, intercept double, iterations int"
        spark.createDataFrame(row, schema).coalesce(1).write.parquet(path)

    @staticmethod
    def load(path: str) -> "LinearModel":
        row = SparkSession.getActiveSession().read.parquet(path).first()
        return LinearModel(row["loss"], list(row["weights"]), row["intercept"], row["iterations"])


@dataclass
class _Point:
    """Descent state of one grid point; the last weight is the intercept if there is one."""

    step: float
    reg: float
    weights: np.ndarray
    done: bool = False
    updates: int = 0

    def update(self, gradient: np.ndarray, iteration: int, reg_type: str, tol: float) -> None:
        step = self.step / math.sqrt(iteration)
        before = self.weights
        if reg_type == "l2":
            after = before * (1.0 - step * self.reg) - step * gradient
        else:
            after = before - step * gradient
            if reg_type == "l1":
                after = np.sign(after) * np.maximum(np.abs(after) - step * self.reg, 0.0)
        self.weights = after
        self.updates += 1
        if self.updates > 1:
            change = float(np.linalg.norm(after - before))
            self.done = change < tol * max(float(np.linalg.norm(after)), 1.0)


def _slope(margin: Column, loss: str) -> Column:
    """Derivative of the loss by the margin for one row."""
    if loss == SQUARED:
        return margin - F.col("label")
    sign = F.lit(2.0) * F.col("label") - F.lit(1.0)
    return F.when(sign * margin < F.lit(1.0), -sign).otherwise(F.lit(0.0))


def _column_gradients(batch: DataFrame, points: Sequence[_Point], loss: str, width: int,
                      intercept: bool) -> list[np.ndarray]:
    """Gradient sums of all points in one pass: the row count and one sum per weight."""
    slopes = []
    for p, point in enumerate(points):
        bias = float(point.weights[width]) if intercept else 0.0
        margin = F.lit(0.0)
        for i in range(width):
            margin = margin + F.col(f"x{i}") * F.lit(float(point.weights[i]))
        slopes.append(_slope(margin + F.lit(bias), loss).alias(f"s{p}"))
    names = [f"x{i}" for i in range(width)]
    sums = [F.count(F.lit(1))]
    for p in range(len(points)):
        sums += [F.sum(F.col(f"s{p}") * F.col(n)) for n in names]
        sums += [F.sum(f"s{p}")] if intercept else []
    row = batch.select(*names, *slopes).agg(*sums).first()
    if not row[0]:
        return []
    size = width + int(intercept)
    values = np.array(row[1:], dtype=float).reshape(len(points), size)
    return list(values / row[0])


def _array_gradients(batch: DataFrame, points: Sequence[_Point], loss: str, width: int,
                     intercept: bool) -> list[np.ndarray]:
    """The same for wide features: one matrix product per Arrow batch.

    Each task gives one array of sums. They are added up in a tree: about the root of the number of
    tasks meets in one task, and as many arrays come to the driver.
    """
    size = width + int(intercept)
    matrix = np.stack([point.weights for point in points], axis=1)

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros((len(points), size)), 0
        for frame in frames:
            if not len(frame):
                continue
            x = np.stack(frame["x"].to_numpy())
            if intercept:
                x = np.hstack([x, np.ones((len(x), 1))])
            y = frame["label"].to_numpy()[:, None]
            margin = x @ matrix
            if loss == SQUARED:
                slope = margin - y
            else:
                sign = 2.0 * y - 1.0
                slope = np.where(sign * margin < 1.0, -sign, 0.0)
            total += slope.T @ x
            rows += len(x)
        yield pd.DataFrame({"part": [total.ravel()], "rows": [rows]})

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(len(points) * size), 0
        for frame in frames:
            for part in frame["part"]:
                total += part
            rows += int(frame["rows"].sum())
        yield pd.DataFrame({"part": [total], "rows": [rows]})

    shape = "part array<double>, rows bigint"
    sums = batch.select("label", "x").mapInPandas(partial, shape)
    branches = math.isqrt(sums.rdd.getNumPartitions())
    if branches > 3:
        sums = sums.repartition(branches).mapInPandas(added, shape)
    found = sums.collect()
    rows = sum(r["rows"] for r in found)
    if not rows:
        return []
    return list(np.sum([r["part"] for r in found], axis=0).reshape(len(points), size) / rows)


# Above this many features the matrix of second moments is too large for the driver.
MOMENT_LIMIT = 2000


def _moments(rows: DataFrame, width: int) -> np.ndarray | None:
    """Sums of products of (features, 1, label) over all rows, in one pass; None without rows."""
    size = width + 2
    if size * (size + 1) // 2 <= WRITTEN_OUT:
        return _moments_by_columns(rows, width)
    if rows.isEmpty():
        return None
    whole = VectorAssembler(inputCols=["features", "one", "label"], outputCol="z").transform(
        rows.select("features", F.lit(1.0).alias("one"), "label")).select("z")
    vectors = MLUtils.convertVectorColumnsFromML(whole, "z")
    sums = RowMatrix(vectors, numCols=size).computeGramianMatrix().toArray()
    return sums if sums[width, width] else None


def _moments_by_columns(rows: DataFrame, width: int) -> np.ndarray | None:
    """The same for few features: one generated aggregate over plain columns."""
    x = vector_to_array("features")
    names = [*[f"z{i}" for i in range(width)], "one", "label"]
    plain = rows.select(*[x[i].alias(f"z{i}") for i in range(width)], F.lit(1.0).alias("one"), "label")
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    found = plain.agg(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]).first()
    if not found[pairs.index((width, width))]:
        return None
    sums = np.zeros((len(names), len(names)))
    for (i, j), value in zip(pairs, found):
        sums[i, j] = sums[j, i] = value
    return sums


def _descend_by_moments(rows: DataFrame, points: Sequence[_Point], width: int, size: int,
                        iterations: int, reg_type: str, tol: float) -> None:
    """Least squares: the gradient is linear in the weights, so one pass serves every iteration."""
    sums = _moments(rows, width)
    if sums is None:
        return
    count = sums[width, width]
    squares, products = sums[:size, :size] / count, sums[:size, width + 1] / count
    for point in points:
        for iteration in range(1, iterations + 1):
            if point.done:
                break
            point.update(squares @ point.weights - products, iteration, reg_type, tol)


def descend(rows: DataFrame, loss: str, grid: Sequence[tuple[float, float]], iterations: int = 100,
            reg_type: str = "l2", intercept: bool = True, tol: float = 0.001,
            fraction: float = 1.0, moment_limit: int = MOMENT_LIMIT, key: str | None = None) -> list[LinearModel]:
    """Gradient descent for every ``(step, regularisation)`` point of the grid at once.

    Least squares on all rows takes a single pass for up to ``moment_limit`` features (the driver holds
    that number squared). Otherwise each iteration is one aggregate over the stored rows that serves
    the points still moving; where the sums of all points are more than ``WRITTEN_OUT``, several
    aggregates of that many columns. More features than that go through one matrix product per
    Arrow batch for all points. Only sums and weights come to the driver. With ``fraction`` below 1 each iteration
    takes a sample, by a hash of ``key`` and the iteration if a key is given: then the weights do
    not depend on how the rows are partitioned.
    """
    width = feature_width(rows)
    size = width + int(intercept)
    start = np.zeros(size)
    if intercept:
        start[width] = START_INTERCEPT
    points = [_Point(float(s), float(r), start.copy()) for s, r in grid]
    if loss == SQUARED and fraction >= 1.0 and width <= moment_limit:
        _descend_by_moments(rows, points, width, size, iterations, reg_type.lower(), tol)
    else:
        _descend_by_passes(rows, points, loss, width, size, iterations, reg_type.lower(), tol, fraction, key)
    return [LinearModel(loss, [float(w) for w in p.weights[:width]],
                        float(p.weights[width]) if intercept else 0.0, p.updates) for p in points]


def _descend_by_passes(rows: DataFrame, points: Sequence[_Point], loss: str, width: int, size: int,
                       iterations: int, reg_type: str, tol: float, fraction: float,
                       key: str | None = None) -> None:
    by_columns, intercept = size <= WRITTEN_OUT, size > width
    x = vector_to_array("features")
    named = [F.col(key).cast("string").alias("batch_key")] if key and fraction < 1.0 else []
    if by_columns:
        stored = rows.select("label", x.alias("x"), *named).select(
            "label", *[F.col("x")[i].alias(f"x{i}") for i in range(width)], *(["batch_key"] if named else []))
    else:
        stored = rows.select("label", x.alias("x"), *named)
    stored = stored.persist(StorageLevel.MEMORY_AND_DISK)
    chunk = max(1, WRITTEN_OUT // size) if by_columns else len(points)
    gradients = _column_gradients if by_columns else _array_gradients
    try:
        for iteration in range(1, iterations + 1):
            moving = [p for p in points if not p.done]
            if not moving:
                break
            batch = mini_batch(stored, fraction, iteration, key="batch_key" if named else None)
            for at in range(0, len(moving), chunk):
                part = moving[at:at + chunk]
                for point, gradient in zip(part, gradients(batch, part, loss, width, intercept)):
                    point.update(gradient, iteration, reg_type, tol)
    finally:
        stored.unpersist()


def train_svm(rows: DataFrame, step: float = 1.0, reg: float = 0.01, **options) -> LinearModel:
    return descend(rows, HINGE, [(step, reg)], **options)[0]


def train_least_squares(rows: DataFrame, step: float = 1.0, reg: float = 0.0,
                        reg_type: str = "none", **options) -> LinearModel:
    return descend(rows, SQUARED, [(step, reg)], reg_type=reg_type, **options)[0]


def train_logistic(rows: DataFrame, num_classes: int = 2, reg: float = 0.0, reg_type: str = "l2",
                   iterations: int = 100, intercept: bool = True, tol: float = 1e-6,
                   corrections: int = 10) -> LogisticRegressionModel:
    """L-BFGS. ``corrections`` is accepted for old parameter sets; Spark ML fixes it at 10."""
    none = reg_type.lower() not in ("l1", "l2")
    learner = LogisticRegression(
        family="binomial" if num_classes == 2 else "multinomial", maxIter=iterations,
        regParam=0.0 if none else reg, elasticNetParam=1.0 if reg_type.lower() == "l1" else 0.0,
        fitIntercept=intercept, tol=tol)
    return learner.fit(rows.select("label", "features"))
