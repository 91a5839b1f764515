"""Isotonic regression on the first feature."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import shared_dir

BLOCKS_PER_TASK = 100_000
HELD_BLOCKS = 100_000  # blocks (24 bytes each) that scoring may hold in every task
_BLOCK = "part bigint, place bigint, low double, high double, label double, weight double"


def pool_equal_features(points: DataFrame) -> DataFrame:
    """One weighted row per distinct feature value, which has the same fit.

    The group-by combines on the map side, so a value that a third of the rows
    share costs one partial row per task.
    """
    total = F.sum("weight")
    return (points.groupBy("feature")
            .agg((F.sum(F.col("label") * F.col("weight")) / total).alias("label"), total.alias("weight")))


def train_isotonic(points: DataFrame, increasing: bool = True) -> IsotonicRegressionModel:
    """The library's model: pools on the executors, and once more over all blocks that are left on the driver."""
    learner = IsotonicRegression(isotonic=increasing, featuresCol="feature", labelCol="label",
                                 weightCol="weight")
    return learner.fit(pool_equal_features(points))


# --- pooling that keeps all blocks distributed ------------------------------------------

def _pooled(blocks: list[tuple]) -> list[list[float]]:
    """Neighbours ``low, high, label, weight`` whose labels do not rise become one block, until all labels rise."""
    stack: list[list[float]] = []
    for block in map(list, blocks):
        while stack and stack[-1][2] >= block[2]:
            before = stack.pop()
            weights = before[3] + block[3]
            mean = (before[2] * before[3] + block[2] * block[3]) / weights if weights else block[2]
            block = [before[0], block[1], mean, weights]
        stack.append(block)
    return stack


def _pool_range(rows: pa.Table) -> pa.Table:
    """The blocks of one range pooled, with their place in it."""
    rows = rows.sort_by("low")
    blocks = _pooled(list(zip(*(rows.column(c).to_pylist() for c in ("low", "high", "label", "weight")))))
    part = np.full(len(blocks), rows.column("part")[0].as_py(), np.int64)
    return pa.table([pa.array(part), pa.array(np.arange(len(blocks), dtype=np.int64)),
                     *[pa.array(c, pa.float64()) for c in zip(*blocks)]],
                    names=[c.split()[0] for c in _BLOCK.split(", ")])


def _written(frame: DataFrame, name: str) -> DataFrame:
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/gridloom/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def train_isotonic_blocks(points: DataFrame, increasing: bool = True,
                          blocks_per_task: int = BLOCKS_PER_TASK) -> IsotonicBlocks:
    """Pool-adjacent-violators in which no task holds more than about ``blocks_per_task`` blocks.

    The feature's ranges are pooled side by side. Pooling neighbours in any order ends at the same
    fit, so it is reached when no label falls from one range to the next. Until then every
    round cuts the blocks that are left into new ranges by their place, in turns at multiples of the size
    and half a size further: a fall between two ranges lies inside one of the next two rounds. Of each range
    only its first and last label and its count come to the driver. A null feature trains nothing.
    """
    sign = F.lit(1.0 if increasing else -1.0)
    pooled = pool_equal_features(points.where(F.col("feature").isNotNull()))
    blocks = _written(pooled.select(F.col("feature").alias("low"), F.col("feature").alias("high"),
                                    (F.col("label") * sign).alias("label"), "weight"), "blocks")
    ranges = -(-blocks.count() // blocks_per_task) or 1
    ranged = _written(blocks.repartitionByRange(ranges, "low").select(
        F.spark_partition_id().cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("place"), "*"), "blocks")
    turn = 0
    while True:
        made = _written(ranged.groupBy("part").applyInArrow(_pool_range, _BLOCK), "blocks")
        ends = made.groupBy("part").agg(
            F.min("low").alias("low"), F.min_by("label", "place").alias("first"),
            F.max_by("label", "place").alias("last"), F.count(F.lit(1)).alias("n")).orderBy("low").collect()
        if all(a["last"] < b["first"] for a, b in zip(ends, ends[1:])):
            return IsotonicBlocks(made.select("low", "high", (F.col("label") * sign).alias("label")))
        before, total = [], 0
        for row in ends:
            before.append((row["part"], total))
            total += row["n"]
        shift = (turn % 2) * (blocks_per_task // 2) if total > blocks_per_task else 0
        offsets = made.sparkSession.createDataFrame(before, "part bigint, before bigint")
        place = F.col("before") + F.col("place")
        ranged = made.join(F.broadcast(offsets), "part").select(
            F.expr(f"(before + place + {shift}) div {blocks_per_task}").alias("part"), place.alias("place"),
            "low", "high", "label", "weight")
        turn += 1


@dataclass
class IsotonicBlocks:
    """The fit as a table of blocks ``low, high, label``: constant inside, a straight line between two blocks."""

    blocks: DataFrame

    def transform(self, rows: DataFrame, held: int = HELD_BLOCKS) -> DataFrame:
        """The rows with the ``prediction`` of their ``feature``, null for a null.

        Beyond the first and last block that block's label holds. Up to ``held`` blocks go to every task, else
        :func:`_sorted_predictions` takes blocks and features together.
        """
        if self.blocks.limit(held + 1).count() > held:
            found = _sorted_predictions(rows.select("feature").distinct(), self.blocks)
            return rows.join(found.withColumnRenamed("x", "feature"), "feature", "left").select(
                *rows.columns, "prediction")
        found = self.blocks.orderBy("low").toArrow()
        low, high, label = (found.column(c).to_numpy() for c in ("low", "high", "label"))
        x, y = np.stack([low, high], 1).ravel(), np.repeat(label, 2)

        @F.arrow_udf("double")
        def predicted(feature: pa.Array) -> pa.Array:
            values = feature.to_numpy(zero_copy_only=False)
            fitted = np.interp(values, x, y) if len(x) else np.full(len(values), np.nan)
            return pa.array(fitted, pa.float64(), mask=np.isnan(fitted))
        return rows.withColumn("prediction", predicted("feature"))


def _sorted_predictions(features: DataFrame, blocks: DataFrame) -> DataFrame:
    """``x, prediction`` of distinct features: sorted in ranges together with the blocks' ends.

    A feature needs the end before it and the end behind it. Inside a range they are found by a window; beyond
    it they come from the ranges before and behind, of which one entry each is known to all.
    """
    one = F.struct(F.col("x").alias("x"), F.col("y").alias("y"))
    ends = blocks.select(F.explode(F.array("low", "high")).alias("x"), F.col("label").alias("y")).distinct()
    both = ends.select("x", one.alias("end")).unionByName(
        features.where(F.col("feature").isNotNull()).select(F.col("feature").alias("x"), F.lit(None).cast(
            "struct<x:double,y:double>").alias("end")))
    ranged = _written(both.repartitionByRange("x").select("*", F.spark_partition_id().alias("part")), "ranges")
    marks = ranged.groupBy("part").agg(F.min("x").alias("low"), F.min("end").alias("first"),
                                       F.max("end").alias("last")).orderBy("low").collect()
    carried, last = [], None
    for row in marks:  # one row a range
        carried.append([row["part"], last, None])
        last = row["last"] or last
    first = None
    for entry, row in zip(reversed(carried), reversed(marks)):
        entry[2] = first
        first = row["first"] or first
    kind = "struct<x:double,y:double>"
    beyond = ranged.sparkSession.createDataFrame(carried, f"part int, before {kind}, behind {kind}")
    order = Window.partitionBy("part").orderBy("x")
    upto = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = order.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    placed = ranged.join(F.broadcast(beyond), "part").select(
        "x", "end", F.coalesce(F.max("end").over(upto), "before").alias("a"),
        F.coalesce(F.min("end").over(after), "behind").alias("b")).where(F.col("end").isNull())
    a, b = F.coalesce("a", "b"), F.coalesce("b", "a")
    share = F.when(b["x"] > a["x"], (F.col("x") - a["x"]) / (b["x"] - a["x"])).otherwise(F.lit(0.0))
    return placed.select("x", (a["y"] + (b["y"] - a["y"]) * share).alias("prediction"))
