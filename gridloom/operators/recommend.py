"""Alternating least squares on explicit ratings, of users and items with keys of any type."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.keys import dense_keys, with_ids
from gridloom.operators.split import SPAN, key_hash
from gridloom.session import ensure_checkpoint_dir, forget, shared_dir, stored

SEED = 42
RATINGS_PER_BLOCK = 5_000_000  # 12 bytes each while a block is built and sorted in a task's memory


def train_als(rated: DataFrame, rank: int = 10, iterations: int = 20, reg: float = 0.01,
              alpha: float = 0.01, nonnegative: bool = False, blocks: int | None = None) -> ALSModel:
    """``alpha`` has no effect on explicit ratings and is accepted for old parameter sets.

    The factors are cut into as many blocks as the cluster has cores (at least 10), and into more where a
    block would have more than ``RATINGS_PER_BLOCK`` ratings, which are counted first. Every iteration is
    checkpointed in the shared folder, so that the factors it has sent are deleted before the next are sent.
    The model is the stored one: the blocks of ratings and what was shuffled for them are given back.
    """
    spark = rated.sparkSession
    ensure_checkpoint_dir(spark)
    blocks = blocks or max(10, spark.sparkContext.defaultParallelism, -(-rated.count() // RATINGS_PER_BLOCK))
    learner = ALS(rank=rank, maxIter=iterations, regParam=reg, alpha=alpha, nonnegative=nonnegative,
                  userCol="user", itemCol="item", ratingCol="rate", numUserBlocks=blocks,
                  numItemBlocks=blocks, coldStartStrategy="drop", checkpointInterval=1, seed=SEED)
    path = f"{shared_dir(spark)}/gridloom/factors-{uuid.uuid4().hex}"
    learner.fit(rated).save(path)
    forget(spark)
    return ALSModel.load(path)


@dataclass
class RatingModel:
    """Factors of dense numbers, and the dictionaries that give users and items their numbers."""

    factors: ALSModel
    users: DataFrame  # key, id
    items: DataFrame

    def transform(self, rows: DataFrame) -> DataFrame:
        """Every row with its prediction, null for a user or item the model has not seen (or a null)."""
        found = rows
        # the factors come by the keys themselves: two joins of the rows, not two for the numbers and two for the factors
        for column, dictionary, factors in (("user", self.users, self.factors.userFactors),
                                            ("item", self.items, self.factors.itemFactors)):
            of_key = dictionary.join(factors, "id").select("key", F.col("features").alias("id"))
            found = with_ids(found, column, of_key, f"_{column}", "left")
        # in 32 bits and in the order of the factors, as the library does it
        value = F.lit(0.0).cast("float")
        for i in range(self.factors.rank):
            value = value + F.col("_user")[i] * F.col("_item")[i]
        return found.select(*rows.columns, F.when(~F.isnan(value), value.cast("double")).alias("prediction"))

    def save(self, path: str) -> None:
        self.factors.save(f"{path}/factors")
        self.users.write.parquet(f"{path}/users")
        self.items.write.parquet(f"{path}/items")

    @staticmethod
    def load(path: str) -> "RatingModel":
        read = SparkSession.getActiveSession().read
        return RatingModel(ALSModel.load(f"{path}/factors"), read.parquet(f"{path}/users"),
                           read.parquet(f"{path}/items"))


def train_ratings(rated: DataFrame, **options) -> RatingModel:
    """A model of ``user, item, rate`` with keys of any type; rows with a null key train nothing.

    The numbered ratings are stored, so the joins behind them are done once.
    """
    users, items = dense_keys(rated, "user"), dense_keys(rated, "item")
    numbered = with_ids(with_ids(rated, "user", users, "_user"), "item", items, "_item")
    rows = numbered.select(F.col("_user").alias("user"), F.col("_item").alias("item"), "rate")
    return RatingModel(train_als(stored(rows, "numbered"), **options), users, items)


def split_ratings(rated: DataFrame, ratio: float) -> tuple[DataFrame, DataFrame | None]:
    """Train and test ratings by a hash of user and item; every user keeps at least one rating in training.

    The rating that stays is the user's with the least hash (with equal hashes the least item). It is a grouped minimum with
    map-side combine and a join with one row a user, so a user with a third of all ratings is no window.
    Repeated pairs stay together. Needs no stored copy: a rerun gives the same rows.
    """
    if ratio >= 1.0:
        return rated, None
    name = F.concat(F.coalesce(F.col("user").cast("string"), F.lit("")), F.lit(":"),
                    F.coalesce(F.col("item").cast("string"), F.lit("")))
    hashed = rated.withColumn("_hash", key_hash(name))
    least = hashed.groupBy(F.col("user").alias("_user")).agg(
        F.min(F.struct(F.col("_hash").alias("h"), F.col("item").alias("i"))).alias("_least"))
    sides = hashed.join(least, F.col("user").eqNullSafe(F.col("_user")))
    kept = (F.col("_hash") == F.col("_least.h")) & F.col("item").eqNullSafe(F.col("_least.i"))
    trains = (F.col("_hash") < F.lit(float(ratio) * SPAN)) | kept
    return sides.where(trains).select(*rated.columns), sides.where(~trains).select(*rated.columns)


def join_predictions(rated: DataFrame, predicted: DataFrame) -> DataFrame:
    """``user, item, rate, prediction`` on equal user and item; repeated pairs multiply."""
    pairs = predicted.select("user", "item", "prediction")
    return rated.select("user", "item", "rate").join(pairs, ["user", "item"])


def score_ratings(model: ALSModel | RatingModel, rated: DataFrame) -> DataFrame:
    """Every row with its prediction, null for a user or item the model has not seen."""
    if isinstance(model, RatingModel):
        return model.transform(rated)
    keeping = model.copy({model.coldStartStrategy: "nan"})
    value = F.col("prediction").cast("double")
    return keeping.transform(rated).withColumn("prediction", F.when(~F.isnan("prediction"), value))
