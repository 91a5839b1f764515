"""Frequent itemsets, association rules and sequential patterns."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.fpm import PrefixSpan
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class ItemsetModel:
    """Frequent itemsets as a table ``items, freq``."""

    frequent: DataFrame
    min_confidence: float


def _item_counts(baskets: DataFrame) -> DataFrame:
    """``one, n``: how many baskets have each item (a struct); in the row without one the number of baskets."""
    alone = F.when(F.size(F.array_distinct("items")) == F.size("items"), F.col("items")) \
        .otherwise(F.raise_error(F.lit("items in a basket must be unique")))
    ones = F.transform(alone, lambda x: F.struct(x.alias("item")))
    return baskets.select(F.explode(F.concat(ones, F.array(F.lit(None)))).alias("one")) \
        .groupBy("one").agg(F.count(F.lit(1)).alias("n"))


def weighted_paths(baskets: DataFrame, singles: DataFrame) -> DataFrame:
    """``path, n``: the items of ``singles`` (``item, freq``) in each basket, most frequent first, and how many baskets have just these.

    Baskets with fewer than two such items are left out.
    """
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("freq")).alias("rank"), "item")))
    order = singles.agg(F.transform(ranked, lambda x: x["item"]).alias("order"))
    return baskets.crossJoin(F.broadcast(order)).select(F.array_intersect("order", "items").alias("path")) \
        .where(F.size("path") > 1).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


def mine_itemsets(baskets: DataFrame, min_support: float = 0.3, min_confidence: float = 0.8,
                  partitions: int = -1) -> ItemsetModel:
    """FP-growth on an ``items`` column of distinct items; baskets that are null do not count.

    Patterns grow from the rarer items to the more frequent ones, all of one size at once. The conditional
    bases of all patterns of a size are one table ``suffix, path, n``, in which equal paths are one row, so no
    task holds the baskets of a pattern and none keeps whole baskets. ``partitions`` deals the distinct paths.
    """
    if not (0.0 <= min_support <= 1.0 and 0.0 <= min_confidence <= 1.0):
        raise ValueError("support and confidence are between 0 and 1")
    ensure_checkpoint_dir(baskets.sparkSession)
    baskets = baskets.select("items").where(F.col("items").isNotNull())
    counted = _item_counts(baskets).persist(StorageLevel.MEMORY_AND_DISK)
    total = counted.where(F.col("one").isNull()).first()
    least = math.ceil(min_support * (total["n"] if total else 0))
    singles = counted.where(F.col("one").isNotNull() & (F.col("n") >= least)) \
        .select(F.col("one.item").alias("item"), F.col("n").alias("freq")).checkpoint()
    counted.unpersist()
    frequent = singles.select(F.array("item").alias("items"), "freq")
    paths = weighted_paths(baskets, singles)
    paths = paths.repartition(partitions) if partitions > 0 else paths
    grown = paths.select(F.slice("path", 1, 0).alias("suffix"), "path", "n")
    while True:
        bases = grown.select("suffix", "path", "n", F.posexplode("path").alias("at", "item")).where(F.col("at") > 0) \
            .select(F.concat("suffix", F.array("item")).alias("suffix"), F.slice("path", 1, F.col("at")).alias("path"), "n") \
            .groupBy("suffix", "path").agg(F.sum("n").alias("n")).checkpoint()
        longer = bases.select("suffix", F.explode("path").alias("item"), "n") \
            .groupBy("suffix", "item").agg(F.sum("n").alias("freq")).where(F.col("freq") >= least).checkpoint()
        if longer.isEmpty():
            return ItemsetModel(frequent, min_confidence)
        frequent = frequent.union(longer.select(F.concat("suffix", F.array("item")), "freq"))
        # an item that is rare beside a pattern is rare beside all that grow from it
        beside = longer.groupBy("suffix").agg(F.collect_list(F.struct("item")).alias("beside"))
        grown = bases.join(beside, "suffix") \
            .select("suffix", F.array_intersect("path", F.transform("beside", lambda x: x["item"])).alias("path"), "n") \
            .where(F.size("path") > 1)


def itemsets(model: ItemsetModel) -> DataFrame:
    """``items`` (sorted), ``freq``."""
    return model.frequent.select(F.array_sort("items").alias("items"), "freq")


def rules(model: ItemsetModel) -> DataFrame:
    """``antecedent`` (sorted), ``consequent``, ``confidence``; none at confidence 0."""
    found = rules_from_itemsets(model.frequent, model.min_confidence)
    return found if model.min_confidence > 0.0 else found.where(F.lit(False))


def rules_from_itemsets(frequent: DataFrame, min_confidence: float = 0.8) -> DataFrame:
    """Rules with one consequent item from given itemsets ``items, freq``.

    Each itemset gives one row per item; an equi-join on the rest of the set
    finds the antecedent's own frequency.
    """
    sets = frequent.select(F.array_sort("items").alias("items"), "freq")
    whole = (sets.where(F.size("items") > 1)
             .select("items", "freq", F.explode("items").alias("item"))
             .select(F.array_remove("items", F.col("item")).alias("antecedent"),
                     F.array("item").alias("consequent"), "freq"))
    parts = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("part_freq"))
    return (whole.join(parts, "antecedent")
            .select("antecedent", "consequent",
                    (F.col("freq").cast("double") / F.col("part_freq")).alias("confidence"))
            .where(F.col("confidence") >= min_confidence))


def sequential_patterns(sequences: DataFrame, min_support: float = 0.5, max_length: int = 5) -> DataFrame:
    """``sequence, freq`` from an ``array<array<...>>`` column ``sequence``."""
    return PrefixSpan(minSupport=min_support, maxPatternLength=max_length,
                      sequenceCol="sequence").findFrequentSequentialPatterns(sequences)
