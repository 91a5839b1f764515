"""Give clusters the labels they match best, one to one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.metrics import contingency

_MAPPING = T.StructType([T.StructField("cluster", T.DoubleType()),
                         T.StructField("label", T.DoubleType())])


def relabel_map(table: DataFrame, k: int) -> dict[float, float]:
    """cluster -> label by greedy choice: larger counts first, then label, then cluster.

    ``k`` is the number of clusters. A cluster can lose at most k-1 labels to the other clusters, so its choice is
    always among its k most frequent labels: k*k rows decide the whole mapping,
    however many labels there are. Only those rows come to the driver.
    """
    order = [F.desc("cnt"), F.asc("label")]
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(*order))
    rows = (table.withColumn("rank", rank).where(F.col("rank") <= k)
            .orderBy(*order, F.asc("cluster")).collect())
    mapping: dict[float, float] = {}
    used: set[float] = set()
    for row in rows:
        if row["label"] not in used and row["cluster"] not in mapping:
            mapping[row["cluster"]] = row["label"]
            used.add(row["label"])
    return mapping


def apply_relabel(scored: DataFrame, mapping: dict[float, float],
                  cluster: str = "prediction", name: str = "newLabel") -> DataFrame:
    """Left lookup of the (at most k) mapped clusters; label 0 for the others."""
    spark = scored.sparkSession
    pairs = [(float(c), float(label)) for c, label in sorted(mapping.items())]
    lookup = spark.createDataFrame(pairs, _MAPPING).toDF("_cluster", "_label")
    joined = scored.join(F.broadcast(lookup), F.col(cluster).cast("double") == F.col("_cluster"), "left")
    return (joined.withColumn(name, F.coalesce("_label", F.lit(0.0)))
            .withColumn("mapped", F.col("_label").isNotNull()).drop("_cluster", "_label"))


def relabel(scored: DataFrame, k: int, label: str = "label", cluster: str = "prediction") -> DataFrame:
    """Scored rows with ``newLabel`` and ``mapped``."""
    return apply_relabel(scored, relabel_map(contingency(scored, label, cluster), k), cluster)
