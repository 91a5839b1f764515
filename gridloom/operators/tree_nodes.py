"""Saved tree models as tables of nodes, and the expressions that state the same predictions.

Decision trees, forests and boosted sums are read back as one row a node, which can be queried like any table, and
compiled into plain column expressions, so scoring needs no model object and stays in generated code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Algorithm ids of single trees (5 and 9 are forests, 6 and 10 boosted sums).
TREES = (4, 8)
COUNTING = ("DecisionTree", "RandomForest")  # classifiers whose nodes have class counts; boosted ones have trees of numbers


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """``tree, weight, node, low, high, feature, threshold, categories, prediction, votes, n`` of a saved model.

    ``low`` and ``high`` are the children, null in a leaf. A row goes low when its feature is
    at most ``threshold`` or, for a categorical feature, one of ``categories``. ``votes`` are the class counts of a node,
    ``n`` its rows: the sum of the counts, or the first of the sums that a tree of numbers has. A model that was trained on
    rows with weights counts them by their weight.
    """
    of_classes = any(f".{kind}ClassificationModel" in spark.read.text(f"{path}/metadata").first()[0] for kind in COUNTING)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        nodes = data.select(F.col("treeID").alias("tree"), "nodeData.*")
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight").drop("metadata")
        nodes = nodes.join(weights, "tree")
    else:
        nodes = data.select(F.lit(0).alias("tree"), "*", F.lit(1.0).alias("weight"))
    inner = F.col("leftChild") >= 0
    arity, cut = F.col("split.numCategories"), F.col("split.leftCategoriesOrThreshold")
    return nodes.select(
        "tree", "weight", F.col("id").alias("node"), F.when(inner, F.col("leftChild")).alias("low"),
        F.when(inner, F.col("rightChild")).alias("high"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & (arity < 0), F.get(cut, F.lit(0))).alias("threshold"),
        F.when(inner & (arity >= 0), cut).alias("categories"), "prediction", F.col("impurityStats").alias("votes"),
        F.round(F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b) if of_classes else F.get("impurityStats", F.lit(0)))
        .cast("bigint").alias("n"))


def _walk(nodes: dict[int, Row], at: int, x: Column, leaf) -> Column:
    node = nodes[at]
    if node["low"] is None:
        return leaf(node)
    value = x[node["feature"]]
    low = value.isin(node["categories"]) if node["threshold"] is None else value <= F.lit(node["threshold"])
    return F.when(low, _walk(nodes, node["low"], x, leaf)).otherwise(_walk(nodes, node["high"], x, leaf))


def _summed(parts: list[Column]) -> Column:
    return reduce(Column.__add__, parts)


def compiled(nodes: DataFrame, algorithm_id: int, features: str = "features") -> Column:
    """The prediction of a model's nodes as one expression of the feature vector.

    The nodes come to the driver: a model of trees has at most ``2^(depth + 1)`` of them a tree, whatever the
    training data. Forests of classes add up the shares of votes, the first of equal classes wins; other forests
    average; boosted trees add weighted predictions, and class 1 has a sum above 0.
    """
    x = vector_to_array(features)
    trees: dict[int, dict[int, Row]] = {}
    weights: dict[int, float] = {}
    for row in nodes.collect():
        trees.setdefault(row["tree"], {})[row["node"]] = row
        weights[row["tree"]] = row["weight"]
    order = sorted(trees)
    if algorithm_id == 5:
        classes = len(trees[order[0]][0]["votes"])

        def share(c: int):
            return lambda node: F.lit(node["votes"][c] / sum(node["votes"]) if sum(node["votes"]) else 0.0)
        raw = [_summed([_walk(trees[t], 0, x, share(c)) for t in order]) for c in range(classes)]
        best = F.greatest(*raw)
        return F.coalesce(*[F.when(v == best, F.lit(float(c))) for c, v in enumerate(raw)])
    values = [_walk(trees[t], 0, x, lambda node: F.lit(node["prediction"])) for t in order]
    if algorithm_id in TREES:
        return values[0]
    if algorithm_id == 9:
        return _summed(values) / F.lit(float(len(order)))
    total = _summed([v * F.lit(weights[t]) for t, v in zip(order, values)])
    return F.when(total > 0, F.lit(1.0)).otherwise(F.lit(0.0)) if algorithm_id == 6 else total


def score_by_nodes(nodes: DataFrame, algorithm_id: int, points: DataFrame) -> DataFrame:
    """The points with their ``prediction`` by the node table."""
    return points.withColumn("prediction", compiled(nodes, algorithm_id))
