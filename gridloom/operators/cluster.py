"""Clustering: k-means, Gaussian mixture, bisecting k-means, power iteration."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import (
    BisectingKMeans, BisectingKMeansModel, GaussianMixture, GaussianMixtureModel, KMeans, KMeansModel,
    PowerIterationClustering)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.metrics import accuracy, cluster_sizes, nearest_centre
from gridloom.operators.reduce import Components, batch_sums, fit_components
from gridloom.operators.relabel import relabel
from gridloom.session import ensure_checkpoint_dir

SEED = 42


def train_kmeans(points: DataFrame, k: int = 3, iterations: int = 50, runs: int = 10,
                 init_mode: str = "k-means||", epsilon: float = 1e-4, seed: int = SEED) -> KMeansModel:
    """The cheapest of ``runs`` fits with different seeds."""
    best = None
    for run in range(max(1, runs)):
        learner = KMeans(k=k, maxIter=iterations, tol=epsilon, initMode=init_mode, seed=seed + run)
        model = learner.fit(points)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    return best


@dataclass
class Centres:
    """Cluster centres that assign points by plain column expressions."""

    values: list[list[float]]

    def transform(self, points: DataFrame) -> DataFrame:
        nearest = nearest_centre(vector_to_array("features"), self.values)
        return (points.withColumn("_nearest", nearest)
                .withColumn("prediction", F.col("_nearest.cluster").cast("double"))
                .withColumn("cost", F.col("_nearest.cost")).drop("_nearest"))


def refine_centres(points: DataFrame, centres: Sequence[Sequence[float]], iterations: int = 50,
                   epsilon: float = 1e-4) -> Centres:
    """K-means from given centres; one group-by with map-side combine per iteration.

    A centre without points stays where it is. Stops when no centre moves by more
    than ``epsilon``.
    """
    current = [[float(v) for v in c] for c in centres]
    width = len(current[0])
    rows = points.select(vector_to_array("features").alias("x")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(iterations):
            assigned = rows.select("x", nearest_centre(F.col("x"), current)["cluster"].alias("cluster"))
            means = assigned.groupBy("cluster").agg(*[F.avg(F.col("x")[i]) for i in range(width)]).collect()
            moved = {row[0]: [float(v) for v in row[1:]] for row in means}
            after = [moved.get(i, c) for i, c in enumerate(current)]
            shift = max(sum((a - b) ** 2 for a, b in zip(p, q)) for p, q in zip(after, current))
            current = after
            if shift <= epsilon * epsilon:
                break
    finally:
        rows.unpersist()
    return Centres(current)


def train_mixture(points: DataFrame, k: int = 3, iterations: int = 50, tol: float = 0.001,
                  seed: int = SEED) -> GaussianMixtureModel:
    return GaussianMixture(k=k, maxIter=iterations, tol=tol, seed=seed).fit(points)


@dataclass
class Mixture:
    """Gaussian components that score points by plain arithmetic; parameters are small and live on the driver."""

    weights: list[float]
    means: list[list[float]]
    covariances: list[list[list[float]]]

    def _densities(self, x: np.ndarray) -> np.ndarray:
        """Log of weight times density of every row under every component."""
        out = np.empty((len(x), len(self.weights)))
        for j, (weight, mean, covariance) in enumerate(zip(self.weights, self.means, self.covariances)):
            lower = np.linalg.cholesky(np.array(covariance, float))
            away = np.linalg.solve(lower, (x - np.array(mean, float)).T)
            constant = len(mean) * np.log(2 * np.pi) / 2 + np.log(np.diag(lower)).sum()
            out[:, j] = np.log(weight) - constant - (away * away).sum(0) / 2
        return out

    def shares(self, x: np.ndarray) -> np.ndarray:
        """How much each component answers for each row."""
        logs = self._densities(x)
        logs -= logs.max(1, keepdims=True)
        parts = np.exp(logs)
        return parts / parts.sum(1, keepdims=True)

    def transform(self, points: DataFrame) -> DataFrame:
        """The points with ``probability`` (an array) and the component that has most of it as ``prediction``."""
        model, k = self, len(self.weights)

        @F.arrow_udf("array<double>")
        def answered(x: pa.Array) -> pa.Array:
            rows = len(x)
            flat = x.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
            found = model.shares(flat).ravel() if rows else np.zeros(0)
            return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * k, pa.int32()), pa.array(found))
        scored = points.withColumn("probability", answered(vector_to_array("features")))
        best = F.array_position("probability", F.array_max("probability")) - 1
        return scored.withColumn("prediction", best.cast("double"))


def refine_mixture(points: DataFrame, start: Mixture, iterations: int = 50, tol: float = 0.0) -> Mixture:
    """EM from given components. A step is one aggregate: each task adds up shares and weighted moments of its rows.

    A component whose rows are answered for by others entirely stays as it is, with weight 0 only if no row gives it
    anything. Ends early when no mean moves by more than ``tol``.
    """
    rows = points.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    current, k, d = start, len(start.weights), len(start.means[0])
    try:
        for _ in range(iterations):
            centre = np.array(current.means, float)

            def moments(total: np.ndarray, x: np.ndarray, model: Mixture = current, centre: np.ndarray = centre) -> None:
                shares = model.shares(x)
                for j in range(k):
                    away = x - centre[j]  # around the old mean, so that no digits are lost
                    part = shares[:, j]
                    total[j] += part.sum()
                    total[k + j * d: k + (j + 1) * d] += part @ away
                    at = k + k * d + j * d * d
                    total[at: at + d * d] += ((away * part[:, None]).T @ away).ravel()
            sums, n = batch_sums(rows, k + k * d + k * d * d, moments)
            if not n:
                break
            weights, means, covariances = [], [], []
            for j in range(k):
                if sums[j] <= 0.0:
                    weights.append(0.0)
                    means.append(current.means[j])
                    covariances.append(current.covariances[j])
                    continue
                shift = sums[k + j * d: k + (j + 1) * d] / sums[j]
                at = k + k * d + j * d * d
                square = sums[at: at + d * d].reshape(d, d) / sums[j] - np.outer(shift, shift)
                weights.append(float(sums[j] / n))
                means.append((centre[j] + shift).tolist())
                covariances.append(square.tolist())
            moved = float(np.abs(np.array(means) - centre).max())
            current = Mixture(weights, means, covariances)
            if moved <= tol:
                break
    finally:
        rows.unpersist()
    return current


def as_mixture(model: GaussianMixtureModel) -> Mixture:
    """The components of a trained (or loaded) model."""
    return Mixture([float(w) for w in model.weights], [g.mean.toArray().tolist() for g in model.gaussians],
                   [g.cov.toArray().tolist() for g in model.gaussians])


def train_bisecting(points: DataFrame, k: int = 4, iterations: int = 20,
                    min_divisible: float = 1.0, seed: int = SEED) -> BisectingKMeansModel:
    learner = BisectingKMeans(k=k, maxIter=iterations, minDivisibleClusterSize=min_divisible, seed=seed)
    return learner.fit(points)


@dataclass
class ReducedClusters:
    model: KMeansModel
    components: Components | None
    accuracy: float
    cost: float
    relabelled: DataFrame

    def transform(self, points: DataFrame) -> DataFrame:
        return self.model.transform(_reduced(points, self.components))


def _reduced(points: DataFrame, components: Components | None) -> DataFrame:
    if components is None:
        return points
    return components.transform(points).drop("features").withColumnRenamed("projected", "features")


def cluster_with_reduction(points: DataFrame, k: int = 3, iterations: int = 50, runs: int = 10,
                           reduce: bool = False, seed: int = SEED) -> ReducedClusters:
    """K-means on labelled points, optionally on two principal components first.

    Both measures are taken: accuracy after relabelling and the cost in the space
    that was clustered.
    """
    components = fit_components(points, 2) if reduce else None
    rows = _reduced(points, components).persist()
    try:
        kmeans = train_kmeans(rows, k, iterations, runs, seed=seed)
        cost = kmeans.summary.trainingCost
        relabelled = relabel(kmeans.transform(rows), k)
        share = accuracy(relabelled, prediction="newLabel").first()[0]
    finally:
        rows.unpersist()
    return ReducedClusters(kmeans, components, share, cost, relabelled)


def power_iteration(edges: DataFrame, k: int = 3, iterations: int = 50, mode: str = "random",
                    members: DataFrame | None = None) -> DataFrame:
    """``id, cluster`` for a weighted edge table ``src, dst, weight``.

    With ``members`` (``id, class``) the edges are between classes and hold for all members: each member of ``src`` is
    linked with each of ``dst``, and an edge from a class to itself links its members with one another. A group of
    equal points is then one edge, not one for every two of them.
    """
    if members is not None:
        return _clusters_of_values(power_values(edges, members, iterations, mode), k)
    learner = PowerIterationClustering(k=k, maxIter=iterations, initMode=mode, weightCol="weight")
    stored = edges.persist(StorageLevel.MEMORY_AND_DISK)  # the iterations read the edges again and again
    try:
        if stored.isEmpty():  # the learner itself fails on a graph without edges
            return edges.sparkSession.createDataFrame([], "id bigint, cluster int")
        return learner.assignClusters(stored)
    finally:
        stored.unpersist()


def power_values(edges: DataFrame, members: DataFrame, iterations: int = 50, mode: str = "random") -> DataFrame:
    """``id, start, value`` after so many multiplications by the graph's row-normalised weights.

    Members with the same classes have the same neighbours, so their values are ``a * start + b`` with one ``a`` and ``b``
    for all of them: an iteration reads one row of each such kind and the edges between kinds, not the members. Random
    starts are normal numbers made of the id, the same on any partitioning. Nodes without a link are left out. A row
    of weights adds up to 1, so values need no scaling on the way; all ``iterations`` are done.
    """
    if mode not in ("random", "degree"):
        raise ValueError("mode must be random or degree")
    ensure_checkpoint_dir(edges.sparkSession)
    # an id that comes several times has links of several times the weight
    profile = F.array_sort(F.collect_list(F.struct("class", "times")))
    nodes = (members.select(F.col("id").cast("bigint").alias("id"), "class").where("id IS NOT NULL AND class IS NOT NULL")
             .groupBy("id", "class").agg(F.count(F.lit(1)).alias("times"))
             .groupBy("id").agg(profile.alias("profile"))
             .select("id", F.to_json("profile").alias("kind"), "profile", _normal(F.col("id")).alias("start")).checkpoint())
    kinds = nodes.groupBy("kind").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("start").alias("starts"),
                                      F.first("profile").alias("profile"))
    held = kinds.select("kind", F.explode("profile").alias("p")).select("kind", "p.class", "p.times")
    both = edges.select("src", "dst", "weight").union(
        edges.where("src <> dst").select("dst", "src", "weight")).where("weight > 0")
    there = held.select(F.col("kind").alias("other"), F.col("class").alias("dst"), F.col("times").alias("there"))
    links = (held.withColumnRenamed("class", "src").join(both, "src").join(there, "dst")
             .groupBy("kind", "other").agg(F.sum(F.col("weight") * F.col("times") * F.col("there")).alias("weight"))
             .checkpoint())
    own = links.where("kind = other").select("kind", F.col("weight").alias("own"))
    sums = kinds.select(F.col("kind").alias("other"), F.col("n").alias("n_other"))
    degrees = links.join(sums, "other").groupBy("kind").agg(F.sum(F.col("weight") * F.col("n_other")).alias("all"))
    degree = F.col("all") - F.col("own")
    state = (kinds.select("kind", "n", "starts").join(degrees, "kind").join(own, "kind", "left").fillna(0.0, ["own"])
             .withColumn("degree", degree).where("degree > 0").drop("all"))
    by_degree = F.lit(mode == "degree")
    state = state.select("kind", "n", "starts", "own", "degree", F.when(by_degree, 0.0).otherwise(1.0).alias("a"),
                         F.when(by_degree, F.col("degree")).otherwise(0.0).alias("b")).checkpoint()
    for _ in range(iterations):
        sent = state.select(F.col("kind").alias("other"), (F.col("a") * F.col("starts") + F.col("b") * F.col("n")).alias("sent"))
        came = links.join(sent, "other").groupBy("kind").agg(F.sum(F.col("weight") * F.col("sent")).alias("came"))
        state = state.join(came, "kind").select(
            "kind", "n", "starts", "own", "degree", (-F.col("own") * F.col("a") / F.col("degree")).alias("a"),
            ((F.col("came") - F.col("own") * F.col("b")) / F.col("degree")).alias("b")).checkpoint()
    return nodes.join(state.select("kind", "a", "b"), "kind").select(
        "id", "start", (F.col("a") * F.col("start") + F.col("b")).alias("value"))


def _normal(key: Column) -> Column:
    """A normal number made of a key (two uniform ones, by Box and Muller)."""
    even = [(F.shiftrightunsigned(F.xxhash64(key, F.lit(SEED + i)), 11) + 0.5) / F.lit(float(1 << 53)) for i in range(2)]
    return F.sqrt(-2.0 * F.log(even[0])) * F.cos(2.0 * F.pi() * even[1])


def _clusters_of_values(values: DataFrame, k: int) -> DataFrame:
    """``id, cluster`` by k-means on the values, scaled to one on average so that its tolerance does not depend on them."""
    stored = values.select("id", "value").checkpoint()
    size = stored.agg(F.avg(F.abs("value"))).first()[0]
    if size is None:
        return values.sparkSession.createDataFrame([], "id bigint, cluster int")
    points = stored.select("id", array_to_vector(F.array(F.col("value") / F.lit(size or 1.0))).alias("features"))
    model = KMeans(k=k, seed=0).fit(points)
    return model.transform(points).select("id", F.col("prediction").alias("cluster"))


def cluster_report(assigned: DataFrame, cluster: str = "cluster", member: str = "id") -> DataFrame:
    """Clusters by ascending size with their sorted members, one row per member.

    A cluster may hold most of the points, so members stay rows: the order is a
    range-partitioned sort, never a list gathered in one task. The sizes are
    joined without a hint; they are broadcast when their measured size allows it.
    """
    sizes = cluster_sizes(assigned, cluster)
    members = assigned.select(F.col(cluster).alias("cluster"), F.col(member).alias("id"))
    return members.join(sizes, "cluster").select("cluster", "size", "id").orderBy(
        "size", "cluster", "id")
