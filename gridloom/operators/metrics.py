"""Evaluation: every metric is one aggregate with map-side combine."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import squared_distance


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of equal label and prediction (reported as F_measure)."""
    return scored.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def test_error(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.agg(F.avg((F.col(label) != F.col(prediction)).cast("double")).alias("test_error"))


def mean_squared_error(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.agg(F.avg(F.pow(F.col(label) - F.col(prediction), 2)).alias("mse"))


def root_mean_squared_error(scored: DataFrame, label: str = "label",
                            prediction: str = "prediction") -> DataFrame:
    return mean_squared_error(scored, label, prediction).select(F.sqrt("mse").alias("rmse"))


def mismatches(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.where(F.col(label) != F.col(prediction))


def contingency(scored: DataFrame, label: str = "label", cluster: str = "prediction") -> DataFrame:
    """``label, cluster, cnt``."""
    return (scored.groupBy(F.col(label).alias("label"), F.col(cluster).alias("cluster"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def distance_to(features: Column, centre: Sequence[float]) -> Column:
    """Squared distance of an ``array<double>`` column to a fixed centre."""
    if len(centre) <= 16:
        return squared_distance([features[i] for i in range(len(centre))],
                                [F.lit(float(c)) for c in centre])
    terms = F.zip_with(features, F.lit([float(c) for c in centre]), lambda a, b: (a - b) * (a - b))
    return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)


# Centres of up to this many numbers are written out as expressions.
WRITTEN_OUT_CENTRES = 256


def _nearest_in_batches(matrix: np.ndarray):
    """The nearest centre by one matrix product for each batch of rows.

    Expanded distances only choose the candidates: every centre within their rounding of the
    least is measured again by differences, so ties and costs are those of the expression.
    """
    squares = (matrix ** 2).sum(axis=1)

    @F.pandas_udf("cost double, cluster int")
    def nearest(rows: pd.Series) -> pd.DataFrame:
        cost, cluster = np.empty(len(rows)), np.empty(len(rows), np.int32)
        for at in range(0, len(rows), 1024):
            x = np.stack(rows.iloc[at: at + 1024].to_numpy())
            own = (x ** 2).sum(axis=1)
            near = squares - 2.0 * (x @ matrix.T)
            room = 1e-9 * (own + squares.max())
            i, j = np.nonzero(near <= (near.min(axis=1) + room)[:, None])
            exact = ((x[i] - matrix[j]) ** 2).sum(axis=1)
            order = np.lexsort((j, exact, i))
            first = order[np.unique(i[order], return_index=True)[1]]
            cost[at: at + len(x)], cluster[at: at + len(x)] = exact[first], j[first]
        return pd.DataFrame({"cost": cost, "cluster": cluster})

    return nearest


def nearest_centre(features: Column, centres: Sequence[Sequence[float]]) -> Column:
    """``struct<cost, cluster>`` of the nearest centre; the smaller index on a tie."""
    if sum(len(c) for c in centres) > WRITTEN_OUT_CENTRES:
        return _nearest_in_batches(np.array([[float(v) for v in c] for c in centres]))(features)
    costs = [F.struct(distance_to(features, c).alias("cost"), F.lit(i).alias("cluster"))
             for i, c in enumerate(centres)]
    return F.least(*costs) if len(costs) > 1 else costs[0]


def within_cluster_cost(points: DataFrame, centres: Sequence[Sequence[float]],
                        features: str = "features") -> DataFrame:
    """Sum of squared distances to the nearest centre (WSSSE)."""
    nearest = nearest_centre(vector_to_array(features), centres)
    return points.select(nearest["cost"].alias("cost")).agg(F.sum("cost").alias("cost"))


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    return assigned.groupBy(F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("size"))


def silhouette(assigned: DataFrame, cluster: str = "cluster", features: str = "features") -> DataFrame:
    """``silhouette``: how much nearer, on average, points are to their own cluster than to the next, from -1 to 1.

    Distances are squared, so the mean distance of a point to a cluster follows from the cluster's size,
    sum and sum of squares: one aggregate and one scan, no pairs. A point that is alone in its
    cluster counts 0, and so does every point of a single cluster. Sizes and sums of k clusters go to all tasks.
    """
    x = assigned.select(F.col(cluster).alias("c"), vector_to_array(features).alias("x")).where(F.col("c").isNotNull())
    square = F.aggregate("x", F.lit(0.0), lambda total, v: total + v * v)
    width = F.size("x")
    sums = x.select("c", square.alias("q"), F.posexplode("x").alias("i", "v"), width.alias("w")) \
        .groupBy("c", "i").agg(F.sum("v").alias("s"), F.sum(F.col("q")).alias("q"), F.count(F.lit(1)).alias("n"))
    found: dict = {}
    for r in sums.collect():  # clusters x features numbers
        found.setdefault(r["c"], {"n": r["n"], "q": r["q"], "s": {}})["s"][r["i"]] = r["s"]
    clusters = sorted(found)
    own, others = F.lit(None).cast("double"), []
    for c in clusters:
        n, mean = found[c]["n"], [found[c]["s"][i] / found[c]["n"] for i in range(len(found[c]["s"]))]
        # mean squared distance: around the centre, and the cluster's own spread
        spread = max(found[c]["q"] / n - sum(m * m for m in mean), 0.0)
        away = distance_to(F.col("x"), mean) + F.lit(spread)
        own = F.when(F.col("c") == F.lit(c), away * F.lit(n / (n - 1)) if n > 1 else F.lit(None)).otherwise(own)
        others.append(F.when(F.col("c") != F.lit(c), away))
    if len(clusters) < 2:
        return x.agg(F.when(F.count(F.lit(1)) > 0, F.lit(0.0)).alias("silhouette"))
    near = F.array_min(F.array(*others))
    scored = x.select(own.alias("a"), near.alias("b"))
    value = F.when(F.greatest("a", "b") > 0, (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return scored.agg(F.avg(F.when(F.col("a").isNull(), F.lit(0.0)).otherwise(F.coalesce(value, F.lit(0.0))))
                      .alias("silhouette"))


# What a grid point has to beat before it counts as best.
START_ACCURACY = -0.1
START_ERROR = 1e10


def best_points(metrics: DataFrame, larger_is_better: bool) -> DataFrame:
    """``job, best, value`` per job from ``(job, idx, value)``; the first wins a tie.

    When no point beats the start value the answer is index 0 with that value.
    """
    start = START_ACCURACY if larger_is_better else START_ERROR
    value = F.when(~F.isnan("value"), F.col("value"))
    beats = value > start if larger_is_better else value < start
    rank = F.struct((value if larger_is_better else -value).alias("score"),
                    (-F.col("idx")).alias("minus_idx"))
    top = metrics.groupBy("job").agg(F.max(F.when(beats, rank)).alias("top"))
    score = F.col("top.score") if larger_is_better else -F.col("top.score")
    return top.select(
        "job", F.coalesce(-F.col("top.minus_idx"), F.lit(0)).cast("int").alias("best"),
        F.coalesce(score, F.lit(start)).alias("value"))
