import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions.columns import gaussian_similarity, squared_distance
from gridloom.operators import cluster, metrics, pairs, relabel, rows


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    centres = [(0, 0), (10, 0), (0, 10)]
    table = [(f"{c}-{i}", float(c), *map(float, rng.normal(size=2) * 0.5 + centres[c]))
             for c in range(3) for i in range(40)]
    return rows.cluster_points(spark.createDataFrame(table, "k string, y double, a double, b double"), True).cache()


def counts(spark, table):
    return spark.createDataFrame(table, "label double, cluster double, cnt bigint")


def test_greedy_relabel(spark):
    table = counts(spark, [(0.0, 1.0, 9), (1.0, 1.0, 8), (1.0, 0.0, 7), (2.0, 2.0, 1)])
    assert relabel.relabel_map(table, 3) == {1.0: 0.0, 0.0: 1.0, 2.0: 2.0}


def test_unmapped_cluster_becomes_zero(spark):
    rowset = [("a", 0.0, 0.0)] * 5 + [("b", 0.0, 1.0)] * 3
    scored = spark.createDataFrame(rowset, "key string, label double, prediction double")
    found = relabel.relabel(scored, 2).groupBy("prediction", "newLabel", "mapped").count().collect()
    assert sorted(tuple(r) for r in found) == [(0.0, 0.0, True, 5), (1.0, 0.0, False, 3)]


def test_relabel_with_many_labels_equals_the_full_greedy(spark):
    rng = np.random.default_rng(1)
    cells = [(float(label), float(c), int(n)) for label in range(60) for c, n in
             enumerate(rng.integers(1, 30, size=4))]
    wanted, used = {}, set()
    for label, c, _ in sorted(cells, key=lambda r: (-r[2], r[0], r[1])):
        if label not in used and c not in wanted:
            wanted[c] = label
            used.add(label)
    assert relabel.relabel_map(counts(spark, cells), 4) == wanted


def test_kmeans_finds_blobs_and_its_cost(blobs):
    model = cluster.train_kmeans(blobs, k=3, runs=3)
    scored = relabel.relabel(model.transform(blobs), 3)
    assert metrics.accuracy(scored, prediction="newLabel").first()[0] == 1.0
    cost = metrics.within_cluster_cost(blobs, [c.tolist() for c in model.clusterCenters()]).first()[0]
    assert cost == pytest.approx(model.summary.trainingCost, rel=1e-9)


def test_cost_never_rises_from_given_centres(blobs):
    start = [[1.0, 1.0], [2.0, 2.0], [3.0, 3.0]]
    costs = [metrics.within_cluster_cost(blobs, cluster.refine_centres(blobs, start, n).values).first()[0]
             for n in (1, 2, 4, 8)]
    assert costs == sorted(costs, reverse=True)


def test_wide_centres_agree_with_numpy(spark):
    rng = np.random.default_rng(2)
    x, c = rng.normal(size=(30, 20)), rng.normal(size=(4, 20))
    source = spark.createDataFrame([(str(i), *map(float, r)) for i, r in enumerate(x)])
    found = cluster.Centres(c.tolist()).transform(rows.scoring_points(source)).select("key", "prediction").collect()
    wanted = ((x[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert {r["key"]: int(r["prediction"]) for r in found} == {str(i): int(w) for i, w in enumerate(wanted)}


def test_mixture_and_bisecting_find_blobs(blobs):
    for model in (cluster.train_mixture(blobs, k=3, iterations=30), cluster.train_bisecting(blobs, k=3)):
        scored = relabel.relabel(model.transform(blobs), 3)
        assert metrics.accuracy(scored, prediction="newLabel").first()[0] > 0.9


def test_one_feature_clusters_are_intervals(spark):
    values = [1, 2, 3, 100, 101, 103, 500, 510]
    points = rows.scoring_points(spark.createDataFrame([(str(v), float(v)) for v in values]))
    scored = cluster.train_kmeans(points, k=3, runs=2).transform(points)
    ranges = scored.groupBy("prediction").agg(F.min(F.col("key").cast("int")), F.max(F.col("key").cast("int"))).collect()
    spans = sorted((r[1], r[2]) for r in ranges)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_reduction_before_clustering(blobs):
    found = cluster.cluster_with_reduction(blobs, k=3, runs=2, reduce=True)
    assert found.accuracy == 1.0 and found.cost > 0
    assert found.transform(blobs).select("prediction").distinct().count() == 3


def test_cluster_report_order(spark):
    assigned = spark.createDataFrame([(3, 0), (1, 0), (9, 1)], "id bigint, cluster int")
    found = [tuple(r) for r in cluster.cluster_report(assigned).collect()]
    assert found == [(1, 1, 9), (0, 2, 1), (0, 2, 3)]


def circles(count, points):
    return [(r * math.cos(2 * math.pi * i / (r * points)), r * math.sin(2 * math.pi * i / (r * points)))
            for r in range(1, count + 1) for i in range(r * points)]


def test_power_iteration_on_circles(spark):
    table = [(i, x, y) for i, (x, y) in enumerate(circles(3, 5))]
    points = spark.createDataFrame(table, "id bigint, x double, y double")
    edges = pairs.similar_pairs(points, "id", ["x", "y"], 1e-9)
    assert edges.count() == 435
    assert edges.agg(F.sum("weight")).first()[0] == pytest.approx(43.343633, abs=1e-6)
    assigned = cluster.power_iteration(edges, k=3, iterations=20)
    assert assigned.count() == 30
    assert assigned.select("cluster").distinct().count() <= 3


@pytest.mark.parametrize("rows_per_task", [3, 20_000])
def test_similar_pairs_equal_brute_force_with_a_crowded_cell(spark, rows_per_task):
    rng = np.random.default_rng(4)
    xy = np.vstack([rng.uniform(0, 6, size=(80, 2)), np.full((40, 2), 3.0)])  # a third are copies
    points = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(xy)], "id bigint, x double, y double")
    found = pairs.similar_pairs(points, "id", ["x", "y"], 0.7, rows_per_task)
    limit = pairs.radius_squared(0.7)
    wanted = {(i, j) for i in range(len(xy)) for j in range(i + 1, len(xy))
              if ((xy[i] - xy[j]) ** 2).sum() <= limit}
    got = [(r["src"], r["dst"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == wanted


def test_similarity_formula(spark):
    frame = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    value = gaussian_similarity(squared_distance([F.col("a")], [F.col("b")]))
    assert frame.select(value).first()[0] == pytest.approx(math.exp(-0.5))


def test_best_point_first_wins_and_start_value(spark):
    table = spark.createDataFrame(
        [("a", 0, 0.5), ("a", 1, 0.7), ("a", 2, 0.7), ("b", 0, float("nan"))], "job string, idx int, value double")
    found = {r["job"]: (r["best"], r["value"]) for r in metrics.best_points(table, True).collect()}
    assert found == {"a": (1, 0.7), "b": (0, -0.1)}
    errors = spark.createDataFrame([("a", 0, 2e10), ("c", 0, 3.0), ("c", 1, 3.0)], "job string, idx int, value double")
    found = {r["job"]: (r["best"], r["value"]) for r in metrics.best_points(errors, False).collect()}
    assert found == {"a": (0, 1e10), "c": (0, 3.0)}


def test_many_centres_assign_as_written_out_ones(spark, monkeypatch):
    rng = np.random.default_rng(6)
    xy = rng.integers(0, 5, size=(400, 3)).astype(float)  # whole numbers: many ties
    centres = [*rng.integers(0, 5, size=(40, 3)).astype(float).tolist(), xy[0].tolist(), xy[0].tolist()]
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(xy)], "id int, x array<double>")

    def found():
        nearest = metrics.nearest_centre(F.col("x"), centres)
        return sorted(frame.select("id", nearest["cluster"], nearest["cost"]).collect())

    monkeypatch.setattr(metrics, "WRITTEN_OUT_CENTRES", 10_000)
    written = found()
    monkeypatch.setattr(metrics, "WRITTEN_OUT_CENTRES", 0)
    assert found() == written


def test_similar_pairs_are_never_broadcast(spark):
    points = spark.createDataFrame([(i, float(i), 0.0) for i in range(50)], "id bigint, x double, y double")
    plan = pairs.similar_pairs(points, "id", ["x", "y"], 0.7)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan


def test_power_iteration_without_edges(spark):
    edges = spark.createDataFrame([], "src bigint, dst bigint, weight double")
    assert cluster.power_iteration(edges).count() == 0


@pytest.mark.parametrize("mode", ["random", "degree"])
def test_power_iteration_of_classes_is_that_of_all_links(spark, mode):
    # three places in a row, one apart; ids 3 and 20 come twice, 20 in two classes; class 9 has no link
    rows = [(i, i % 3) for i in range(14)] + [(3, 0), (20, 3), (20, 4), (21, 3), (22, 4), (23, 4), (30, 9), (None, 1), (31, None)]
    links = {(0, 0): 1.0, (1, 1): 1.0, (2, 2): 1.0, (0, 1): 0.7, (1, 2): 0.2, (3, 3): 1.0, (4, 4): 0.5}
    edges = spark.createDataFrame([(*k, w) for k, w in links.items()], "src int, dst int, weight double")
    members = spark.createDataFrame(rows, "id int, class int")
    found = {r["id"]: (r["start"], r["value"]) for r in cluster.power_values(edges, members, 4, mode).collect()}
    ids = sorted({i for i, c in rows if i is not None and c is not None and c != 9})
    assert sorted(found) == ids
    weights = np.zeros((len(ids), len(ids)))
    for i, c in rows:
        for j, d in rows:
            if i in found and j in found and i != j and None not in (c, d):
                weights[ids.index(i), ids.index(j)] += links.get((c, d), links.get((d, c), 0.0))
    degrees = weights.sum(1)
    value = np.array([found[i][0] for i in ids]) if mode == "random" else degrees
    for _ in range(4):
        value = weights @ value / degrees
    assert np.allclose([found[i][1] for i in ids], value, rtol=1e-9, atol=1e-12)
    assigned = cluster.power_iteration(edges, 2, 4, mode, members)
    assert assigned.columns == ["id", "cluster"] and sorted(r["id"] for r in assigned.collect()) == ids
    assert cluster.power_iteration(edges.limit(0), members=members).count() == 0


def test_links_of_places_are_those_of_all_points(spark):
    xy = [(1.0, 1.0)] * 5 + [(1.0, 1.5)] * 4 + [(9.0, 9.0), (None, 1.0)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(xy)], "id bigint, x double, y double")
    links, members = pairs.similar_classes(points, "id", ["x", "y"], 0.7)
    assert links.count() == 4  # three places and one link between two of them, whatever the number of copies
    of = {r["id"]: r["class"] for r in members.collect()}
    near = {(r["src"], r["dst"]) for r in links.collect()}
    found = {(i, j) for i in of for j in of if i < j and ((of[i], of[j]) in near or (of[j], of[i]) in near)}
    assert found == {(r["src"], r["dst"]) for r in pairs.similar_pairs(points, "id", ["x", "y"], 0.7).collect()}
