"""Distributed forms against plain numpy and the library: components, blocks, pairs, mixtures, keys, nodes, terms."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gridloom.operators import cluster, isotonic, linear, metrics, pairs, recommend, reduce, rows, terms, topics, trees
from gridloom.operators.keys import dense_keys, with_ids
from gridloom.operators.scoring import score
from gridloom.operators.split import split_by_key
from gridloom.operators.tree_nodes import node_table, score_by_nodes
from gridloom.plans import jobs
from gridloom.session import forget
from gridloom.sources.models import load_model


def vectors(spark, matrix, partitions=5):
    frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(matrix)], "id long, x array<double>")
    return frame.repartition(partitions).select("id", array_to_vector("x").alias("features"))


# --- components ---

@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(3)
    return rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20)) + rng.normal(size=20) * 1e5


@pytest.mark.parametrize("limit", [2000, 5])
def test_components_of_wide_rows(spark, cloud, limit):
    """With the matrix on the driver, and by block power iteration without it."""
    found = reduce.fit_components(vectors(spark, cloud), 4, matrix_limit=limit)
    values, axes = np.linalg.eigh(np.cov(cloud.T))
    values, axes = values[::-1], axes[:, ::-1][:, :4]
    assert found.explained == pytest.approx((values / values.sum())[:4], rel=1e-6)
    assert found.variance == pytest.approx(values.sum(), rel=1e-8)
    assert np.abs((axes * found.v).sum(0)) == pytest.approx(np.ones(4), abs=1e-6)
    assert (found.v[np.abs(found.v).argmax(0), np.arange(4)] > 0).all()


@pytest.mark.parametrize("limit", [2000, 5])
def test_singular_values_of_wide_rows(spark, cloud, limit):
    small = cloud[:, :12] - cloud[:, :12].mean(0)
    found = reduce.singular_values(vectors(spark, small), 5, matrix_limit=limit)
    assert found.values == pytest.approx(np.linalg.svd(small)[1][:5], rel=1e-7)
    u = np.array([r["u"].toArray() for r in found.u.orderBy("id").collect()])
    assert np.allclose(u.T @ u, np.eye(5), atol=1e-6)


def test_components_of_constant_and_single_rows(spark):
    same = reduce.fit_components(vectors(spark, np.ones((7, 20))), 2)
    assert same.explained == [0.0, 0.0] and same.variance == 0.0
    assert reduce.fit_components(vectors(spark, np.ones((1, 2))), 2).explained == [0.0, 0.0]


# --- isotonic blocks ---

@pytest.mark.parametrize("size,increasing", [(1000, True), (1000, False), (9, True), (9, False)])
def test_blocks_equal_the_library(spark, size, increasing):
    rng = random.Random(size + increasing)
    sign = 1 if increasing else -1
    table = [(float(rng.randrange(250)), rng.gauss(0, 40) + sign * i, 1.0 + rng.randrange(3)) for i in range(250)]
    table = [(x, y + sign * x, w) for x, y, w in table]
    points = spark.createDataFrame([*table, (None, 1.0, 1.0)], "feature double, label double, weight double")
    theirs = isotonic.train_isotonic(points.dropna(), increasing)
    ours = isotonic.train_isotonic_blocks(points, increasing, blocks_per_task=size)
    asked = spark.createDataFrame([(x / 3,) for x in range(-9, 780, 7)] + [(None,), (3.0,), (3.0,)], "feature double")
    want = sorted((r[0], r[1]) for r in theirs.transform(asked.dropna()).select("feature", "prediction").collect())
    for held in (10_000, 0):
        found = ours.transform(asked, held).select("feature", "prediction").collect()
        assert sum(r[0] is None for r in found) == 1 and all(r[1] is None for r in found if r[0] is None)
        assert np.allclose(sorted(tuple(r) for r in found if r[0] is not None), want, atol=1e-9)


def test_blocks_of_falling_and_of_no_points(spark):
    """One block is left of labels that only fall, whatever the ranges."""
    falling = spark.createDataFrame([(float(i), float(-i), 1.0) for i in range(64)],
                                    "feature double, label double, weight double")
    model = isotonic.train_isotonic_blocks(falling, blocks_per_task=5)
    assert [tuple(r) for r in model.blocks.collect()] == [(0.0, 63.0, -31.5)]
    none = isotonic.train_isotonic_blocks(falling.limit(0))
    asked = spark.createDataFrame([(1.0,)], "feature double")
    assert none.blocks.count() == 0 and none.transform(asked).first()["prediction"] is None


# --- similar vectors ---

@pytest.mark.parametrize("width,per_task", [(1, 20_000), (9, 20_000), (9, 10)])
def test_similar_vectors_are_all_pairs(spark, width, per_task):
    rng = np.random.default_rng(width)
    centres = rng.normal(size=(6, width)) * 3
    points = centres[rng.integers(0, 6, 160)] + rng.normal(size=(160, width)) * 0.4
    points[20] = points[21]
    found, candidates = pairs.similar_vectors(vectors(spark, points), "id", "features", 0.5, pivots=5,
                                              rows_per_task=per_task)
    want = {}
    for i in range(160):
        for j in range(i + 1, 160):
            weight = math.exp(-((points[i] - points[j]) ** 2).sum() / 2)
            if weight >= 0.5:
                want[i, j] = weight
    got = {(r.src, r.dst): r.weight for r in found.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    assert len(want) <= candidates.count() < 160 * 159 // 2
    assert candidates.distinct().count() == candidates.count()
    empty = vectors(spark, points).limit(0)
    assert pairs.similar_vectors(empty, "id", "features", 0.5)[0].count() == 0


def test_similar_vectors_meet_as_blocks_not_as_rows(spark):
    points = np.random.default_rng(5).normal(size=(90, 16)) * 0.2
    points[:30] = points[0]  # a crowd of copies, and points without a distance
    points[40], points[41, 3] = np.nan, np.inf
    found, _ = pairs.similar_vectors(vectors(spark, points), "id", "features", 0.6, rows_per_task=25)
    d2 = ((points[:, None] - points[None]) ** 2).sum(2)
    want = {(i, j) for i in range(90) for j in range(i + 1, 90) if d2[i, j] <= pairs.radius_squared(0.6)}
    got = [(r.src, r.dst) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 435
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in text and "zip_with(" not in text  # distances of row pairs, one after another


def test_vectors_are_sent_in_large_blocks_without_their_distances(spark):
    assert pairs.block_rows(51_282, 8) == 8192
    # 600,000 vectors were sent once for each of 74 blocks
    assert 600_000 / pairs.block_rows(600_000, 12) <= 10 and pairs.block_rows(10**8, 12) == 65_536
    points = np.random.default_rng(6).normal(size=(60, 8)) * 0.3
    for found in pairs.similar_vectors(vectors(spark, points), "id", "features", 0.6):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        sent = plan[plan.index("RepartitionByExpression"):].splitlines()[1]
        assert "block" in sent and "away" not in sent


# --- mixtures ---

def test_mixture_steps_raise_the_likelihood_and_equal_the_library_at_its_end(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1, (200, 2)), rng.normal(6, 1.5, (100, 2))])
    points = vectors(spark, x)
    trained = cluster.as_mixture(cluster.train_mixture(points, 2, 60, 1e-9))
    start = cluster.Mixture([0.5, 0.5], [[1.0, 0.0], [4.0, 4.0]], [np.eye(2).tolist()] * 2)

    def likelihood(m):
        return float(np.logaddexp.reduce(m._densities(x), axis=1).sum())
    steps = [likelihood(cluster.refine_mixture(points, start, n)) for n in range(4)]
    assert steps == sorted(steps)
    ended = cluster.refine_mixture(points, start, 60, tol=1e-9)
    order = np.argsort([m[0] for m in trained.means])
    assert np.allclose(np.array(trained.means)[order], ended.means, atol=1e-3)
    scored = trained.transform(points)
    assert scored.where("abs(aggregate(probability, 0D, (a, b) -> a + b) - 1) > 1e-9").count() == 0


def test_saved_mixture_scores_as_its_components(spark, tmp_path):
    points = vectors(spark, np.random.default_rng(2).normal(size=(80, 3)))
    model = cluster.train_mixture(points, 2, 5)
    model.save(str(tmp_path / "m"))
    loaded = load_model(14, str(tmp_path / "m"))
    ours = cluster.as_mixture(loaded).transform(points).select("id", F.col("prediction").alias("mine"))
    assert loaded.transform(points).join(ours, "id").where("prediction <> mine").count() == 0
    assert cluster.refine_mixture(points.limit(0), cluster.as_mixture(model), 3).weights == cluster.as_mixture(model).weights


# --- keys and ratings ---

def test_dense_keys_have_no_gaps(spark):
    frame = spark.createDataFrame([(f"k{i % 500}",) for i in range(2000)] + [(None,)], "key string").repartition(7)
    found = {r["key"]: r["id"] for r in dense_keys(frame, "key").collect()}
    assert sorted(found.values()) == list(range(500)) and None not in found
    assert dense_keys(frame.limit(0), "key").count() == 0


RATED = [(f"u{u}", 5_000_000_000 + i, float((1 + u % 2) * (1 + i % 3)), "x") for u in range(12) for i in range(12)]


def test_ratings_of_any_key_survive_saving(spark, tmp_path):
    frame = spark.createDataFrame(RATED, "user string, item long, rate double, _user string")
    recommend.train_ratings(frame.drop("_user"), iterations=10).save(str(tmp_path / "r"))
    asked = frame.drop("_user").unionByName(spark.createDataFrame(
        [("new", 5_000_000_000, 0.0), (None, 5_000_000_001, 0.0), ("u1", None, 0.0)], "user string, item long, rate double"))
    found = score(load_model(12, str(tmp_path / "r")), asked).collect()
    assert len(found) == len(RATED) + 3
    assert all(r["prediction"] is None for r in found if r["rate"] == 0.0)
    assert all(abs(r["prediction"] - r["rate"]) < 0.2 for r in found if r["rate"])


def test_predictions_are_those_of_the_library(spark):
    frame = spark.createDataFrame([r[:3] for r in RATED], "user string, item long, rate double")
    model = recommend.train_ratings(frame, rank=3, iterations=4)
    asked = frame.unionByName(spark.createDataFrame([("new", 5_000_000_000, 0.0)], frame.schema))
    found = model.transform(asked)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2  # was 4: ids, then factors
    numbered = with_ids(with_ids(frame, "user", model.users, "_user"), "item", model.items, "_item")
    theirs = numbered.select(F.col("_user").alias("user"), F.col("_item").alias("item"), F.col("user").alias("u"), F.col("item").alias("i"))
    want = {(r["u"], r["i"]): r["prediction"] for r in model.factors.transform(theirs).collect()}
    got = {(r["user"], r["item"]): r["prediction"] for r in found.collect()}
    assert got.pop(("new", 5_000_000_000)) is None and got == want and len(want) == len(RATED)


def test_factors_that_were_sent_are_deleted(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    frame = spark.createDataFrame([(u, i, float(u % 3 + i % 2)) for u in range(40) for i in range(30)], "user int, item int, rate double")

    def files():
        return sum("shuffle" in str(f) for f in manager.getAllFiles().mkString(" ").split(" "))
    forget(spark)
    time.sleep(1)
    before = files()
    model = recommend.train_als(frame, rank=2, iterations=9)
    for _ in range(20):
        if files() - before < 20:
            break
        time.sleep(0.5)
    assert files() - before < 20 and model.userFactors.count() == 40  # was hundreds while the model is held


def test_blocks_of_ratings_are_bounded(spark, monkeypatch):
    made = []
    real = recommend.ALS
    monkeypatch.setattr(recommend, "ALS", lambda **options: made.append(options) or real(**options))
    monkeypatch.setattr(recommend, "RATINGS_PER_BLOCK", 100)
    frame = spark.createDataFrame([(u, i, 1.0) for u in range(40) for i in range(30)], "user int, item int, rate double")
    recommend.train_als(frame, rank=2, iterations=1)
    recommend.train_als(frame.limit(90), rank=2, iterations=1)
    assert [o["numUserBlocks"] for o in made] == [12, 10] == [o["numItemBlocks"] for o in made]


def test_split_of_ratings_keeps_one_of_every_user(spark):
    frame = spark.createDataFrame([r[:3] for r in RATED] + [("single", 1, 1.0), (None, 2, 1.0)],
                                  "user string, item long, rate double")
    train, test = recommend.split_ratings(frame, 0.05)
    assert train.count() + test.count() == frame.count() and test.count() > 0
    assert train.select("user").distinct().count() == frame.select("user").distinct().count()
    again = recommend.split_ratings(frame.repartition(9), 0.05)[0]
    assert sorted(map(repr, train.collect())) == sorted(map(repr, again.collect()))
    assert recommend.split_ratings(frame, 1.0) == (frame, None)


def test_rating_job_measures_held_out_ratings(spark):
    spark.createDataFrame([r[:3] for r in RATED], "u string, i long, r double").createOrReplaceTempView("wide_ratings")
    params = {"data": "SELECT u, i, r FROM wide_ratings", "ratio": "0.8", "iterations": "5"}
    result = jobs.train_job(spark, "r-1", 12, params, information=None)
    assert result.points[0].metric == "RMSE" and 0.0 < result.points[0].value < 2.0


def test_job_skips_rows_with_null_features(spark):
    table = [(str(i), float(i % 2), float(i), None if i == 3 else 1.0) for i in range(20)]
    spark.createDataFrame(table, "k string, y double, a double, b double").createOrReplaceTempView("with_nulls")
    params = {"data": "SELECT * FROM with_nulls", "handleinvalid": "skip", "maxdepth": "2"}
    assert jobs.train_job(spark, "n-1", 4, params, information=None).points[0].model.numNodes >= 1
    with pytest.raises(Exception, match="null"):
        jobs.train_job(spark, "n-2", 4, {**params, "handleinvalid": "error"}, information=None)


# --- batches and splits by key ---

def test_keyed_batches_do_not_depend_on_the_partitioning(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    frame = rows.labelled_points(spark.createDataFrame(
        [(f"k{i}", float(a > b), float(a), float(b)) for i, (a, b) in enumerate(x)], "k string, y double, a double, b double"))
    found = [linear.train_svm(frame.repartition(n), iterations=5, tol=0.0, fraction=0.3, key="key").weights for n in (1, 6)]
    assert np.allclose(*found, atol=1e-12)
    wide = vectors(spark, rng.normal(size=(90, 200))).withColumn("label", (F.col("id") % 2).cast("double"))
    found = [linear.train_svm(wide.repartition(n), iterations=3, tol=0.0, fraction=0.5, key="id").weights for n in (1, 6)]
    assert np.allclose(*found, atol=1e-9)


def test_sparse_rows_split_alike_in_every_run(spark):
    frame = vectors(spark, np.random.default_rng(4).normal(size=(100, 4)).round(3)).withColumn(
        "label", (F.col("id") % 2).cast("double"))
    sides = [sorted(r["id"] for r in split_by_key(frame.repartition(n), 0.6, trees.sparse_key())[0].collect()) for n in (1, 7)]
    assert sides[0] == sides[1] and 40 < len(sides[0]) < 80
    text = frame.where("id = 0").select(trees.sparse_key().alias("t"), "features").first()
    want = " ".join(["0.000000", *[f"{i + 1}:{v:.6f}" for i, v in enumerate(text["features"].toArray()) if v]])
    assert text["t"] == want


# --- nodes ---

def test_nodes_of_categorical_splits(spark, tmp_path):
    rng = random.Random(6)
    table = [(str(i), float(c in (1, 3)) if rng.random() < 0.9 else 1.0, float(c), rng.random())
             for i, c in ((i, rng.randrange(5)) for i in range(300))]
    points = rows.labelled_points(spark.createDataFrame(table, "k string, y double, a double, b double"))
    for algorithm, train in ((4, trees.train_tree_classifier), (5, trees.train_forest_classifier), (9, trees.train_forest_regressor)):
        path = str(tmp_path / str(algorithm))
        train(points, categories="0:5").save(path)
        nodes = node_table(spark, path)
        assert nodes.where("categories IS NOT NULL").count() > 0
        scored = load_model(algorithm, path).transform(points).withColumnRenamed("prediction", "theirs")
        assert score_by_nodes(nodes, algorithm, scored).where("abs(theirs - prediction) > 1e-12").count() == 0


# --- terms ---

def test_count_vectors(spark):
    tokens = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (3, "c"), (4, None), (None, "a")],
                                   "id long, term string")
    found, words = terms.count_vectors(tokens, 2)
    assert {r["term"]: r["documents"] for r in words.collect()} == {"a": 3}
    assert {r["id"]: r["features"].toArray().tolist() for r in found.collect()} == {
        1: [2.0], 2: [1.0], 3: [0.0], 4: [0.0], None: [1.0]}
    online = topics.train_topics(found.where("id < 3"), k=2, iterations=2, optimizer="online")
    assert {r["term"] for r in topics.named_terms(online, words).collect()} == {"a"}
    none, empty = terms.count_vectors(tokens.limit(0))
    assert none.count() == 0 and empty.count() == 0


# --- silhouette ---

def test_silhouette_against_all_pairs(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(0, 1, (30, 3)), rng.normal(5, 1, (20, 3)), [[50.0, 50.0, 50.0]]])
    label = [0] * 30 + [1] * 20 + [7]
    frame = spark.createDataFrame([(c, [float(v) for v in r]) for c, r in zip(label, x)], "cluster int, x array<double>") \
        .select("cluster", array_to_vector("x").alias("features"))
    away = ((x[:, None] - x[None]) ** 2).sum(2)
    label = np.array(label)
    values = []
    for i, c in enumerate(label):
        same = label == c
        if same.sum() == 1:
            values.append(0.0)
            continue
        own = away[i, same].sum() / (same.sum() - 1)
        near = min(away[i, label == o].mean() for o in set(label.tolist()) - {c})
        values.append((near - own) / max(near, own))
    assert metrics.silhouette(frame).first()[0] == pytest.approx(np.mean(values), abs=1e-9)
    assert metrics.silhouette(frame.where("cluster = 0")).first()[0] == 0.0
    assert metrics.silhouette(frame.limit(0)).first()[0] is None
