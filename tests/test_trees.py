from functools import partial

import pytest
from pyspark.sql import functions as F

from gridloom.operators import rows, trees
from gridloom.operators.metrics import accuracy, mean_squared_error
from gridloom.operators.tree_nodes import node_table


@pytest.fixture(scope="module")
def planted(spark):
    """Label 1 for categories 0 and 3 of the first feature, which no single cut separates."""
    return rows.labelled_points(spark.sql("""
        SELECT id AS k, CASE WHEN id % 4 IN (0, 3) THEN 1 ELSE 0 END AS y, id % 4 AS c, id % 7 AS noise
        FROM range(400)""")).cache()


def test_categories_are_split_as_sets(planted):
    plain = trees.train_tree_classifier(planted, max_depth=1)
    typed = trees.train_tree_classifier(planted, max_depth=1, categories="0:4")
    assert accuracy(plain.transform(planted)).first()[0] < 1.0
    assert accuracy(typed.transform(planted)).first()[0] == 1.0
    assert "in {0.0,3.0}" in typed.toDebugString or "in {1.0,2.0}" in typed.toDebugString


@pytest.mark.parametrize("train", [
    lambda p: trees.train_tree_classifier(p, impurity="entropy", categories="0:4"),
    lambda p: trees.train_forest_classifier(p, num_trees=5, feature_subset="all", categories="0:4"),
    lambda p: trees.train_boosted_classifier(p, iterations=5, categories="0:4")])
def test_classifiers_learn(planted, train):
    assert accuracy(train(planted).transform(planted)).first()[0] == 1.0


@pytest.mark.parametrize("train", [
    lambda p: trees.train_tree_regressor(p, categories="0:4"),
    lambda p: trees.train_forest_regressor(p, num_trees=5, feature_subset="all", categories="0:4"),
    lambda p: trees.train_boosted_regressor(p, iterations=5, categories="0:4", loss="absolute")])
def test_regressors_learn(planted, train):
    assert mean_squared_error(train(planted).transform(planted)).first()[0] < 0.01


@pytest.mark.parametrize("train, numeric", [
    (trees.train_tree_classifier, False), (partial(trees.train_tree_classifier, categories="0:20"), False),
    (partial(trees.train_boosted_classifier, iterations=4), False), (trees.train_tree_regressor, True),
    (partial(trees.train_boosted_regressor, iterations=4), True)])
def test_cells_give_the_trees_of_their_rows(spark, tmp_path, monkeypatch, train, numeric):
    label = "a * 0.1 + b + noise" if numeric else "CASE WHEN a * 0.1 + b + noise > 2.3 THEN 1 ELSE 0 END"
    points = rows.labelled_points(spark.sql(f"""
        SELECT id AS k, {label} AS y, a, b FROM (
            SELECT id, id % 20 AS a, (id % 13) / 7 AS b, pmod(xxhash64(id), 1000) / 1000 AS noise FROM range(9000))""")).cache()
    whole = train(points)
    seen = []
    real = trees._with_attributes
    monkeypatch.setattr(trees, "_with_attributes", lambda frame, *a: seen.append(frame.count()) or real(frame, *a))
    monkeypatch.setattr(trees, "SUMMED_FROM", 1000)
    of_cells = train(points)
    assert seen and seen[0] <= 2 * 20 * 13 < 9000 and of_cells.getOrDefault("maxBins") == 32
    both = of_cells.transform(points).select("key", F.col("prediction").alias("p")).join(whole.transform(points), "key")
    assert both.where("abs(p - prediction) > 1e-9").count() == 0 and both.count() == 9000
    for name, model in (("whole", whole), ("cells", of_cells)):
        model.save(str(tmp_path / name))
    counts = [[(r["tree"], r["node"], r["n"]) for r in node_table(spark, str(tmp_path / name)).orderBy("tree", "node").collect()]
              for name in ("whole", "cells")]
    assert counts[0] == counts[1]


def test_cells_of_features_with_more_values_than_bins(spark, monkeypatch):
    """Bins are quantiles of all rows; a tree cuts between them, in the units of the feature."""
    monkeypatch.setattr(trees, "SUMMED_FROM", 1000)
    points = rows.labelled_points(spark.sql(
        "SELECT id AS k, CASE WHEN v > 400 THEN 5 ELSE 1 END + v / 1000 AS y, v FROM (SELECT id, pmod(xxhash64(id), 1000) + id / 9000 AS v FROM range(9000))")).cache()
    cells = trees._summed(points, 32, "", False)
    assert cells.count() <= 64 and abs(cells.agg(F.sum("weight")).first()[0] - 9000) < 1e-6
    sums = cells.agg(F.sum(F.expr("weight * label")), F.sum(F.expr("weight * label * label"))).first()
    want = points.agg(F.sum("label"), F.sum(F.expr("label * label"))).first()
    assert sums[0] == pytest.approx(want[0], rel=1e-12) and sums[1] == pytest.approx(want[1], rel=1e-12)
    whole = mean_squared_error(trees.train_tree_regressor(points).transform(points)).first()[0]
    monkeypatch.setattr(trees, "SUMMED_FROM", 10**9)
    assert whole < 1.5 * mean_squared_error(trees.train_tree_regressor(points.select("*")).transform(points)).first()[0] + 0.01


@pytest.mark.parametrize("bad", ["double('NaN')", "double('Infinity')", "CAST(NULL AS DOUBLE)"])
def test_rows_that_a_learner_refuses_are_not_summed(spark, monkeypatch, bad):
    monkeypatch.setattr(trees, "SUMMED_FROM", 10)
    points = rows.labelled_points(spark.sql(f"SELECT id AS k, CASE WHEN id = 7 THEN {bad} ELSE id END AS y, id % 3 AS a FROM range(500)"))
    assert trees._summed(points, 32, "", False) is None
    with pytest.raises(Exception):
        trees.train_tree_regressor(points)


def test_three_classes(spark):
    points = rows.labelled_points(spark.sql("SELECT id AS k, id % 3 AS y, id % 3 AS x FROM range(90)"))
    model = trees.train_tree_classifier(points, num_classes=3)
    assert model.numClasses == 3
    assert accuracy(model.transform(points)).first()[0] == 1.0


def test_held_out_error(planted):
    model, error = trees.tree_with_error(planted, 0.7)
    assert model.depth >= 1 and 0.0 <= error <= 0.2
    assert trees.tree_with_error(planted, 1.0)[1] is None


def test_rows_are_dealt_to_parts_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(trees, "ROWS_PER_TASK", 30)
    points = rows.labelled_points(spark.range(100).selectExpr("id AS k", "id AS y", "id % 7 AS x0", "1 AS x1").coalesce(1))
    kept = trees._training_rows(points, "")
    assert kept.rdd.getNumPartitions() == 4
    assert sorted(map(str, kept.collect())) == sorted(map(str, points.select("label", "features").collect()))
    monkeypatch.setattr(trees, "ROWS_PER_TASK", 100)
    assert trees._training_rows(points, "").rdd.getNumPartitions() == 1
