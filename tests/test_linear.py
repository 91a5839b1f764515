"""The descent against the library's own SGD, and the fits against what they must find."""

import numpy as np
import pytest
from pyspark.mllib.classification import SVMWithSGD
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD

from gridloom.operators import linear, rows


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    margin = x @ np.array([1.0, -2.0, 0.5]) + 0.3
    table = [(str(i), float(m + rng.normal() * 0.1 > 0), *map(float, r)) for i, (r, m) in enumerate(zip(x, margin))]
    return rows.labelled_points(spark.createDataFrame(table, "k string, y double, a double, b double, c double")).cache()


def labelled(points):
    return points.select("label", "features").rdd.map(
        lambda r: LabeledPoint(r["label"], Vectors.dense(r["features"].toArray())))


@pytest.mark.parametrize("kind", ["l2", "l1", None])
@pytest.mark.parametrize("intercept", [True, False])
def test_svm_equals_library_sgd(points, kind, intercept):
    theirs = SVMWithSGD.train(labelled(points), iterations=6, step=1.0, regParam=0.01, regType=kind,
                              intercept=intercept, convergenceTol=0.0)
    ours = linear.train_svm(points, iterations=6, reg_type=kind or "none", intercept=intercept, tol=0.0)
    assert np.allclose(ours.weights, theirs.weights.toArray(), atol=1e-9)
    assert ours.intercept == pytest.approx(theirs.intercept, abs=1e-9)


@pytest.mark.parametrize("kind", ["l2", "l1", None])
def test_least_squares_equals_library_sgd(points, kind):
    theirs = LinearRegressionWithSGD.train(labelled(points), iterations=20, step=0.5, regParam=0.05,
                                           regType=kind, intercept=True, convergenceTol=0.0)
    ours = linear.descend(points, linear.SQUARED, [(0.5, 0.05)], 20, kind or "none", tol=0.0)[0]
    assert np.allclose(ours.weights, theirs.weights.toArray(), atol=1e-9)
    assert ours.intercept == pytest.approx(theirs.intercept, abs=1e-9)


def test_convergence_stops_at_the_same_weights(points):
    theirs = SVMWithSGD.train(labelled(points), iterations=50, step=1.0, regParam=0.01, regType="l2",
                              intercept=True, convergenceTol=0.05)
    ours = linear.train_svm(points, iterations=50, tol=0.05)
    assert ours.iterations < 50
    assert np.allclose(ours.weights, theirs.weights.toArray(), atol=1e-9)


def test_moments_and_passes_agree(points):
    one = linear.descend(points, linear.SQUARED, [(0.5, 0.05), (0.1, 0.0)], 8, "l2", tol=0.0)
    state = [linear._Point(0.5, 0.05, np.array([0, 0, 0, 1.0])), linear._Point(0.1, 0.0, np.array([0, 0, 0, 1.0]))]
    linear._descend_by_passes(points, state, linear.SQUARED, 3, 4, 8, "l2", 0.0, 1.0)
    for a, b in zip(one, state):
        assert np.allclose([*a.weights, a.intercept], b.weights, atol=1e-10)


def test_moments_by_matrix_and_by_columns_agree(points, monkeypatch):
    narrow = linear._moments(points, 3)
    monkeypatch.setattr(linear, "WRITTEN_OUT", 2)
    assert np.allclose(narrow, linear._moments(points, 3))
    assert linear._moments(points.limit(0), 3) is None


def test_wide_features_by_matrix_product(points, monkeypatch):
    narrow = linear.descend(points, linear.HINGE, [(1.0, 0.01), (0.5, 0.1)], 6, tol=0.0)
    monkeypatch.setattr(linear, "WRITTEN_OUT", 2)
    wide = linear.descend(points, linear.HINGE, [(1.0, 0.01), (0.5, 0.1)], 6, tol=0.0)
    for a, b in zip(narrow, wide):
        assert np.allclose([*a.weights, a.intercept], [*b.weights, b.intercept], atol=1e-10)


def test_wide_sums_are_added_in_a_tree(points, monkeypatch):
    monkeypatch.setattr(linear, "WRITTEN_OUT", 0)
    few = linear.descend(points.coalesce(1), linear.HINGE, [(1.0, 0.01)], 3, tol=0.0)[0]
    many = linear.descend(points.repartition(30), linear.HINGE, [(1.0, 0.01)], 3, tol=0.0)[0]
    assert many.weights == pytest.approx(few.weights, abs=1e-12)


def test_moment_limit_is_an_argument(points):
    one = linear.descend(points, linear.SQUARED, [(0.5, 0.0)], 5, tol=0.0)[0]
    two = linear.descend(points, linear.SQUARED, [(0.5, 0.0)], 5, tol=0.0, moment_limit=0)[0]
    assert two.weights == pytest.approx(one.weights, abs=1e-9)


def test_mini_batches_still_find_the_signal(points):
    model = linear.train_svm(points, fraction=0.5, iterations=30)
    hits = model.transform(points).where("label = prediction").count()
    assert hits / points.count() > 0.9


def test_empty_input_keeps_the_start(points):
    model = linear.train_svm(points.limit(0), iterations=3)
    assert model.weights == [0.0, 0.0, 0.0] and model.intercept == 1.0


def test_save_and_load(spark, points, tmp_path):
    model = linear.train_svm(points, iterations=5)
    model.save(str(tmp_path / "m"))
    again = linear.LinearModel.load(str(tmp_path / "m"))
    assert (again.loss, again.weights, again.intercept) == (model.loss, model.weights, model.intercept)


@pytest.mark.parametrize("kind", ["l2", "l1", "none"])
def test_logistic_separates(points, kind):
    model = linear.train_logistic(points, reg=0.001, reg_type=kind)
    hits = model.transform(points).where("label = prediction").count()
    assert hits / points.count() > 0.95
