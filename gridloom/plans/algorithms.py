"""The algorithms a job can name: parameters, grid, measure and trainer of each."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from gridloom.operators import cluster, linear, trees
from gridloom.operators.bayes import train_bayes
from gridloom.operators.isotonic import train_isotonic
from gridloom.operators.recommend import train_ratings

LABELLED = "labelled"    # key, label, features
ISOTONIC = "isotonic"    # key, label, feature, weight
CLUSTERED = "clustered"  # key, optional label, features
RATED = "rated"          # user, item, rate

Params = dict[str, str]


def truth(text: str) -> bool:
    return text.strip().lower() == "true"


@dataclass(frozen=True)
class Algorithm:
    """``defaults`` are text as in the parameter tables; ``shown`` are the names in messages."""

    app_name: str
    shape: str
    defaults: Params
    grid: tuple[str, ...]
    metric: str
    larger_is_better: bool
    shown: tuple[tuple[str, str], ...]
    fit_grid: "GridFit"
    reads_once: bool = False  # one pass or an own stored copy serves the whole grid

    def point_metric(self, metric: str) -> str:
        """The measure's name in the message of a grid point (fixed values); the best's message keeps the other."""
        if self.shape == CLUSTERED:
            return metric
        names = {"MSE": "mse", "RMSE": "rmse"}
        if self.app_name in ("decision_tree classifier", "random_forest classifier",
                             "gradient_boosted_tree classifier"):
            names["F_measure"] = "f_measure"
        return names.get(metric, metric)


GridFit = Callable[[DataFrame, Sequence[Params], int], list[Any]]


def _each(fit: Callable[[DataFrame, Params], Any]) -> GridFit:
    """One fit per grid point, ``parallelism`` of them at a time on the same stored rows."""
    def fit_all(rows: DataFrame, points: Sequence[Params], parallelism: int) -> list[Any]:
        if parallelism <= 1 or len(points) == 1:
            return [fit(rows, p) for p in points]
        one = inheritable_thread_target(rows.sparkSession)(lambda p: fit(rows, p))
        with ThreadPoolExecutor(min(parallelism, len(points))) as pool:
            return list(pool.map(one, points))
    return fit_all


def _descent(loss: str) -> GridFit:
    """All grid points in the same passes."""
    def fit(rows: DataFrame, points: Sequence[Params], parallelism: int) -> list[Any]:
        p = points[0]
        return linear.descend(
            rows, loss, [(float(q["step"]), float(q["regparam"])) for q in points],
            iterations=int(p["iterations"]), reg_type=p["regtype"], intercept=truth(p["intercept"]),
            tol=float(p["convergencetol"]), fraction=float(p["minibatchfraction"]), key="key")
    return fit


def _logistic(rows: DataFrame, p: Params):
    return linear.train_logistic(
        rows, int(p["numclasses"]), float(p["regparam"]), p["regtype"], int(p["iterations"]),
        truth(p["intercept"]), float(p["tolerence"]), int(p["corrections"]))


def _tree_options(p: Params) -> dict[str, Any]:
    return {"max_depth": int(p["maxdepth"]), "max_bins": int(p["maxbins"]),
            "categories": p["categoricalfeaturesinfo"]}


def _forest_options(p: Params) -> dict[str, Any]:
    return {**_tree_options(p), "num_trees": int(p["numtrees"]),
            "feature_subset": p["featuresubsetstrategy"], "impurity": p["impurity"]}


def _boost_options(p: Params) -> dict[str, Any]:
    return {**_tree_options(p), "iterations": int(p["numiterations"]),
            "learning_rate": float(p["learningrate"])}


# Fixed values below: parameter names, their defaults, grid order and message names.
_SUPERVISED = {"ratio": "1.0"}
_TREE = {**_SUPERVISED, "maxdepth": "5", "maxbins": "32", "categoricalfeaturesinfo": ""}
_FOREST = {**_TREE, "numtrees": "3", "featuresubsetstrategy": "auto"}
_BOOST = {**_TREE, "maxdepth": "3", "numiterations": "100", "learningrate": "0.1"}
_DESCENT = {**_SUPERVISED, "iterations": "100", "step": "1", "minibatchfraction": "1.0",
            "intercept": "true", "convergencetol": "0.001"}
_DESCENT_SHOWN = (
    ("iterations", "iterations"), ("step", "step"), ("regParam", "regparam"),
    ("miniBatchFraction", "minibatchfraction"), ("regType", "regtype"),
    ("intercept", "intercept"), ("convergenceTol", "convergencetol"))
_CATEGORIES = ("categoricalFeaturesInfo", "categoricalfeaturesinfo")
_DEPTH_BINS = (("maxDepth", "maxdepth"), ("maxBins", "maxbins"))
_FOREST_SHOWN = (("numTrees", "numtrees"), ("featureSubsetStrategy", "featuresubsetstrategy"),
                 ("impurity", "impurity"), *_DEPTH_BINS)
_BOOST_SHOWN = (_CATEGORIES, ("iterations", "numiterations"), ("learningRate", "learningrate"),
                *_DEPTH_BINS)

ALGORITHMS: dict[int, Algorithm] = {
    1: Algorithm(
        "SVM", LABELLED, {**_DESCENT, "regparam": "0.01", "regtype": "l2"}, ("step", "regparam"),
        "F_measure", True, _DESCENT_SHOWN, _descent(linear.HINGE), True),
    2: Algorithm(
        "logistic_regression", LABELLED,
        {**_SUPERVISED, "numclasses": "2", "iterations": "100", "regparam": "0.0", "regtype": "l2",
         "intercept": "true", "corrections": "10", "tolerence": "1e-6"}, ("regparam",),
        "F_measure", True,
        (("numClasses", "numclasses"), ("iterations", "iterations"), ("regParam", "regparam"),
         ("regType", "regtype"), ("intercept", "intercept"), ("corrections", "corrections"),
         ("convergenceTol", "tolerence")), _each(_logistic)),
    3: Algorithm(
        "NativeBayes", LABELLED, {**_SUPERVISED, "lambda": "1.0", "modeltype": "multinomial"}, (),
        "F_measure", True, (("lambda", "lambda"), ("modelType", "modeltype")),
        _each(lambda rows, p: train_bayes(rows, float(p["lambda"]), p["modeltype"])), True),
    4: Algorithm(
        "decision_tree classifier", LABELLED, {**_TREE, "numclasses": "2", "impurity": "gini"},
        ("maxdepth", "maxbins"), "F_measure", True,
        (("numClasses", "numclasses"), _CATEGORIES, ("impurity", "impurity"), *_DEPTH_BINS),
        _each(lambda rows, p: trees.train_tree_classifier(
            rows, int(p["numclasses"]), p["impurity"], **_tree_options(p)))),
    5: Algorithm(
        "random_forest classifier", LABELLED, {**_FOREST, "numclasses": "2", "impurity": "gini"},
        ("maxdepth", "numtrees"), "F_measure", True,
        (("numClasses", "numclasses"), _CATEGORIES, *_FOREST_SHOWN),
        _each(lambda rows, p: trees.train_forest_classifier(
            rows, int(p["numclasses"]), **_forest_options(p)))),
    6: Algorithm(
        "gradient_boosted_tree classifier", LABELLED, _BOOST, ("maxdepth", "learningrate"),
        "F_measure", True, _BOOST_SHOWN,
        _each(lambda rows, p: trees.train_boosted_classifier(rows, **_boost_options(p)))),
    7: Algorithm(
        "linear_regression", LABELLED, {**_DESCENT, "regparam": "0.0", "regtype": "none"},
        ("step", "regparam"), "MSE", False, _DESCENT_SHOWN, _descent(linear.SQUARED), True),
    8: Algorithm(
        "decision_tree regressor", LABELLED, {**_TREE, "impurity": "variance"},
        ("maxdepth", "maxbins"), "MSE", False,
        (_CATEGORIES, ("impurity", "impurity"), *_DEPTH_BINS),
        _each(lambda rows, p: trees.train_tree_regressor(rows, p["impurity"], **_tree_options(p)))),
    9: Algorithm(
        "random_forest regressor", LABELLED, {**_FOREST, "impurity": "variance"},
        ("maxdepth", "numtrees"), "MSE", False, (_CATEGORIES, *_FOREST_SHOWN),
        _each(lambda rows, p: trees.train_forest_regressor(rows, **_forest_options(p)))),
    10: Algorithm(
        "gradient_boosted_tree regressor", LABELLED, {**_BOOST, "loss": "squared"},
        ("maxdepth", "learningrate"), "MSE", False, _BOOST_SHOWN,
        _each(lambda rows, p: trees.train_boosted_regressor(
            rows, loss=p["loss"], **_boost_options(p)))),
    11: Algorithm(
        "IsotonicRegression", ISOTONIC, {**_SUPERVISED, "isotonic": "true"}, (), "MSE", False,
        (("isotonic", "isotonic"),),
        _each(lambda rows, p: train_isotonic(rows, truth(p["isotonic"]))), True),
    12: Algorithm(
        "AlternatingLeastSquares", RATED,
        {"ratio": "1.0", "rank": "10", "iterations": "20", "lambda": "0.01", "alpha": "0.01",
         "nonnegative": "false", "hastest": "true"}, ("rank", "lambda", "alpha"), "RMSE", False,
        (("rank", "rank"), ("iterations", "iterations"), ("lambda", "lambda"),
         ("nonnegative", "nonnegative"), ("alpha", "alpha")),
        _each(lambda rows, p: train_ratings(
            rows, rank=int(p["rank"]), iterations=int(p["iterations"]), reg=float(p["lambda"]),
            alpha=float(p["alpha"]), nonnegative=truth(p["nonnegative"])))),
    13: Algorithm(
        "K_means", CLUSTERED,
        {"k": "3", "maxiterations": "50", "runs": "10", "initializationmode": "k-means||",
         "epsilon": "1e-4", "haslabel": "false"}, ("k",), "F_measure", True,
        (("k", "k"), ("maxIterations", "maxiterations"), ("runs", "runs"),
         ("initializationMode", "initializationmode"), ("epsilon", "epsilon")),
        _each(lambda rows, p: cluster.train_kmeans(
            rows, int(p["k"]), int(p["maxiterations"]), int(p["runs"]), p["initializationmode"],
            float(p["epsilon"])))),
    14: Algorithm(
        "GaussianMixture", CLUSTERED,
        {"k": "3", "maxiterations": "50", "convergencetol": "0.001", "haslabel": "false"}, ("k",),
        "F_measure", True,
        (("k", "k"), ("maxIterations", "maxiterations"), ("convergenceTol", "convergencetol")),
        _each(lambda rows, p: cluster.train_mixture(
            rows, int(p["k"]), int(p["maxiterations"]), float(p["convergencetol"])))),
    15: Algorithm(
        "BisectingKMeans", CLUSTERED,
        {"k": "4", "maxiterations": "20", "mindivisibleclustersize": "1.0", "haslabel": "false"},
        ("k",), "F_measure", True,
        (("k", "k"), ("maxIterations", "maxiterations"),
         ("minDivisibleClusterSize", "mindivisibleclustersize")),
        _each(lambda rows, p: cluster.train_bisecting(
            rows, int(p["k"]), int(p["maxiterations"]), float(p["mindivisibleclustersize"])))),
}

FP_GROWTH = 16
FP_GROWTH_DEFAULTS = {"minsupport": "0.3", "numpartitions": "-1", "minconfidence": "0.8",
                      "output": "Items"}
