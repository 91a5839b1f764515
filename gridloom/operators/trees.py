"""Decision trees, random forests and boosted trees for classes and numbers.

A forest of one tree sees every row once; more trees see bootstrap samples.
Boosting checkpoints its running errors every 10 steps in the shared folder, so
that a lost executor does not replay all steps before.

A tree cuts a feature into at most ``max_bins`` bins, so all it can know of the rows are sums over the cells that the
bins of all features make. Large tables of few features are added up to these cells before single trees and boosting
(``_summed``); the learner's passes then go over the cells. Forests draw rows, so they see rows.
"""

from __future__ import annotations

import math
from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.ml.classification import (
    DecisionTreeClassificationModel, DecisionTreeClassifier, GBTClassificationModel, GBTClassifier,
    RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.regression import (
    DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, GBTRegressor,
    RandomForestRegressionModel, RandomForestRegressor)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.categories import feature_width, parse_categories, with_categories, with_class_count
from gridloom.operators.metrics import test_error
from gridloom.operators.split import split_at_random, split_by_key
from gridloom.session import ensure_checkpoint_dir, stored

SEED = 42
ROWS_PER_TASK = 1_000_000  # about 100 bytes each in the learner's memory
SUMMED_FROM = 1_000_000  # tables of more rows are added up to cells
QUANTILE_ACCURACY = 1000  # a bin has its share of the rows to a thousandth of all
_CELLS: WeakKeyDictionary[DataFrame, dict] = WeakKeyDictionary()  # frames whose cells were added up, for the next learner


def _training_rows(rows: DataFrame, categories: str, num_classes: int | None = None) -> DataFrame:
    return _with_attributes(_dealt(rows).select("label", "features"), categories, num_classes)


def _with_attributes(rows: DataFrame, categories: str, num_classes: int | None) -> DataFrame:
    typed = with_categories(rows, parse_categories(categories))
    return with_class_count(typed, num_classes) if num_classes else typed


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows in parts of about ``ROWS_PER_TASK`` or less, by a hash of the whole row.

    The learners hold all rows in memory, part by part, so what a task holds and reads must not grow with the table.
    Tables of few rows, or of enough parts, are left as they are.
    """
    tasks = -(-rows.count() // ROWS_PER_TASK)
    return rows.repartition(tasks, F.xxhash64(*rows.columns)) if tasks > max(1, rows.rdd.getNumPartitions()) else rows


def _finite(value: Column) -> Column:
    return F.coalesce(~F.isnan(value) & (F.abs(value) < F.lit(math.inf)), F.lit(False))


def _bin_values(rows: DataFrame, width: int, max_bins: int, categories: dict[int, int]) -> list[list[float] | None] | None:
    """Ascending values of each feature that stand for its bins (``None`` for a category: it has its own values).

    A feature of at most ``max_bins`` values has all of them, others have quantiles of all rows. A row belongs to the
    nearest value, and the learner cuts in the middle of two values, so its cuts are the bins' own. ``None`` instead
    of the list if a label or feature is no number in some row.
    """
    x, shares = F.col("x"), [(i + 0.5) / max_bins for i in range(max_bins)]
    cut = [i for i in range(width) if i not in categories]
    finite = reduce(lambda a, b: a & b, [_finite(v) for v in (F.col("label"), *[x[i] for i in range(width)])])
    found = rows.agg(F.min(finite).alias("finite"),
                     *[F.approx_count_distinct(x[i]).alias(f"n{i}") for i in cut],
                     *[F.percentile_approx(x[i], shares, QUANTILE_ACCURACY).alias(f"q{i}") for i in cut]).first()
    if not found["finite"]:
        return None
    few = [i for i in cut if found[f"n{i}"] <= 2 * max_bins]
    sets = rows.agg(*[F.collect_set(x[i]).alias(f"v{i}") for i in few]).first() if few else {}
    values = {i: sorted(sets[f"v{i}"]) for i in few}
    return [None if i in categories else values[i] if i in values and len(values[i]) <= max_bins
            else sorted(set(found[f"q{i}"])) for i in range(width)]


def _place(value: Column, cuts: list[float], before: int = 0) -> Column:
    """How many of the ascending cuts are below the value, by halving."""
    if not cuts:
        return F.lit(before)
    half = len(cuts) // 2
    return F.when(value <= F.lit(cuts[half]), _place(value, cuts[:half], before)).otherwise(
        _place(value, cuts[half + 1:], before + half + 1))


def _summed(rows: DataFrame, max_bins: int, categories: str, of_labels: bool) -> DataFrame | None:
    """``label, features, weight``: the rows added up to cells of bins, so that a tree learner finds the same sums in them.

    ``of_labels`` has one row for a cell and label, and its count. Otherwise a cell of ``n`` numeric labels is two rows of
    weight ``n / 2`` at mean and deviation: count, sum and sum of squares are those of the cell, and stay so when a
    prediction is taken off all labels of a cell, as boosting with squared loss does. ``None`` where it does not pay:
    few rows, more possible cells than a quarter of the rows, or rows that the learner has to refuse.
    """
    n = rows.count()
    width, arity = feature_width(rows) if n > SUMMED_FROM else 0, parse_categories(categories)
    if not width or max([max_bins, *arity.values()]) > max_bins \
            or 4 * math.prod(arity.get(i, max_bins) for i in range(width)) > n:
        return None
    plain = F.unwrap_udt("features")  # a dense vector's numbers without a call for each row
    wide = rows.select("label", F.when(plain["type"] == 1, plain["values"]).otherwise(vector_to_array("features")).alias("x"))
    values = _bin_values(wide, width, max_bins, arity)
    if values is None:
        return None

    names = [f"b{i}" for i in range(width)]
    placed = wide.select("label", *[F.col("x")[i].alias(b) for i, b in enumerate(names)]).select("label", *[
        F.col(b) if of is None else _place(F.col(b), [(p + q) / 2.0 for p, q in zip(of, of[1:])]).alias(b)
        for b, of in zip(names, values)])
    if of_labels:
        cells = placed.groupBy(*names, "label").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    else:
        sums = placed.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("m"), F.stddev_pop("label").alias("s"))
        sides = F.when(F.col("s") > 0, F.array(F.col("m") - F.col("s"), F.col("m") + F.col("s"))).otherwise(F.array("m"))
        cells = sums.withColumn("sides", sides).select(
            *names, F.explode("sides").alias("label"), (F.col("n") / F.size("sides")).alias("weight"))
    x = [F.col(b) if of is None else F.element_at(F.lit(of), F.col(b) + 1) for b, of in zip(names, values)]
    return stored(cells.select("label", array_to_vector(F.array(*x)).alias("features"), "weight"), "cells")


def _fit(learner, rows: DataFrame, max_bins: int, categories: str, num_classes: int | None, of_labels: bool | None):
    """The learner on its rows, or on their cells; ``of_labels`` is None for a learner that has to see every row."""
    asked = max_bins, categories, of_labels
    cells = _CELLS.get(rows, {}).get(asked)
    if cells is None and of_labels is not None:
        cells = _summed(rows, max_bins, categories, of_labels)
    if cells is None:
        return learner.fit(_training_rows(rows, categories, num_classes))
    _CELLS.setdefault(rows, {})[asked] = cells
    # with that many bins it takes its cuts from all cells and not from a sample of them
    bins = max(max_bins, math.isqrt(cells.count()) + 1)
    model = learner.copy({learner.maxBins: bins, learner.weightCol: "weight"}).fit(
        _with_attributes(cells, categories, num_classes))
    return model.copy({model.maxBins: max_bins})


def train_tree_classifier(rows: DataFrame, num_classes: int = 2, impurity: str = "gini",
                          max_depth: int = 5, max_bins: int = 32,
                          categories: str = "") -> DecisionTreeClassificationModel:
    learner = DecisionTreeClassifier(impurity=impurity, maxDepth=max_depth, maxBins=max_bins, seed=SEED)
    return _fit(learner, rows, max_bins, categories, num_classes, True)


def train_tree_regressor(rows: DataFrame, impurity: str = "variance", max_depth: int = 5,
                         max_bins: int = 32, categories: str = "") -> DecisionTreeRegressionModel:
    learner = DecisionTreeRegressor(impurity=impurity, maxDepth=max_depth, maxBins=max_bins, seed=SEED)
    return _fit(learner, rows, max_bins, categories, None, False)


def train_forest_classifier(rows: DataFrame, num_classes: int = 2, num_trees: int = 3,
                            feature_subset: str = "auto", impurity: str = "gini", max_depth: int = 5,
                            max_bins: int = 32, categories: str = "") -> RandomForestClassificationModel:
    learner = RandomForestClassifier(
        numTrees=num_trees, featureSubsetStrategy=feature_subset, impurity=impurity,
        maxDepth=max_depth, maxBins=max_bins, bootstrap=num_trees > 1, seed=SEED)
    return learner.fit(_training_rows(rows, categories, num_classes))


def train_forest_regressor(rows: DataFrame, num_trees: int = 3, feature_subset: str = "auto",
                           impurity: str = "variance", max_depth: int = 5, max_bins: int = 32,
                           categories: str = "") -> RandomForestRegressionModel:
    learner = RandomForestRegressor(
        numTrees=num_trees, featureSubsetStrategy=feature_subset, impurity=impurity,
        maxDepth=max_depth, maxBins=max_bins, bootstrap=num_trees > 1, seed=SEED)
    return learner.fit(_training_rows(rows, categories))


def train_boosted_classifier(rows: DataFrame, iterations: int = 100, learning_rate: float = 0.1,
                             max_depth: int = 3, max_bins: int = 32,
                             categories: str = "") -> GBTClassificationModel:
    ensure_checkpoint_dir(rows.sparkSession)
    learner = GBTClassifier(maxIter=iterations, stepSize=learning_rate, maxDepth=max_depth,
                            maxBins=max_bins, checkpointInterval=10, seed=SEED)
    return _fit(learner, rows, max_bins, categories, 2, True)


def train_boosted_regressor(rows: DataFrame, iterations: int = 100, learning_rate: float = 0.1,
                            max_depth: int = 3, max_bins: int = 32, categories: str = "",
                            loss: str = "squared") -> GBTRegressionModel:
    ensure_checkpoint_dir(rows.sparkSession)
    learner = GBTRegressor(maxIter=iterations, stepSize=learning_rate, maxDepth=max_depth,
                           maxBins=max_bins, lossType=loss, checkpointInterval=10, seed=SEED)
    return _fit(learner, rows, max_bins, categories, None, False if loss == "squared" else None)


def sparse_key(label: str = "label", features: str = "features") -> Column:
    """A key for rows that have none: the row as LibSVM text, label and values with six decimals."""
    entries = F.transform(vector_to_array(features), lambda v, i: F.when(
        v != 0, F.format_string("%d:%.6f", i + 1, v)))
    return F.concat_ws(" ", F.format_string("%.6f", F.col(label)), F.filter(entries, lambda e: e.isNotNull()))


def tree_with_error(rows: DataFrame, ratio: float = 1.0, num_classes: int = 2, impurity: str = "gini",
                    max_depth: int = 5, max_bins: int = 32, seed: int = SEED, by_key: bool = False,
                    ) -> tuple[DecisionTreeClassificationModel, float | None]:
    """A tree on LibSVM rows and its error on the held-out part (none at ratio 1).

    ``by_key`` splits by :func:`sparse_key`, which gives the same parts in every run; equal rows stay together.
    """
    train, test = split_by_key(rows, ratio, sparse_key()) if by_key else split_at_random(rows, ratio, seed)
    model = train_tree_classifier(train, num_classes, impurity, max_depth, max_bins)
    error = None if test is None else test_error(model.transform(test)).first()[0]
    return model, error
