"""Trainers. Where a model has a closed form, the SQL states it; else a property it must have."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gridloom.operators import bayes, cluster, isotonic, linear, metrics, recommend, reduce, rows, topics
from gridloom.operators import trees
from gridloom.operators.pairs import radius_squared, similar_classes
from gridloom.operators.scoring import score
from gridloom.queries.base import (
    LINE_POINTS, ORDER_FLAGS, PART_CENTRES, PART_POINTS, RATINGS, SIGNAL_POINTS, TARGET_POINTS,
    USER_COUNTS, kept, nearest_sql, query, rounded, scratch, spread, sql, training)
from gridloom.queries.relational import MIN_SIMILARITY, PLANE
from gridloom.sources import files

# --- gradient descent (M1, M7) ---------------------------------------------------------


def descent_ctes(source: str, loss: str, step: float, reg: float, reg_type: str, iterations: int,
                 tag: str = "") -> tuple[list[str], str]:
    """The descent as one pair of CTEs per iteration, and the name of the final weights."""
    names = ["x0", "x1", "x2"]
    margin = " + ".join(f"{n} * w{i}" for i, n in enumerate(names)) + " + b"
    if loss == linear.HINGE:
        slope = f"CASE WHEN (2 * y - 1) * ({margin}) < 1 THEN -(2 * y - 1) ELSE 0 END"
    else:
        slope = f"({margin}) - y"
    weights = ["w0", "w1", "w2", "b"]
    ctes = [f"p{tag} AS MATERIALIZED ({source})",
            f"w{tag}_0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, "
            f"0.0::DOUBLE AS w2, 1.0::DOUBLE AS b)"]
    for i in range(1, iterations + 1):
        before = f"w{tag}_{i - 1}"
        ctes.append(
            f"g{tag}_{i} AS MATERIALIZED (SELECT avg(c * x0) AS gw0, avg(c * x1) AS gw1, "
            f"avg(c * x2) AS gw2, avg(c) AS gb FROM (SELECT x0, x1, x2, "
            f"CAST({slope} AS DOUBLE) AS c FROM p{tag}, {before}) AS s)")
        at = f"({step} / sqrt({i}))"
        if reg_type == "l2":
            after = [f"{w} * (1 - {at} * {reg}) - {at} * g{w} AS {w}" for w in weights]
        elif reg_type == "l1":
            after = [f"sign({w} - {at} * g{w}) * greatest(abs({w} - {at} * g{w}) - {at} * {reg}, 0) AS {w}"
                     for w in weights]
        else:
            after = [f"{w} - {at} * g{w} AS {w}" for w in weights]
        ctes.append(f"w{tag}_{i} AS MATERIALIZED (SELECT {', '.join(after)} FROM {before}, g{tag}_{i})")
    return ctes, f"w{tag}_{iterations}"


def descent_sql(source: str, loss: str, step: float, reg: float, iterations: int) -> str:
    """Final weights for the three kinds of regularisation."""
    ctes, parts = [], []
    for kind in ("l2", "l1", "none"):
        found, last = descent_ctes(source, loss, step, reg, kind, iterations, f"_{kind}")
        ctes += found
        parts.append(f"SELECT '{kind}' AS reg_type, round(w0, 6) AS w0, round(w1, 6) AS w1, "
                     f"round(w2, 6) AS w2, round(b, 6) AS b FROM {last}")
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(parts)


def _descent_weights(spark, source, loss: str, step: float, reg: float, iterations: int):
    points = rows.labelled_points(source)
    found = []
    for kind in ("l2", "l1", "none"):
        model = linear.descend(points, loss, [(step, reg)], iterations, kind, tol=0.0)[0]
        found.append((kind, *[round(w, 6) + 0.0 for w in [*model.weights, model.intercept]]))
    return spark.createDataFrame(
        found, "reg_type string, w0 double, w1 double, w2 double, b double")


@query("m1_svm", descent_sql(SIGNAL_POINTS, linear.HINGE, 1.0, 0.01, 4))
def m1_svm(spark):
    return _descent_weights(spark, training(spark, SIGNAL_POINTS), linear.HINGE, 1.0, 0.01, 4)


@query("m7_linear_regression", descent_sql(TARGET_POINTS, linear.SQUARED, 0.5, 0.05, 4))
def m7_linear_regression(spark):
    return _descent_weights(spark, sql(spark, TARGET_POINTS), linear.SQUARED, 0.5, 0.05, 4)


def _linear_scores(text: str, loss: str, step: float, reg: float, kind: str, prediction: str) -> str:
    ctes, last = descent_ctes(text, loss, step, reg, kind, 3)
    return ("WITH " + ", ".join(ctes) + f" SELECT CAST(k AS STRING) AS key, {prediction} AS prediction "
            f"FROM p, {last}")


MARGIN_SQL = "x0 * w0 + x1 * w1 + x2 * w2 + b"


@query("b1_svm_scoring", _linear_scores(
    SIGNAL_POINTS, linear.HINGE, 1.0, 0.01, "l2",
    f"CAST(CASE WHEN {MARGIN_SQL} >= 0 THEN 1 ELSE 0 END AS DOUBLE)"))
def b1_svm_scoring(spark):
    """Labels 0/1 from the sign of the margin."""
    model = linear.train_svm(rows.labelled_points(sql(spark, SIGNAL_POINTS)), iterations=3, tol=0.0)
    return score(model, rows.scoring_points(sql(spark, SIGNAL_POINTS).drop("y")))


@query("b1_linear_scoring", _linear_scores(
    TARGET_POINTS, linear.SQUARED, 0.5, 0.0, "none", f"round({MARGIN_SQL}, 6)"))
def b1_linear_scoring(spark):
    model = linear.train_least_squares(rows.labelled_points(sql(spark, TARGET_POINTS)), step=0.5,
                                       iterations=3, tol=0.0)
    return score(model, rows.scoring_points(sql(spark, TARGET_POINTS).drop("y"))).select(
        "key", *rounded("prediction"))


# --- logistic regression: at the optimum, expected and observed moments agree -----------

@query("m2_logistic_regression", f"""
SELECT round(avg(y), 4) AS m, round(avg(y * x0), 4) AS m0, round(avg(y * x1), 4) AS m1,
       round(avg(y * x2), 4) AS m2 FROM ({LINE_POINTS}) AS p""")
def m2_logistic_regression(spark):
    """Moments of the predicted probabilities of an unregularised fit."""
    points = rows.labelled_points(sql(spark, LINE_POINTS))
    model = linear.train_logistic(points, tol=1e-10)
    x = vector_to_array("features")
    scored = model.transform(points).select(
        vector_to_array("probability")[1].alias("p"), *[x[i].alias(f"x{i}") for i in range(3)])
    return scored.agg(F.round(F.avg("p"), 4).alias("m"), *[
        F.round(F.avg(F.col("p") * F.col(f"x{i}")), 4).alias(f"m{i}") for i in range(3)])


# --- naive Bayes -----------------------------------------------------------------------

def bayes_sql(source: str, train: str = "TRUE", test: str = "TRUE") -> str:
    """``k, y, prediction`` of multinomial naive Bayes, smoothing 1, on three features."""
    return f"""
SELECT t.k, t.y, CAST(CASE WHEN
       b.pi + b.t0 * t.x0 + b.t1 * t.x1 + b.t2 * t.x2 > a.pi + a.t0 * t.x0 + a.t1 * t.x1 + a.t2 * t.x2
       THEN 1 ELSE 0 END AS DOUBLE) AS prediction
FROM (SELECT * FROM ({source}) AS p WHERE {test}) AS t,
     (SELECT * FROM ({bayes_model_sql(source, train)}) AS m WHERE y = 0) AS a,
     (SELECT * FROM ({bayes_model_sql(source, train)}) AS m WHERE y = 1) AS b"""


def bayes_model_sql(source: str, train: str = "TRUE") -> str:
    return f"""
SELECT y, ln(n + 1) - ln(sum(n) OVER () + 2) AS pi, ln(s0 + 1) - ln(s0 + s1 + s2 + 3) AS t0,
       ln(s1 + 1) - ln(s0 + s1 + s2 + 3) AS t1, ln(s2 + 1) - ln(s0 + s1 + s2 + 3) AS t2
FROM (SELECT y, count(*) AS n, sum(x0) AS s0, sum(x1) AS s1, sum(x2) AS s2
      FROM ({source}) AS p WHERE {train} GROUP BY y) AS c"""


@query("m3_naive_bayes", f"""
SELECT CAST(y AS DOUBLE) AS label, round(pi, 6) AS pi, round(t0, 6) AS t0, round(t1, 6) AS t1,
       round(t2, 6) AS t2 FROM ({bayes_model_sql(SIGNAL_POINTS)}) AS m""")
def m3_naive_bayes(spark):
    """The model: log prior and log feature shares per class."""
    model = bayes.train_bayes(rows.labelled_points(sql(spark, SIGNAL_POINTS)))
    theta, prior = model.theta.toArray(), model.pi.toArray()
    found = [(float(c), float(prior[c]), *map(float, theta[c])) for c in range(len(prior))]
    return spark.createDataFrame(
        found, "label double, pi double, t0 double, t1 double, t2 double").select(
        "label", *rounded("pi", "t0", "t1", "t2"))


@query("b1_bayes_scoring", f"SELECT CAST(k AS STRING) AS key, prediction "
       f"FROM ({bayes_sql(SIGNAL_POINTS)}) AS s")
def b1_bayes_scoring(spark):
    model = bayes.train_bayes(rows.labelled_points(sql(spark, SIGNAL_POINTS)))
    return score(model, rows.scoring_points(sql(spark, SIGNAL_POINTS).drop("y")))


FLAG_POINTS = f"""
SELECT k, CAST(c1 AS INT) AS y, CAST(c4 AS INT) AS x0, CAST(c5 AS INT) AS x1, CAST(c8 AS INT) AS x2
FROM ({ORDER_FLAGS}) AS f"""


@query("m3_naive_bayes_bernoulli", f"""
SELECT CAST(y AS DOUBLE) AS label, round(ln(n + 1) - ln(sum(n) OVER () + 2), 6) AS pi,
       round(ln(s0 + 1) - ln(n + 2), 6) AS t0, round(ln(s1 + 1) - ln(n + 2), 6) AS t1,
       round(ln(s2 + 1) - ln(n + 2), 6) AS t2
FROM (SELECT y, count(*) AS n, sum(x0) AS s0, sum(x1) AS s1, sum(x2) AS s2
      FROM ({FLAG_POINTS}) AS p GROUP BY y) AS c""")
def m3_naive_bayes_bernoulli(spark):
    model = bayes.train_bayes(rows.labelled_points(sql(spark, FLAG_POINTS)), model_type="bernoulli")
    theta, prior = model.theta.toArray(), model.pi.toArray()
    found = [(float(c), float(prior[c]), *map(float, theta[c])) for c in range(len(prior))]
    return spark.createDataFrame(
        found, "label double, pi double, t0 double, t1 double, t2 double").select(
        "label", *rounded("pi", "t0", "t1", "t2"))


# --- trees: one split is an arg-max over cumulative counts ------------------------------

def stump_sql(source: str, kind: str, scored: str = "SELECT * FROM p") -> str:
    """``k, y, prediction`` of the best single split (``gini`` for classes, ``variance``) for the ``scored`` rows."""
    if kind == "gini":
        def impurity(n, s, q):
            return f"(1 - power({s} / {n}, 2) - power(({n} - {s}) / {n}, 2))"
    else:
        def impurity(n, s, q):
            return f"({q} / {n} - power({s} / {n}, 2))"

    def leaf(n, s):
        return f"CASE WHEN 2 * {s} > {n} THEN 1.0 ELSE 0.0 END" if kind == "gini" else f"{s} / {n}"

    values = " UNION ALL ".join(f"SELECT {i} AS f, x{i} AS v, CAST(y AS DOUBLE) AS y FROM p" for i in range(3))
    return f"""
WITH p AS MATERIALIZED ({source}),
v AS (SELECT f, v, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s, sum(y * y) AS q
      FROM ({values}) AS u GROUP BY f, v),
c AS (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS after,
             sum(n) OVER w AS n1, sum(s) OVER w AS s1, sum(q) OVER w AS q1,
             sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s,
             sum(q) OVER (PARTITION BY f) AS q
      FROM v WINDOW w AS (PARTITION BY f ORDER BY v)),
best AS MATERIALIZED (
      SELECT f, (v + after) / 2 AS cut, {leaf('n1', 's1')} AS low, {leaf('(n - n1)', '(s - s1)')} AS high
      FROM c WHERE after IS NOT NULL
      ORDER BY {impurity('n', 's', 'q')} - n1 / n * {impurity('n1', 's1', 'q1')}
             - (n - n1) / n * {impurity('(n - n1)', '(s - s1)', '(q - q1)')} DESC, f, v LIMIT 1)
SELECT k, y, CAST(CASE WHEN CASE f WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END <= cut
                  THEN low ELSE high END AS DOUBLE) AS prediction
FROM ({scored}) AS t, best"""


CLASS_STUMP = (f"SELECT CAST(y AS DOUBLE) AS label, prediction, count(*) AS n "
               f"FROM ({stump_sql(SIGNAL_POINTS, 'gini')}) AS s GROUP BY 1, 2")
NUMBER_STUMP = (f"SELECT round(prediction, 6) AS prediction, count(*) AS n, round(avg(y), 6) AS label "
                f"FROM ({stump_sql(TARGET_POINTS, 'variance')}) AS s GROUP BY 1")
STUMP = {"max_depth": 1, "max_bins": 64}


def _class_counts(spark, train):
    points = rows.labelled_points(sql(spark, SIGNAL_POINTS))
    scored = score(train(points), points)
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def _number_counts(spark, train):
    points = rows.labelled_points(sql(spark, TARGET_POINTS))
    scored = score(train(points), points).withColumn("prediction", F.round("prediction", 6))
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"),
                                            F.round(F.avg("label"), 6).alias("label"))


@query("m4_tree_classifier", CLASS_STUMP)
def m4_tree_classifier(spark):
    return _class_counts(spark, lambda p: trees.train_tree_classifier(p, **STUMP))


@query("m5_forest_classifier", CLASS_STUMP)
def m5_forest_classifier(spark):
    """A forest of one tree sees all rows and features, so it is the tree."""
    return _class_counts(spark, lambda p: trees.train_forest_classifier(p, num_trees=1, **STUMP))


@query("m6_boosted_classifier", CLASS_STUMP)
def m6_boosted_classifier(spark):
    """The first boosting step splits where the tree does."""
    return _class_counts(spark, lambda p: trees.train_boosted_classifier(p, iterations=1, **STUMP))


@query("m8_tree_regressor", NUMBER_STUMP)
def m8_tree_regressor(spark):
    return _number_counts(spark, lambda p: trees.train_tree_regressor(p, **STUMP))


@query("m9_forest_regressor", NUMBER_STUMP)
def m9_forest_regressor(spark):
    return _number_counts(spark, lambda p: trees.train_forest_regressor(p, num_trees=1, **STUMP))


@query("m10_boosted_regressor", NUMBER_STUMP)
def m10_boosted_regressor(spark):
    return _number_counts(spark, lambda p: trees.train_boosted_regressor(p, iterations=1, **STUMP))


@query("m5_forest_default")
def m5_forest_default(spark):
    """Default parameters: three bootstrapped trees of depth 5."""
    return _class_counts(spark, trees.train_forest_classifier)


@query("m10_boosted_default")
def m10_boosted_default(spark):
    """Ten boosting steps of depth 3."""
    model = trees.train_boosted_regressor(
        rows.labelled_points(training(spark, TARGET_POINTS)), iterations=10)
    return metrics.mean_squared_error(score(model, rows.labelled_points(sql(spark, TARGET_POINTS))))


@query("m25_tree_on_libsvm", f"""
SELECT round(avg(CASE WHEN y <> prediction THEN 1.0 ELSE 0.0 END), 9) AS test_error
FROM ({stump_sql(SIGNAL_POINTS, 'gini')}) AS s""")
def m25_tree_on_libsvm(spark):
    """A tree of depth 1 on LibSVM files and its error on the same rows."""
    folder = scratch(spark, "libsvm")
    rows.label_first_points(sql(spark, SIGNAL_POINTS).drop("k")).write.format("libsvm").save(folder)
    points = files.read_libsvm(spark, folder, 3)
    model, _ = trees.tree_with_error(points, 1.0, max_depth=1, max_bins=64)
    return metrics.test_error(model.transform(points)).select(*rounded("test_error", digits=9))


# --- isotonic regression ---------------------------------------------------------------

ISOTONIC_POINTS = "SELECT l_orderkey AS k, l_extendedprice / 1000 AS y, l_quantity AS x0 FROM lineitem"

ISOTONIC_SQL = f"""
WITH g AS (SELECT x0 AS x, sum(y) AS s, count(*) AS w FROM ({ISOTONIC_POINTS}) AS p GROUP BY x0),
c AS MATERIALIZED (SELECT x, s, w, sum(s) OVER o AS cs, sum(w) OVER o AS cw, row_number() OVER o AS r
      FROM g WINDOW o AS (ORDER BY x)),
m AS MATERIALIZED (SELECT i.r AS i, j.r AS j, (j.cs - i.cs + i.s) / (j.cw - i.cw + i.w) AS mean
      FROM c AS i JOIN c AS j ON i.r <= j.r),
lowest AS (SELECT m.i, c.r AS k, min(m.mean) AS mean FROM c JOIN m ON m.j >= c.r AND m.i <= c.r GROUP BY 1, 2)
SELECT c.x, max(lowest.mean) AS fitted FROM c JOIN lowest ON lowest.k = c.r GROUP BY c.x"""


@query("m11_isotonic_regression",
       f"SELECT x AS feature, round(fitted, 6) AS prediction FROM ({ISOTONIC_SQL}) AS f")
def m11_isotonic_regression(spark):
    """The fit at every trained feature value."""
    points = rows.first_feature_points(sql(spark, ISOTONIC_POINTS))
    model = isotonic.train_isotonic(points)
    return model.transform(isotonic.pool_equal_features(points)).select("feature", *rounded("prediction"))


@query("b2_isotonic_scoring", f"""
SELECT CAST(p.k AS STRING) AS key, round(f.fitted, 6) AS prediction
FROM ({ISOTONIC_POINTS}) AS p JOIN ({ISOTONIC_SQL}) AS f ON p.x0 = f.x""")
def b2_isotonic_scoring(spark):
    """Whole rows scored by their first feature."""
    model = isotonic.train_isotonic(rows.first_feature_points(sql(spark, ISOTONIC_POINTS)))
    points = rows.scoring_points(sql(spark, ISOTONIC_POINTS).drop("y"))
    return score(model, points).select("key", *rounded("prediction"))


# --- recommendation --------------------------------------------------------------------

@query("m12_als", uses="orders lineitem")
def m12_als(spark):
    """Ratings with their predictions."""
    rated = kept(rows.ratings(sql(spark, RATINGS)), "rated")
    return recommend.score_ratings(recommend.train_als(rated, rank=4, iterations=5, reg=0.1), rated)


@query("b4_als_scoring", f"""
SELECT count(*) AS n, count(DISTINCT u) AS users, count(DISTINCT i) AS items
FROM ({RATINGS}) AS p""", uses="orders lineitem")
def b4_als_scoring(spark):
    """Every trained (user, item) gets a score: none is dropped."""
    rated = kept(rows.ratings(sql(spark, RATINGS)), "rated")
    model = recommend.train_als(rated, rank=2, iterations=2, reg=0.1)
    scored = score(model, rows.user_items(rated)).where(F.col("prediction").isNotNull())
    return scored.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user").alias("users"),
                      F.countDistinct("item").alias("items"))


SEEN_RATINGS = RATINGS.replace("GROUP BY", "WHERE o_orderstatus = 'F' GROUP BY")


@query("b4_cold_start", f"""
SELECT CAST(u AS INT) AS "user", CAST(i AS INT) AS item,
       u IN (SELECT u FROM ({SEEN_RATINGS}) AS s) AND i IN (SELECT i FROM ({SEEN_RATINGS}) AS t) AS scored
FROM ({RATINGS}) AS p""", uses="orders lineitem")
def b4_cold_start(spark):
    """A model of the finished orders scores all pairs: a row for each, null where user or item is new."""
    model = recommend.train_als(kept(rows.ratings(sql(spark, SEEN_RATINGS)), "rated"), rank=4, iterations=3, reg=0.1)
    found = score(model, rows.user_items(rows.ratings(sql(spark, RATINGS))))
    return found.select("user", "item", F.col("prediction").isNotNull().alias("scored"))


# --- clustering ------------------------------------------------------------------------

def refine_ctes(source: str, centres: list[list[float]], iterations: int) -> tuple[list[str], str]:
    values = ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE)" for i, (a, b) in enumerate(centres))
    ctes = [f"p AS MATERIALIZED ({source})", f"c0(cluster, c0, c1) AS MATERIALIZED (VALUES {values})"]
    for i in range(1, iterations + 1):
        ctes.append(
            f"a{i} AS MATERIALIZED (SELECT k, x0, x1, first(cluster ORDER BY d, cluster) AS cluster "
            f"FROM (SELECT k, x0, x1, cluster, (x0 - c0) * (x0 - c0) + (x1 - c1) * (x1 - c1) AS d "
            f"FROM p, c{i - 1}) AS q GROUP BY k, x0, x1)")
        ctes.append(f"c{i} AS MATERIALIZED (SELECT c.cluster, coalesce(avg(a.x0), any_value(c.c0)) AS c0, "
                    f"coalesce(avg(a.x1), any_value(c.c1)) AS c1 "
                    f"FROM c{i - 1} AS c LEFT JOIN a{i} AS a ON a.cluster = c.cluster GROUP BY c.cluster)")
    return ctes, f"c{iterations}"


REFINE_CTES, REFINED = refine_ctes(PART_POINTS, PART_CENTRES, 3)


@query("m13_kmeans_from_centres", "WITH " + ", ".join(REFINE_CTES) +
       f" SELECT cluster, round(c0, 6) AS c0, round(c1, 6) AS c1 FROM {REFINED}", uses="part")
def m13_kmeans_from_centres(spark):
    """Three steps of k-means from given centres."""
    points = rows.labelled_points(training(spark, PART_POINTS, "part"))
    centres = cluster.refine_centres(points, PART_CENTRES, 3, epsilon=0.0).values
    found = [(i, round(a, 6), round(b, 6)) for i, (a, b) in enumerate(centres)]
    return spark.createDataFrame(found, "cluster int, c0 double, c1 double")


def _sizes(spark, train):
    points = rows.cluster_points(training(spark, PART_POINTS, "part"), True).persist()
    try:
        model = train(points)
    finally:
        points.unpersist()
    return metrics.cluster_sizes(score(model, points), "prediction")


@query("m13_kmeans", uses="part")
def m13_kmeans(spark):
    """Best of three runs of k-means||."""
    return _sizes(spark, lambda p: cluster.train_kmeans(p, k=4, iterations=20, runs=3))


@query("m14_gaussian_mixture", f"SELECT round(avg(x0), 6) AS m0, round(avg(x1), 6) AS m1 "
       f"FROM ({PART_POINTS}) AS p", uses="part")
def m14_gaussian_mixture(spark):
    """After every EM step the mixture has the mean of the data."""
    points = rows.cluster_points(training(spark, PART_POINTS, "part"), True)
    model = cluster.train_mixture(points, k=3, iterations=10)
    means = [sum(w * g.mean[i] for w, g in zip(model.weights, model.gaussians)) for i in range(2)]
    return spark.createDataFrame([tuple(round(float(m), 6) for m in means)], "m0 double, m1 double")


@query("b3_mixture_scoring", uses="part")
def b3_mixture_scoring(spark):
    """The most likely component of every part."""
    return _sizes(spark, lambda p: cluster.train_mixture(p, k=3, iterations=10))


@query("b3_kmeans_scoring", f"SELECT CAST(k AS STRING) AS key, cluster AS prediction "
       f"FROM ({nearest_sql(PART_POINTS, PART_CENTRES)}) AS a", uses="part")
def b3_kmeans_scoring(spark):
    """The nearest centre of every part."""
    points = rows.scoring_points(sql(spark, PART_POINTS).drop("y"))
    return score(cluster.Centres(PART_CENTRES), points)


@query("m15_bisecting_kmeans", uses="part")
def m15_bisecting_kmeans(spark):
    return _sizes(spark, lambda p: cluster.train_bisecting(p, k=4))


@query("m26_kmeans_with_pca", "SELECT count(*) AS n, round(" + " + ".join(
    f"var_samp(CAST(embedding[{i + 1}] AS DOUBLE))" for i in range(64)) +
    ", 6) AS variance, TRUE AS cheaper, TRUE AS accurate FROM embeddings", uses="embeddings")
def m26_kmeans_with_pca(spark):
    """Embeddings on two components, ten clusters: the cost is below what the two components vary in all."""
    points = rows.label_first_points(training(spark, "SELECT label, " + ", ".join(
        f"embedding[{i}] AS x{i}" for i in range(64)) + " FROM embeddings", "embeddings"))
    found = cluster.cluster_with_reduction(points, k=10, iterations=20, runs=2, reduce=True)
    n, parts = found.relabelled.count(), found.components
    spread_out = parts.variance * sum(parts.explained) * (n - 1)
    return spark.createDataFrame(
        [(n, round(parts.variance, 6), found.cost < spread_out / 2, 0.0 < found.accuracy <= 1.0)],
        "n bigint, variance double, cheaper boolean, accurate boolean")


EDGES_SQL = f"""
SELECT s.id AS src, t.id AS dst FROM ({PLANE}) AS s JOIN ({PLANE}) AS t ON s.id < t.id
WHERE (s.a - t.a) * (s.a - t.a) + (s.b - t.b) * (s.b - t.b) <= {radius_squared(MIN_SIMILARITY)!r}::DOUBLE"""


@query("m21_power_iteration", f"""
SELECT count(DISTINCT id) AS nodes FROM (
    SELECT src AS id FROM ({EDGES_SQL}) AS e UNION ALL SELECT dst AS id FROM ({EDGES_SQL}) AS f) AS n
""", uses="part")
def m21_power_iteration(spark):
    """Similar parts as a graph; every node of an edge gets one of three clusters."""
    edges, members = similar_classes(sql(spark, PLANE), "id", ["a", "b"], MIN_SIMILARITY)
    assigned = cluster.power_iteration(edges, k=3, iterations=10, members=members)
    return assigned.where(F.col("cluster").between(0, 2)).agg(F.countDistinct("id").alias("nodes"))


# --- topics ----------------------------------------------------------------------------

@query("k7_topic_terms", "SELECT CAST(term AS INT) AS term, CAST(sum(n) AS DOUBLE) AS weight FROM (" +
       " UNION ALL ".join(f"SELECT {i} AS term, x{i} AS n FROM ({USER_COUNTS}) AS p{i}" for i in range(5)) +
       ") AS t GROUP BY term", uses="events")
def k7_topic_terms(spark):
    """EM shares every counted term out to the topics: the shares add up to its count."""
    documents = rows.document_vectors(sql(spark, USER_COUNTS), has_key=True)
    table = topics.topic_terms(topics.train_topics(documents, k=3, iterations=5))
    return table.groupBy("term").agg(F.round(F.sum("weight"), 3).alias("weight"))


@query("m20_topics", uses="events")
def m20_topics(spark):
    """``topic, term, weight`` of three topics over event types."""
    documents = rows.document_vectors(sql(spark, USER_COUNTS), has_key=True)
    return topics.topic_terms(topics.train_topics(documents, k=3, iterations=10))


# --- reduction: two features have closed-form components --------------------------------

PLANE_POINTS = """
SELECT l_orderkey AS k, l_linenumber AS y, l_quantity / 25 AS x0, l_discount * 10 AS x1 FROM lineitem"""


def components_sql(a: str, b: str, c: str) -> str:
    """Larger and smaller eigenvalue and the first unit vector of [[a, b], [b, c]], a > c."""
    return f"""
SELECT e1, e2, (e1 - c) / sqrt(power(e1 - c, 2) + b * b) AS v0, b / sqrt(power(e1 - c, 2) + b * b) AS v1
FROM (SELECT b, c, (a + c) / 2 + sqrt(power((a - c) / 2, 2) + b * b) AS e1,
             (a + c) / 2 - sqrt(power((a - c) / 2, 2) + b * b) AS e2
      FROM (SELECT {a} AS a, {b} AS b, {c} AS c FROM ({PLANE_POINTS}) AS p) AS m) AS e"""


COVARIANCE = components_sql("var_samp(x0)", "covar_samp(x0, x1)", "var_samp(x1)")
GRAM = components_sql("sum(x0 * x0)", "sum(x0 * x1)", "sum(x1 * x1)")


@query("m22_pca", f"""
SELECT CAST(k AS STRING) AS key, round(abs(x0 * v0 + x1 * v1), 6) AS z0,
       round(abs(x1 * v0 - x0 * v1), 6) AS z1
FROM ({PLANE_POINTS}) AS p, ({COVARIANCE}) AS e""")
def m22_pca(spark):
    """Rows times components, not centred; the sign is free, so absolute values."""
    points = rows.scoring_points(sql(spark, PLANE_POINTS).drop("y"))
    z = vector_to_array("projected")
    return reduce.project(points, 2).select("key", *[F.round(F.abs(z[i]), 6).alias(f"z{i}") for i in (0, 1)])


@query("m22_pca_variance", f"SELECT round(e1 / (e1 + e2), 6) AS first, round(e2 / (e1 + e2), 6) AS second "
       f"FROM ({COVARIANCE}) AS e")
def m22_pca_variance(spark):
    """Shares of the variance that the components explain."""
    model = reduce.fit_components(rows.scoring_points(sql(spark, PLANE_POINTS).drop("y")), 2)
    shares = [round(v, 6) for v in model.explained]
    return spark.createDataFrame([tuple(shares)], "first double, second double")


@query("m23_pca_with_label", f"""
SELECT CAST(k AS STRING) AS key, CAST(y AS DOUBLE) AS label, round(abs(x0 * v0 + x1 * v1), 6) AS z0
FROM ({PLANE_POINTS}) AS p, ({COVARIANCE}) AS e""")
def m23_pca_with_label(spark):
    """The features replaced by their first component, key and label kept."""
    reduced = reduce.project_features(rows.labelled_points(sql(spark, PLANE_POINTS)), 1)
    return reduced.select("key", "label", F.round(F.abs(vector_to_array("features")[0]), 6).alias("z0"))


@query("m24_svd_values", f"SELECT round(sqrt(e1), 6) AS s0, round(sqrt(e2), 6) AS s1 FROM ({GRAM}) AS e")
def m24_svd_values(spark):
    found = reduce.singular_values(rows.scoring_points(sql(spark, PLANE_POINTS).drop("y")), 2)
    return spark.createDataFrame([tuple(round(v, 6) for v in found.values)], "s0 double, s1 double")


@query("m24_svd_u", f"""
SELECT CAST(k AS STRING) AS key, round(abs(x0 * v0 + x1 * v1) / sqrt(e1), 9) AS u0,
       round(abs(x1 * v0 - x0 * v1) / sqrt(e2), 9) AS u1
FROM ({PLANE_POINTS}) AS p, ({GRAM}) AS e""")
def m24_svd_u(spark):
    """U by row, with the row's key."""
    found = reduce.singular_values(rows.scoring_points(sql(spark, PLANE_POINTS).drop("y")), 2)
    u = vector_to_array("u")
    return found.u.select("key", *[F.round(F.abs(u[i]), 9).alias(f"u{i}") for i in (0, 1)])
