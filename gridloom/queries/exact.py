"""Trainers and scorers in their distributed forms, each stated by SQL row by row or by what must hold."""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators import cluster, isotonic, linear, metrics, pairs, recommend, reduce, rows, terms, topics, trees
from gridloom.operators.scoring import score
from gridloom.operators.split import split_by_key
from gridloom.operators.tree_nodes import node_table, score_by_nodes
from gridloom.queries.base import (
    PART_CENTRES, PART_POINTS, RATINGS, SIGNAL_POINTS, TARGET_POINTS, kept, nearest_sql, query, rounded, scratch, sql,
    training)
from gridloom.queries.models import descent_ctes, stump_sql
from gridloom.sources import files
from gridloom.sources.models import load_model

# --- principal components over all features of the embeddings (M22) ----------------------

WIDE = range(64)
WIDE_POINTS = "SELECT vec_id AS k, " + ", ".join(f"embedding[{i}] AS x{i}" for i in WIDE) + " FROM embeddings"


def variance_sql() -> str:
    """The variance of all features together, on the checking engine (its lists start at 1)."""
    return " + ".join(f"var_samp(CAST(embedding[{i + 1}] AS DOUBLE))" for i in WIDE)


@query("m22_pca_wide", f"""
SELECT round({variance_sql()}, 6) AS variance, round({variance_sql()}, 6) AS projected,
       CAST(0 AS DOUBLE) AS covariance, TRUE AS falling FROM embeddings""", uses="embeddings")
def m22_pca_wide(spark):
    """All 64 components: they keep the variance, are not correlated, and each has at most the variance of the one before."""
    points = rows.scoring_points(sql(spark, WIDE_POINTS))
    model = reduce.fit_components(points, 64)
    projected = model.transform(points).select(F.col("projected").alias("features"))
    found = reduce.scatter(projected, True)
    square = found.matrix / (found.n - 1)
    variances = square.diagonal()
    apart = abs(square - np.diag(variances)).max()
    falling = bool((variances[1:] <= variances[:-1] + 1e-12).all())
    return spark.createDataFrame(
        [(round(model.variance, 6), round(float(variances.sum()), 6), round(float(apart), 9) + 0.0, falling)],
        "variance double, projected double, covariance double, falling boolean")


# --- isotonic blocks (M11) ---------------------------------------------------------------

PRICE_POINTS = "SELECT p_partkey AS k, p_size AS y, p_retailprice AS x0 FROM part"

PRICE_FIT = f"""
WITH g AS (SELECT x0 AS x, sum(y) AS s, count(*) AS w FROM ({PRICE_POINTS}) AS p GROUP BY x0),
c AS MATERIALIZED (SELECT x, s, w, sum(s) OVER o AS cs, sum(w) OVER o AS cw, row_number() OVER o AS r
      FROM g WINDOW o AS (ORDER BY x)),
tops AS MATERIALIZED (SELECT i.r AS i, j.r AS j, (j.cs - i.cs + i.s) / (j.cw - i.cw + i.w) AS mean
      FROM c AS i JOIN c AS j ON i.r <= j.r),
lowest AS (SELECT i, j AS k, min(mean) OVER (PARTITION BY i ORDER BY j DESC) AS mean FROM tops)
SELECT c.x, max(lowest.mean) AS fitted FROM c JOIN lowest ON lowest.k = c.r GROUP BY c.x"""


@query("m11_isotonic_blocks", f"""
SELECT CAST(p.k AS STRING) AS key, round(f.fitted, 6) AS prediction
FROM ({PRICE_POINTS}) AS p JOIN ({PRICE_FIT}) AS f ON p.x0 = f.x""", uses="part")
def m11_isotonic_blocks(spark):
    """The size of parts by their price, a feature of as many values as rows, pooled without a list of all blocks."""
    points = rows.first_feature_points(sql(spark, PRICE_POINTS))
    model = isotonic.train_isotonic_blocks(points)
    return model.transform(points).select("key", *rounded("prediction"))


# --- similar vectors (J3) ----------------------------------------------------------------

NEAR_VECTORS = 0.45


@query("j3_similar_vectors", f"""
SELECT src, dst, round(exp(-d2 / 2), 6) AS weight FROM (
    SELECT a.vec_id AS src, b.vec_id AS dst, list_sum(list_transform(range(1, 65), lambda i:
           power(CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE), 2))) AS d2
    FROM embeddings AS a JOIN embeddings AS b ON a.vec_id < b.vec_id) AS p
WHERE exp(-d2 / 2) >= {NEAR_VECTORS}""", uses="embeddings")
def j3_similar_vectors(spark):
    """Pairs of embeddings by all their 64 coordinates."""
    points = rows.scoring_points(sql(spark, WIDE_POINTS))
    found, _ = pairs.similar_vectors(points, "key", "features", NEAR_VECTORS)
    return found.select("src", "dst", *rounded("weight"))


# --- mixtures (M14, B3) ------------------------------------------------------------------

MIXTURE = cluster.Mixture([0.5, 0.3, 0.2], [[1.0, 1.0], [2.5, 4.0], [4.5, 2.0]],
                          [[[1.0, 0.0], [0.0, 1.0]], [[1.0, 0.2], [0.2, 2.0]], [[0.5, 0.0], [0.0, 1.0]]])


def density_sql() -> str:
    """Weight times density of ``x0, x1`` under a component ``w, m0, m1, s0, s01, s1``."""
    det = "(s0 * s1 - s01 * s01)"
    away = (f"((x0 - m0) * (x0 - m0) * s1 - 2 * (x0 - m0) * (x1 - m1) * s01 + (x1 - m1) * (x1 - m1) * s0) / {det}")
    return f"w / (2 * pi() * sqrt({det})) * exp(-({away}) / 2)"


def mixture_ctes(steps: int) -> tuple[str, str]:
    """EM unrolled: one table of components a step; and the last one's name."""
    parts = [(j, w, *m, s[0][0], s[0][1], s[1][1])
             for j, (w, m, s) in enumerate(zip(MIXTURE.weights, MIXTURE.means, MIXTURE.covariances))]
    values = ", ".join("(" + ", ".join(f"{v}::DOUBLE" if i else str(v) for i, v in enumerate(p)) + ")" for p in parts)
    ctes = [f"p AS MATERIALIZED ({PART_POINTS})",
            f"c0(j, w, m0, m1, s0, s01, s1) AS MATERIALIZED (VALUES {values})"]
    for i in range(1, steps + 1):
        ctes.append(f"""c{i} AS MATERIALIZED (
            SELECT j, sum(r) / (SELECT count(*) FROM p) AS w, sum(r * x0) / sum(r) AS m0, sum(r * x1) / sum(r) AS m1,
                   sum(r * x0 * x0) / sum(r) - power(sum(r * x0) / sum(r), 2) AS s0,
                   sum(r * x0 * x1) / sum(r) - sum(r * x0) / sum(r) * sum(r * x1) / sum(r) AS s01,
                   sum(r * x1 * x1) / sum(r) - power(sum(r * x1) / sum(r), 2) AS s1
            FROM (SELECT j, x0, x1, d / sum(d) OVER (PARTITION BY k) AS r
                  FROM (SELECT k, x0, x1, j, {density_sql()} AS d FROM p, c{i - 1}) AS e) AS s GROUP BY j)""")
    return "WITH " + ", ".join(ctes), f"c{steps}"


STEPS_SQL, LAST_STEP = mixture_ctes(3)


def _mixture(spark) -> tuple[DataFrame, cluster.Mixture]:
    points = rows.labelled_points(training(spark, PART_POINTS, "part"))
    return points, cluster.refine_mixture(points, MIXTURE, 3)


@query("m14_mixture_steps", f"{STEPS_SQL} SELECT j, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in ("w", "m0", "m1", "s0", "s01", "s1")) + f" FROM {LAST_STEP}", uses="part")
def m14_mixture_steps(spark):
    """Three steps of EM from given components."""
    _, model = _mixture(spark)
    found = [(j, *[round(float(v), 6) + 0.0 for v in (w, *m, s[0][0], s[0][1], s[1][1])])
             for j, (w, m, s) in enumerate(zip(model.weights, model.means, model.covariances))]
    return spark.createDataFrame(found, "j int, w double, m0 double, m1 double, s0 double, s01 double, s1 double")


@query("b3_mixture_rows", f"""{STEPS_SQL}
SELECT CAST(k AS STRING) AS key, CAST(arg_max(j, d) AS DOUBLE) AS prediction, round(max(d) / sum(d), 6) AS share
FROM (SELECT k, j, {density_sql()} AS d FROM p, {LAST_STEP}) AS e GROUP BY k""", uses="part")
def b3_mixture_rows(spark):
    """Every part's most likely component and how likely it is."""
    points, model = _mixture(spark)
    return model.transform(points).select("key", "prediction",
                                          F.round(F.array_max("probability"), 6).alias("share"))


@query("a5_silhouette", f"""
WITH a AS MATERIALIZED ({nearest_sql(PART_POINTS, PART_CENTRES)}),
d AS (SELECT s.k, s.cluster AS mine, t.cluster AS other, count(*) AS n,
             sum((s.x0 - t.x0) * (s.x0 - t.x0) + (s.x1 - t.x1) * (s.x1 - t.x1)) AS total
      FROM a AS s, a AS t GROUP BY 1, 2, 3),
v AS (SELECT k, max(CASE WHEN mine = other AND n > 1 THEN total / (n - 1) END) AS own,
             min(CASE WHEN mine <> other THEN total / n END) AS near FROM d GROUP BY k)
SELECT round(avg(CASE WHEN own IS NULL THEN 0 ELSE (near - own) / greatest(own, near) END), 6) AS silhouette
FROM v""", uses="part")
def a5_silhouette(spark):
    """Clusters without labels: the silhouette from sums, against all pairs in SQL."""
    assigned = cluster.Centres(PART_CENTRES).transform(rows.labelled_points(sql(spark, PART_POINTS)))
    return metrics.silhouette(assigned, "prediction").select(*rounded("silhouette"))


# --- mini-batches by key (M1, M7, P3) ------------------------------------------------------

FRACTION = 0.25


def batch_sql(source: str, loss: str, step: float, reg: float, iterations: int) -> str:
    """The descent of ``descent_ctes`` with a sample by key in every iteration."""
    ctes, last = descent_ctes(source, loss, step, reg, "l2", iterations)
    for i in range(1, iterations + 1):
        bucket = f"CAST('0x' || substr(md5(k || ':{i}'), 1, 8) AS BIGINT) < {FRACTION * 2 ** 32:.0f}"
        at = next(n for n, c in enumerate(ctes) if c.startswith(f"g_{i} "))
        ctes[at] = ctes[at].replace(f"FROM p, w_{i - 1})", f"FROM p, w_{i - 1} WHERE {bucket})")
    return "WITH " + ", ".join(ctes) + (f" SELECT round(w0, 6) AS w0, round(w1, 6) AS w1, round(w2, 6) AS w2, "
                                        f"round(b, 6) AS b FROM {last}")


def _batch_weights(spark, text: str, loss: str, step: float, reg: float):
    points = rows.labelled_points(training(spark, text))
    model = linear.descend(points, loss, [(step, reg)], 4, "l2", tol=0.0, fraction=FRACTION, key="key")[0]
    return spark.createDataFrame([tuple(round(w, 6) + 0.0 for w in [*model.weights, model.intercept])],
                                 "w0 double, w1 double, w2 double, b double")


@query("m1_keyed_batches", batch_sql(SIGNAL_POINTS, linear.HINGE, 1.0, 0.01, 4))
def m1_keyed_batches(spark):
    """The SVM on a quarter of the orders in each iteration."""
    return _batch_weights(spark, SIGNAL_POINTS, linear.HINGE, 1.0, 0.01)


@query("m7_keyed_batches", batch_sql(TARGET_POINTS, linear.SQUARED, 0.5, 0.05, 4))
def m7_keyed_batches(spark):
    """Least squares on a quarter of the orders in each iteration."""
    return _batch_weights(spark, TARGET_POINTS, linear.SQUARED, 0.5, 0.05)


# --- a tree on sparse rows with a held-out part (M25) --------------------------------------

RATIO = 0.7
_SPARSE = "printf('%.6f', CAST(y AS DOUBLE))" + "".join(
    f" || CASE WHEN x{i} <> 0 THEN ' {i + 1}:' || printf('%.6f', CAST(x{i} AS DOUBLE)) ELSE '' END" for i in range(3))
_IN_TRAINING = f"CAST('0x' || substr(md5({_SPARSE}), 1, 8) AS BIGINT) < {RATIO * 2 ** 32!r}"


def _part(side: str) -> str:
    return f"SELECT * FROM ({SIGNAL_POINTS}) AS s WHERE {side}({_IN_TRAINING})"


@query("m25_held_out", f"""
SELECT round(avg(CASE WHEN y <> prediction THEN 1.0 ELSE 0.0 END), 9) AS test_error, count(*) AS n
FROM ({stump_sql(_part(''), 'gini', _part('NOT '))}) AS s""")
def m25_held_out(spark):
    """A tree of depth 1 on seven tenths of LibSVM rows, and the operator's own error on the others."""
    folder = scratch(spark, "libsvm")
    rows.label_first_points(sql(spark, SIGNAL_POINTS).drop("k")).write.format("libsvm").save(folder)
    points = files.read_libsvm(spark, folder, 3)
    _, error = trees.tree_with_error(points, RATIO, max_depth=1, max_bins=64, by_key=True)
    n = split_by_key(points, RATIO, trees.sparse_key())[1].count()
    return spark.createDataFrame([(round(error, 9), n)], "test_error double, n bigint")


# --- ratings of any key (F7, M12, B4) --------------------------------------------------------

PLANTED_RATES = f"""
SELECT u + 5000000000 AS u, concat('part-', CAST(i AS STRING)) AS i,
       CAST((1 + u % 3) * (1 + i % 2) AS DOUBLE) AS r FROM ({RATINGS}) AS p"""


@query("m12_wide_keys", f"""
SELECT u AS "user", i AS item, r AS rate, TRUE AS scored FROM ({PLANTED_RATES}) AS p
UNION ALL SELECT 1, 'part-1', CAST(0 AS DOUBLE), FALSE""", uses="orders lineitem")
def m12_wide_keys(spark):
    """Users beyond 32 bits and named items: trained, saved, read back and scored; a new user has no prediction."""
    rated = kept(rows.keyed_ratings(sql(spark, PLANTED_RATES)), "rated")
    path = scratch(spark, "ratings")
    recommend.train_ratings(rated).save(path)
    new = spark.createDataFrame([(1, "part-1", 0.0)], rated.schema)
    found = score(load_model(12, path), rated.unionByName(new))
    return found.select("user", "item", "rate", F.col("prediction").isNotNull().alias("scored"))


_RATING_HASH = "CAST('0x' || substr(md5(u || ':' || i), 1, 8) AS BIGINT)"


@query("m12_held_out", f"""
SELECT count(*) FILTER (h < {0.8 * 2 ** 32!r} OR h = least_h) AS trained,
       count(*) FILTER (NOT (h < {0.8 * 2 ** 32!r} OR h = least_h)) AS held_out,
       count(DISTINCT u) AS users, TRUE AS better
FROM (SELECT u, i, {_RATING_HASH} AS h, min({_RATING_HASH}) OVER (PARTITION BY u) AS least_h
      FROM ({PLANTED_RATES}) AS p) AS q""", uses="orders lineitem")
def m12_held_out(spark):
    """A fifth of the ratings held out, none of them a user's last: their error is below that of the mean rate."""
    # each of these is read many times: the joins behind them are done once
    rated = kept(rows.keyed_ratings(sql(spark, PLANTED_RATES)), "rated")
    train, test = (kept(side, name) for side, name in zip(recommend.split_ratings(rated, 0.8), ("train", "test")))
    found = kept(score(recommend.train_ratings(train), test).where(F.col("prediction").isNotNull()), "found")
    mean = train.agg(F.avg("rate")).first()[0]
    plain = found.withColumn("prediction", F.lit(mean))
    error, other = (metrics.root_mean_squared_error(f, "rate").first()[0] for f in (found, plain))
    users = train.select("user").distinct().count()
    return spark.createDataFrame([(train.count(), test.count(), users, error < other)],
                                 "trained bigint, held_out bigint, users bigint, better boolean")


# --- saved models scored by their nodes (B1) -------------------------------------------------

SAVED = (4, 5, 6, 8, 9, 10)


@query("b1_saved_trees", "SELECT a AS algorithm, n, CAST(0 AS BIGINT) AS different FROM "
       "(SELECT count(*) AS n FROM part) AS c, (VALUES " + ", ".join(f"({a})" for a in SAVED) + ") AS v(a)", uses="part")
def b1_saved_trees(spark):
    """Saved trees, forests (the jobs' defaults) and boosted sums (20 steps): node tables predict what the loaded model does."""
    points = rows.labelled_points(training(spark, PART_POINTS, "part")).withColumn(
        "label", F.when(F.col("label") >= 3, 1.0).otherwise(0.0)).persist()
    fits = {4: trees.train_tree_classifier, 5: trees.train_forest_classifier, 6: partial(trees.train_boosted_classifier, iterations=20),
            8: trees.train_tree_regressor, 9: trees.train_forest_regressor, 10: partial(trees.train_boosted_regressor, iterations=20)}
    found = []
    try:
        for algorithm in SAVED:
            path = scratch(spark, f"model-{algorithm}")
            fits[algorithm](points).save(path)
            scored = load_model(algorithm, path).transform(points).withColumnRenamed("prediction", "loaded")
            both = score_by_nodes(node_table(spark, path), algorithm, scored)
            row = both.agg(F.count(F.lit(1)), F.count_if(F.abs(F.col("loaded") - F.col("prediction")) > 1e-9)).first()
            found.append((algorithm, row[0], row[1]))
    finally:
        points.unpersist()
    return spark.createDataFrame(found, "algorithm int, n bigint, different bigint")


@query("b1_node_counts", "SELECT count(*) AS n, TRUE AS shared_out, TRUE AS binary, CAST(0 AS BIGINT) AS different FROM lineitem")
def b1_node_counts(spark):
    """A saved tree of depth 5 as a table: children share out their node's rows, and every leaf has the rows that reach it."""
    path = scratch(spark, "tree")
    points = rows.labelled_points(sql(spark, SIGNAL_POINTS))
    trees.train_tree_classifier(points).save(path)
    nodes = node_table(spark, path)
    children = nodes.select(F.col("node").alias("child"), F.col("n").alias("rows"))
    shares = nodes.where("low IS NOT NULL").join(children, F.col("child").isin(F.col("low"), F.col("high"))) \
        .groupBy("node", "n").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("k"))
    sums = shares.agg(F.bool_and(F.col("rows") == F.col("n")), F.bool_and(F.col("k") == 2)).first()
    # the same tree with the node's number as what a leaf predicts
    numbered = nodes.withColumn("prediction", F.col("node").cast("double"))
    reached = score_by_nodes(numbered, 4, points).groupBy(F.col("prediction").cast("int").alias("leaf")).count()
    wrong = nodes.where("low IS NULL").join(reached, F.col("node") == F.col("leaf"), "left") \
        .where("count IS NULL OR count <> n").count()
    root = nodes.where("node = 0").first()["n"]
    return spark.createDataFrame([(root, sums[0], sums[1], wrong)],
                                 "n bigint, shared_out boolean, binary boolean, different bigint")


# --- topics over documents (M20, K7, F9) -----------------------------------------------------

BUNDLES, MIN_BUNDLES = 30, 5
# Three groups of documents with words of their own; documents are read in bundles, so that every bundle has many words.
TOKENS = f"""
SELECT doc_id % {BUNDLES} AS id, concat(CAST(doc_id % 3 AS STRING), ':', word) AS term
FROM (SELECT doc_id, explode(split(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' ')), ' ')) AS word
      FROM documents) AS w WHERE word <> ''"""
TOKENS_SQL = f"""
SELECT doc_id % {BUNDLES} AS id, (doc_id % 3) || ':' || word AS term
FROM (SELECT doc_id, unnest(string_split(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' ', 'g')), ' ')) AS word
      FROM documents) AS w WHERE word <> ''"""


@query("m20_document_topics", f"""
SELECT left(term, 1) AS "group", count(*) AS terms, CAST(1 AS BIGINT) AS topics, CAST(1 AS BIGINT) AS groups
FROM (SELECT term FROM ({TOKENS_SQL}) AS t GROUP BY term HAVING count(DISTINCT id) >= {MIN_BUNDLES}) AS v
GROUP BY 1""", uses="documents")
def m20_document_topics(spark):
    """Topics of whole texts over their vocabulary: all terms of a group share their main topic, and no other group has it."""
    vectors, words = terms.count_vectors(sql(spark, TOKENS), MIN_BUNDLES)
    found = topics.named_terms(topics.train_topics(vectors), words)
    main = found.groupBy("term").agg(F.max_by("topic", "weight").alias("topic")) \
        .withColumn("group", F.substring("term", 1, 1)).persist()
    try:
        shared = main.groupBy("topic").agg(F.countDistinct("group").alias("groups"))
        return spark.createDataFrame(main.join(shared, "topic").groupBy("group").agg(
            F.count(F.lit(1)).alias("terms"), F.countDistinct("topic").alias("topics"),
            F.max("groups").alias("groups")).collect(),
            '`group` string, terms bigint, topics bigint, groups bigint')
    finally:
        main.unpersist()


EVENT_TOKENS = "SELECT user_id AS id, event_type AS term FROM events"


@query("f9_event_vectors", "SELECT user_id AS id, event_type AS term, CAST(count(*) AS DOUBLE) AS n "
       "FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2", uses="events")
def f9_event_vectors(spark):
    """Sparse counts of every event type of the table, however many there are, read back through the vocabulary."""
    vectors, words = terms.count_vectors(sql(spark, EVENT_TOKENS))
    counted = vectors.select("id", F.posexplode(vector_to_array("features")).alias("index", "n")).where("n > 0")
    return counted.join(words.select("term", "index"), "index").select("id", "term", "n")


@query("k7_event_topics", "SELECT event_type AS term, CAST(count(*) AS DOUBLE) AS weight FROM events "
       "WHERE event_type IS NOT NULL GROUP BY 1", uses="events")
def k7_event_topics(spark):
    """Topics over all event types with the job's defaults: the topics share out every type's count."""
    vectors, words = terms.count_vectors(sql(spark, EVENT_TOKENS))
    found = topics.named_terms(topics.train_topics(vectors), words)
    return found.groupBy("term").agg(F.round(F.sum("weight"), 3).alias("weight"))
