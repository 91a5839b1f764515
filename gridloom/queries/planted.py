"""Trainers on structure planted in the given tables: what a learner has to find, stated by SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators import cluster, metrics, recommend, rows, split, trees
from gridloom.operators.scoring import score
from gridloom.queries.base import RATINGS, SIGNAL_POINTS, TARGET_POINTS, kept, query, sql

# Four groups on a plane, far apart: two pairs, each pair at a tenth of the distance.
GROUPS = """
SELECT p_partkey AS k, p_partkey % 4 AS y,
       CASE WHEN p_partkey % 4 >= 2 THEN 100 ELSE 0 END + p_size / 50 AS x0,
       CASE WHEN p_partkey % 2 = 1 THEN 10 ELSE 0 END + p_size / 50 AS x1
FROM part"""

GROUPS_SQL = """
SELECT CAST(p_partkey % 4 AS DOUBLE) AS label, count(*) AS cnt, CAST(1 AS BIGINT) AS labels FROM part GROUP BY 1"""


def _groups(spark) -> DataFrame:
    return rows.cluster_points(sql(spark, GROUPS), True)


def _found(points: DataFrame, model) -> DataFrame:
    """Label, its rows and how many labels share its cluster, for each label and cluster."""
    table = metrics.contingency(score(model, points))
    sharing = table.groupBy("cluster").agg(F.count("label").alias("labels"))
    return table.join(sharing, "cluster").select("label", "cnt", "labels")


@query("m13_groups", GROUPS_SQL, uses="part")
def m13_groups(spark):
    """K-means with the job's defaults finds every group whole."""
    points = _groups(spark)
    return _found(points, cluster.train_kmeans(points, k=4))


@query("m15_groups", GROUPS_SQL, uses="part")
def m15_groups(spark):
    """Bisecting k-means splits into the pairs, then into the groups."""
    points = _groups(spark)
    return _found(points, cluster.train_bisecting(points, k=4))


@query("m26_groups", "SELECT TRUE AS accurate, TRUE AS cheap", uses="part")
def m26_groups(spark):
    """Clusters on two components: every label right, and a cost below the groups' own spread."""
    found = cluster.cluster_with_reduction(_groups(spark), k=4, reduce=True)
    n = spark.table("part").count()
    return spark.createDataFrame([(found.accuracy > 0.999, found.cost < n)], "accurate boolean, cheap boolean")


@query("m12_planted", f"SELECT count(*) AS n, TRUE AS near FROM ({RATINGS}) AS p", uses="orders lineitem")
def m12_planted(spark):
    """Rates of rank one: predictions with the job's defaults are close to them on average."""
    rated = sql(spark, f"SELECT u, i, CAST((1 + u % 3) * (1 + i % 2) AS DOUBLE) AS r FROM ({RATINGS}) AS p")
    rated = kept(rows.ratings(rated), "rated")
    found = recommend.score_ratings(recommend.train_als(rated), rated)
    return found.agg(F.count(F.lit(1)).alias("n"), (F.avg(F.abs(F.col("rate") - F.col("prediction"))) < 0.1).alias("near"))


@query("m21_components", """
SELECT CAST(s_nationkey AS BIGINT) AS nation, count(*) AS members, CAST(1 AS BIGINT) AS clusters
FROM supplier GROUP BY 1 HAVING count(*) > 2""", uses="supplier")
def m21_components(spark):
    """Suppliers of a nation are all linked: the members of a component share a cluster.

    Two nodes alone only swap their values in every step, so components of three and more count.
    """
    members = sql(spark, "SELECT s_suppkey AS id, s_nationkey AS class FROM supplier")
    edges = sql(spark, """
        SELECT DISTINCT s_nationkey AS src, s_nationkey AS dst, CAST(1 AS DOUBLE) AS weight
        FROM supplier WHERE s_nationkey IS NOT NULL""")
    found = cluster.power_iteration(edges, members=members).join(spark.table("supplier"), F.col("id") == F.col("s_suppkey"))
    return found.groupBy(F.col("s_nationkey").cast("bigint").alias("nation")).agg(
        F.count(F.lit(1)).alias("members"), F.countDistinct("cluster").alias("clusters")).where("members > 2")


STUMP_WORSE = "SELECT count(*) AS n, TRUE AS better FROM lineitem"


@query("m5_forest_signal", STUMP_WORSE)
def m5_forest_signal(spark):
    """A forest with the job's defaults makes fewer errors than the best single cut."""
    points = rows.labelled_points(sql(spark, SIGNAL_POINTS)).persist()
    try:
        errors = [metrics.test_error(score(model, points)).first()[0] for model in (
            trees.train_forest_classifier(points), trees.train_tree_classifier(points, max_depth=1))]
        return spark.createDataFrame([(points.count(), errors[0] < errors[1])], "n bigint, better boolean")
    finally:
        points.unpersist()


@query("m6_boosted_signal", STUMP_WORSE)
def m6_boosted_signal(spark):
    """Ten boosting steps make fewer errors than the best single cut."""
    points = rows.labelled_points(sql(spark, SIGNAL_POINTS))
    errors = [metrics.test_error(score(model, points)).first()[0] for model in (
        trees.train_boosted_classifier(points, iterations=10), trees.train_tree_classifier(points, max_depth=1))]
    return spark.createDataFrame([(points.count(), errors[0] < errors[1])], "n bigint, better boolean")


@query("m9_forest_signal", STUMP_WORSE)
def m9_forest_signal(spark):
    """A regression forest with the job's defaults leaves less error than the best single cut."""
    points = rows.labelled_points(sql(spark, TARGET_POINTS)).persist()
    try:
        errors = [metrics.mean_squared_error(score(model, points)).first()[0] for model in (
            trees.train_forest_regressor(points), trees.train_tree_regressor(points, max_depth=1))]
        return spark.createDataFrame([(points.count(), errors[0] < errors[1])], "n bigint, better boolean")
    finally:
        points.unpersist()


@query("m10_boosted_signal", STUMP_WORSE)
def m10_boosted_signal(spark):
    """Twenty boosting steps leave less than half of the best single cut's error."""
    points = rows.labelled_points(sql(spark, TARGET_POINTS))
    errors = [metrics.mean_squared_error(score(model, points)).first()[0] for model in (
        trees.train_boosted_regressor(points, iterations=20), trees.train_tree_regressor(points, max_depth=1))]
    return spark.createDataFrame([(points.count(), errors[0] < errors[1] / 2)], "n bigint, better boolean")


@query("p3_keyed_batch", """
SELECT iteration, l_orderkey, l_linenumber FROM lineitem, (SELECT unnest([1, 2, 3]) AS iteration) AS i
WHERE CAST('0x' || substr(md5(l_orderkey || '-' || l_linenumber || ':' || iteration), 1, 8) AS BIGINT)
      < 0.25 * 4294967296""")
def p3_keyed_batch(spark):
    """Rows of three descent iterations at fraction 0.25, the same on any partitioning."""
    lines = spark.table("lineitem").select("l_orderkey", "l_linenumber", F.concat_ws(
        "-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"))
    batches = [split.mini_batch(lines, 0.25, i, key="key").withColumn("iteration", F.lit(i)) for i in (1, 2, 3)]
    return batches[0].unionByName(batches[1]).unionByName(batches[2]).drop("key")


@query("a5_many_centres", """
WITH c AS (SELECT vec_id AS cluster, list_reverse(embedding) AS e FROM embeddings WHERE vec_id < 1000),
d AS (SELECT p.vec_id, c.cluster,
             list_sum(list_transform(list_zip(p.embedding, c.e),
                                     lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) ** 2)) AS cost
      FROM embeddings p, c)
SELECT vec_id, CAST(arg_min(cluster, cost) AS INT) AS cluster, round(min(cost), 6) AS cost FROM d GROUP BY vec_id""",
       uses="embeddings")
def a5_many_centres(spark):
    """The nearest of up to 1,000 centres of 64 numbers for every embedding."""
    centres = spark.table("embeddings").where("vec_id < 1000").orderBy("vec_id") \
        .select(F.reverse("embedding").alias("e")).collect()
    nearest = metrics.nearest_centre(F.col("x"), [r["e"] for r in centres])
    points = spark.table("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return points.select("vec_id", nearest.alias("n")).select("vec_id", "n.cluster", F.round("n.cost", 6).alias("cost"))


@query("m24_rank", "SELECT CAST(2 AS INT) AS all_values, CAST(1 AS INT) AS above")
def m24_rank(spark):
    """A second value far below the first is found, and left out when the caller asks for that."""
    from gridloom.operators.reduce import singular_values
    points = rows.scoring_points(sql(spark, """
        SELECT l_orderkey AS k, l_quantity AS x0, CASE WHEN l_linenumber = 1 THEN 0.0001 ELSE 0.0 END AS x1 FROM lineitem"""))
    return spark.createDataFrame([(len(singular_values(points, 2).values), len(singular_values(points, 2, 1e-3).values))],
                                 "all_values int, above int")


@query("b3_saved_clusters", GROUPS_SQL, uses="part")
def b3_saved_clusters(spark):
    """A saved and loaded k-means model scores as the trained one."""
    from gridloom.queries.base import scratch
    from gridloom.sources.models import load_model
    points = _groups(spark)
    path = scratch(spark, "kmeans")
    cluster.train_kmeans(points, k=4, runs=1).save(path)
    return _found(points, load_model(13, path))
