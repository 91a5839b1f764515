"""Sources, sinks, row shapes, splits, joins, measures: everything before the trainers."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions.categories import category_map
from gridloom.functions.columns import (
    at_least_zero, bracketed, gaussian_similarity, grid_id, squared_distance)
from gridloom.operators import cluster, metrics, pairs, recommend, relabel, rows, split
from gridloom.queries.base import (
    LINE_POINTS, ORDER_FLAGS, PART_CENTRES, PART_POINTS, RATINGS, USER_COUNTS, nearest_sql, query,
    rounded, scratch, spread, sql)
from gridloom.sinks import tables
from gridloom.plans.jobs import training_input
from gridloom.sources import control, files
from gridloom.sources.sql import run_sql

# --- SQL-text source -------------------------------------------------------------------

S1_TEXTS = {
    "s1_filter_project": """
SELECT l_orderkey, l_partkey, l_quantity * l_extendedprice AS amount
FROM lineitem WHERE l_discount >= 0.05 AND l_returnflag = 'R'""",
    "s1_join": """
SELECT c_mktsegment, o_orderpriority, count(*) AS n,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY c_mktsegment, o_orderpriority""",
    "s1_group_by": """
SELECT coalesce(l_returnflag, '-') AS flag, coalesce(l_linestatus, '-') AS status, count(*) AS n,
       CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "s1_window": """
SELECT l_suppkey, l_orderkey, l_extendedprice, CAST(place AS INT) AS place
FROM (SELECT l_suppkey, l_orderkey, l_extendedprice, row_number() OVER (
          PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey) AS place
      FROM lineitem) AS ranked
WHERE place <= 3""",
    "s1_union": """
SELECT 'customer' AS side, c_custkey AS id, c_acctbal AS balance FROM customer WHERE c_acctbal > 0
UNION ALL
SELECT 'supplier' AS side, s_suppkey AS id, s_acctbal AS balance FROM supplier WHERE s_acctbal > 0""",
}


def _register_texts() -> None:
    for name, text in S1_TEXTS.items():
        query(name, text, "lineitem orders customer supplier")(lambda spark, text=text: sql(spark, text))


_register_texts()

S2_TEXT = "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal > 0.5"


@query("s2_current_database", "SELECT CAST(s_suppkey AS STRING) AS key, "
       "CAST(s_nationkey AS DOUBLE) AS f0, s_acctbal AS f1 FROM supplier WHERE s_acctbal > 0.5", uses="supplier")
def s2_current_database(spark):
    """The scoring source: unqualified names in the current database, no text rewriting."""
    points = rows.scoring_points(run_sql(spark, S2_TEXT, "default"))
    return points.select("key", *spread("features", ["f0", "f1"]))


# --- file sources ----------------------------------------------------------------------

@query("s3_text_lines", "SELECT event_id, event_type, value FROM events", uses="events")
def s3_text_lines(spark):
    """Events written as blank-separated lines and read back as records."""
    folder = scratch(spark, "lines")
    line = F.concat_ws(" ", F.col("event_id").cast("string"), "event_type", F.col("value").cast("string"))
    spark.table("events").select(line.alias("value")).write.text(folder)
    fields = files.read_lines(spark, folder).select("fields")
    return fields.select(F.col("fields")[0].cast("bigint").alias("event_id"),
                         F.col("fields")[1].alias("event_type"),
                         F.col("fields")[2].cast("double").alias("value"))


@query("s3_ragged_lines", """
SELECT CAST(o_orderkey AS STRING) AS c0, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS c1,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS STRING) END AS c2 FROM orders""", uses="orders")
def s3_ragged_lines(spark):
    """Lines of one to three fields, read by a job's path: every field is kept, missing ones are null."""
    folder = scratch(spark, "ragged")
    status = F.col("o_orderstatus")
    line = F.concat_ws(" ", F.col("o_orderkey").cast("string"), F.when(status != "O", status),
                       F.when(status == "F", F.col("o_custkey").cast("string")))
    spark.table("orders").select(line.alias("value")).write.text(folder)
    return training_input(spark, {"path": folder})


@query("s4_libsvm", """
SELECT CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE) AS label, count(*) AS n,
       CAST(sum(l_quantity) AS DOUBLE) AS f0, CAST(sum(l_linenumber - 1) AS DOUBLE) AS f1
FROM lineitem GROUP BY 1""")
def s4_libsvm(spark):
    """Sparse files (zeros are left out of a line) and the sums per label."""
    folder = scratch(spark, "libsvm")
    text = """SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity,
                     l_linenumber - 1 AS line FROM lineitem"""
    rows.label_first_points(sql(spark, text)).write.format("libsvm").save(folder)
    found = files.read_libsvm(spark, folder, 2).select("label", *spread("features", ["f0", "f1"]))
    return found.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("f0").alias("f0"),
                                      F.sum("f1").alias("f1"))


# --- control tables --------------------------------------------------------------------

def control_tables(spark):
    """Details, key names and jobs in the shape of the control tables, from lines, parts, orders."""
    details = sql(spark, """
        SELECT l_orderkey AS MODEL_ID, l_partkey AS KEY_ID,
               CASE WHEN l_linenumber = 7 THEN '  '
                    ELSE concat(' ', CAST(CAST(l_quantity AS INT) AS STRING), ' ') END AS KEY_VALUE
        FROM lineitem""")
    names = sql(spark, "SELECT p_partkey AS ID, concat(' ', upper(p_name), ' ') AS KEY_NAME FROM part")
    jobs = sql(spark, """
        SELECT o_orderkey AS ID, concat('job-', CAST(o_custkey AS STRING)) AS UUID,
               CAST(o_custkey % 16 AS STRING) AS AL_ID FROM orders""")
    return details, names, jobs


J1_SQL = """
SELECT concat('job-', CAST(o_custkey AS STRING)) AS uuid, concat(' ', upper(p_name), ' ') AS key_name,
       CASE WHEN l_linenumber = 7 THEN '  '
            ELSE concat(' ', CAST(CAST(l_quantity AS INT) AS STRING), ' ') END AS key_value
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"""

S5_SQL = f"""
SELECT uuid, lower(trim(key_name)) AS key, max(trim(key_value)) AS value
FROM ({J1_SQL}) AS j WHERE trim(key_value) <> '' GROUP BY 1, 2"""


@query("j1_parameter_join", J1_SQL, uses="lineitem part orders")
def j1_parameter_join(spark):
    return control.parameter_join(*control_tables(spark))


@query("s5_job_parameters", S5_SQL, uses="lineitem part orders")
def s5_job_parameters(spark):
    return control.clean_parameters(control.parameter_join(*control_tables(spark)))


@query("s5_parameter_maps", f"""
SELECT uuid, CAST(count(*) AS INT) AS n, string_agg(key || '=' || value, ';' ORDER BY key) AS params
FROM ({S5_SQL}) AS p GROUP BY uuid""", uses="lineitem part orders")
def s5_parameter_maps(spark):
    maps = control.parameter_maps(control.clean_parameters(
        control.parameter_join(*control_tables(spark))))
    keys = F.array_sort(F.map_keys("params"))
    texts = F.transform(keys, lambda key: F.concat(key, F.lit("="), F.element_at("params", key)))
    return maps.select("uuid", F.size("params").alias("n"), F.array_join(texts, ";").alias("params"))


@query("s5_control_characters", """
SELECT 'job-' || p_type AS uuid, 'step' AS key, max('v' || CAST(p_size AS STRING)) AS value
FROM part GROUP BY p_type""", uses="part")
def s5_control_characters(spark):
    """Keys and values between control characters; a value of nothing else is no value."""
    return control.clean_parameters(sql(spark, """
        SELECT concat('job-', p_type) AS uuid, concat('\\tSTEP', char(10)) AS key_name,
               concat(char(13), 'v', CAST(p_size AS STRING), char(1), ' ') AS key_value FROM part
        UNION ALL
        SELECT concat('job-', p_type) AS uuid, 'ratio' AS key_name, concat(char(10), char(9)) AS key_value FROM part"""))


@query("s6_scoring_jobs", """
SELECT concat('job-', CAST(c_custkey AS STRING)) AS uuid,
       concat('select * from t', CAST(c_nationkey AS STRING)) AS sql, c_mktsegment AS muuid,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE 'hive' END AS dbtype, c_name AS tablename
FROM customer""", uses="customer")
def s6_scoring_jobs(spark):
    return control.scoring_jobs(sql(spark, """
        SELECT concat('job-', CAST(c_custkey AS STRING)) AS uuid,
               concat(' select * from t', CAST(c_nationkey AS STRING), ' ') AS select_table,
               c_mktsegment AS model_uuid,
               CASE WHEN c_acctbal < 0 THEN '  ' ELSE 'hive' END AS output_param,
               c_name AS output_table
        FROM customer"""))


@query("s7_dictionary_lookup", """
SELECT o_orderkey, coalesce(c_mktsegment, '') AS dic_value
FROM orders LEFT JOIN (SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0) AS d
ON o_custkey = c_custkey""", uses="orders customer")
def s7_dictionary_lookup(spark):
    """Every order's entry in a dictionary of customers, blank when there is none."""
    dictionary = sql(spark, "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0")
    return control.with_lookup(spark.table("orders"), "o_custkey", dictionary, "c_custkey",
                               "c_mktsegment", "dic_value").select("o_orderkey", "dic_value")


# --- sinks and registry ----------------------------------------------------------------

K1_SQL = """
SELECT CAST(l_orderkey AS STRING) AS key_id,
       CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE) AS rawLabel,
       CAST(CASE WHEN l_quantity / 50 - {cut} >= 0 THEN 1 ELSE 0 END AS DOUBLE) AS newLabel,
       'job-1_{idx}' AS uniqueId
FROM lineitem"""


def _cut_predictions(spark, cut: float):
    points = rows.labelled_points(sql(spark, LINE_POINTS)).select(
        "key", "label", *spread("features", ["x0", "x1", "x2"]))
    return points.withColumn("prediction", at_least_zero(F.col("x0") - F.lit(cut)))


@query("k1_append_predictions",
       K1_SQL.format(cut=0.3, idx=0) + " UNION ALL " + K1_SQL.format(cut=0.7, idx=1))
def k1_append_predictions(spark):
    """Two grid points appended to one ORC target and read back."""
    target = scratch(spark, "predictions")
    for index, cut in enumerate([0.3, 0.7]):
        scored = _cut_predictions(spark, cut)
        tables.append(tables.prediction_and_label(scored, grid_id("job-1", index), "0"), target)
    return spark.read.orc(target).drop("timestamp")


@query("k2_append_prediction_only", """
SELECT CAST(l_orderkey AS STRING) AS key_id,
       CAST(CASE WHEN l_quantity / 50 - 0.5 >= 0 THEN 1 ELSE 0 END AS DOUBLE) AS predictLabel,
       'job-2' AS uniqueId FROM lineitem""")
def k2_append_prediction_only(spark):
    target = scratch(spark, "scores")
    tables.append(tables.prediction_only(_cut_predictions(spark, 0.5), "job-2", "0"), target)
    return spark.read.orc(target).drop("timestamp")


@query("k6_current_runs", """
SELECT jobId, arg_max(event_type, event_id) AS appName, concat('app-', max(event_id)) AS appId
FROM (SELECT concat('job-', user_id) AS jobId, event_type, event_id FROM events) AS r GROUP BY jobId""", uses="events")
def k6_current_runs(spark):
    """Application id of the newest run of every job."""
    runs = sql(spark, """
        SELECT concat('job-', CAST(user_id AS STRING)) AS jobId, event_type AS appName,
               concat('app-', CAST(event_id AS STRING)) AS appId,
               CAST(1700000000000 + event_id AS STRING) AS timestamp FROM events""")
    target = scratch(spark, "runs")
    tables.append(runs, target)
    return tables.current_runs(spark.read.orc(target))


@query("o2_latest_row", """
SELECT concat('job-', user_id) AS jobId, concat('/models/', max(event_id)) AS savePath,
       CAST(max(1700000000000 + event_id) AS STRING) AS timestamp
FROM events GROUP BY user_id""", uses="events")
def o2_latest_row(spark):
    """Newest model path of every job."""
    return control.latest_per_job(sql(spark, """
        SELECT concat('job-', CAST(user_id AS STRING)) AS jobId, event_type AS appName,
               concat('/models/', CAST(event_id AS STRING)) AS savePath,
               CAST(1700000000000 + event_id AS STRING) AS timestamp FROM events"""))


@query("o4_append", """
SELECT event_type, 2 * count(*) AS n, CAST(2 * sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type
""", uses="events")
def o4_append(spark):
    """Appending keeps every row, equal ones too."""
    target = scratch(spark, "append")
    for _ in range(2):
        tables.append(spark.table("events").select("event_id", "event_type"), target)
    return spark.read.orc(target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


# --- row shapes ------------------------------------------------------------------------

@query("f1_labelled_point", f"SELECT CAST(k AS STRING) AS key, CAST(y AS DOUBLE) AS label, x0, x1, x2 "
       f"FROM ({LINE_POINTS}) AS p")
def f1_labelled_point(spark):
    points = rows.labelled_points(sql(spark, LINE_POINTS))
    return points.select("key", "label", *spread("features", ["x0", "x1", "x2"]))


@query("f2_optional_label", f"""
SELECT CAST(k AS STRING) AS key, CAST(y AS DOUBLE) AS label, x0, x1 FROM ({PART_POINTS}) AS p
UNION ALL
SELECT CAST(k AS STRING) AS key, CAST(-1 AS DOUBLE) AS label, x0, x1 FROM ({PART_POINTS}) AS p""", uses="part")
def f2_optional_label(spark):
    """Points with a label, and the same without: -1 only at the output."""
    source = sql(spark, PART_POINTS)
    both = rows.cluster_points(source, True).unionByName(rows.cluster_points(source.drop("y"), False))
    return both.select("key", F.coalesce("label", F.lit(rows.NO_LABEL)).alias("label"),
                       *spread("features", ["x0", "x1"]))


@query("f3_scoring_point", f"SELECT CAST(k AS STRING) AS key, x0, x1, x2 FROM ({LINE_POINTS}) AS p")
def f3_scoring_point(spark):
    points = rows.scoring_points(sql(spark, LINE_POINTS).drop("y"))
    return points.select("key", *spread("features", ["x0", "x1", "x2"]))


@query("f4_label_first_point", f"SELECT CAST(y AS DOUBLE) AS label, x0, x1 FROM ({PART_POINTS}) AS p", uses="part")
def f4_label_first_point(spark):
    points = rows.label_first_points(sql(spark, PART_POINTS).drop("k"))
    return points.select("label", *spread("features", ["x0", "x1"]))


def flag_items(separator: str = ",") -> str:
    """The items of a one-hot row, joined, on the checking engine."""
    items = ", ".join(f"CASE WHEN c{i} <> '0' THEN '{i}' END" for i in range(1, 9))
    return f"array_to_string([{items}], '{separator}')"


@query("f5_one_hot_basket", f"SELECT k AS id, '[' || {flag_items()} || ']' AS items "
       f"FROM ({ORDER_FLAGS}) AS p")
def f5_one_hot_basket(spark):
    return rows.one_hot_baskets(sql(spark, ORDER_FLAGS)).select("id", bracketed("items").alias("items"))


# The characters that trimming removes, for the checking engine.
TRIM_SET = " || ".join(f"chr({code})" for code in range(1, 33))


@query("f6_text_basket", f"""
SELECT doc_id, CAST(count(*) AS INT) AS n, CAST(sum(length(word)) AS BIGINT) AS letters
FROM (SELECT DISTINCT doc_id, unnest(string_split(trim(text, {TRIM_SET}), ' ')) AS word
      FROM documents) AS w
GROUP BY doc_id""", uses="documents")
def f6_text_basket(spark):
    """Distinct words of every whole text: how many and how long together."""
    baskets = rows.text_baskets(spark.table("documents"), "text", "doc_id")
    letters = F.aggregate("items", F.lit(0).cast("bigint"), lambda n, word: n + F.length(word))
    return baskets.select("doc_id", F.size("items").alias("n"), letters.alias("letters"))


@query("f7_rating", f'SELECT CAST(u AS INT) AS "user", CAST(i AS INT) AS item, r AS rate '
       f"FROM ({RATINGS}) AS p", uses="orders lineitem")
def f7_rating(spark):
    return rows.ratings(sql(spark, RATINGS))


@query("f8_user_item", f'SELECT CAST(u AS INT) AS "user", CAST(i AS INT) AS item FROM ({RATINGS}) AS p', uses="orders lineitem")
def f8_user_item(spark):
    return rows.user_items(rows.ratings(sql(spark, RATINGS)))


@query("f9_document_vector", "SELECT k AS id, " + ", ".join(
    f"CAST(x{i} AS DOUBLE) AS x{i}" for i in range(5)) + f" FROM ({USER_COUNTS}) AS p", uses="events")
def f9_document_vector(spark):
    documents = rows.document_vectors(sql(spark, USER_COUNTS), has_key=True)
    return documents.select("id", *spread("features", [f"x{i}" for i in range(5)]))


@query("f9_generated_ids", "SELECT count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem")
def f9_generated_ids(spark):
    """Rows without a key get ids that are all different."""
    text = "SELECT l_quantity AS x0, l_linenumber AS x1 FROM lineitem"
    documents = rows.document_vectors(sql(spark, text)).select("id", *spread("features", ["x0", "x1"]))
    return documents.agg(F.countDistinct("id").alias("n"), F.sum("x0").alias("quantity"))


@query("f10_first_feature", f"SELECT CAST(k AS STRING) AS key, CAST(y AS DOUBLE) AS label, "
       f"x0 AS feature, CAST(1 AS DOUBLE) AS weight FROM ({LINE_POINTS}) AS p")
def f10_first_feature(spark):
    return rows.first_feature_points(sql(spark, LINE_POINTS))


@query("f11_categorical_spec", """
SELECT p_partkey, idx, max(arity) AS arity FROM (
    SELECT p_partkey, 50 AS idx, p_size AS arity FROM part
    UNION ALL SELECT p_partkey, p_size + 50 AS idx, 3 AS arity FROM part) AS e
GROUP BY p_partkey, idx""", uses="part")
def f11_categorical_spec(spark):
    """Specs such as ``50:1,none,50:7,57:3``: no colon is ignored, the last entry counts."""
    spec = F.concat(F.lit("50:1,none,50:"), F.col("p_size").cast("string"), F.lit(","),
                    (F.col("p_size") + 50).cast("string"), F.lit(":3"))
    parsed = spark.table("part").select("p_partkey", category_map(spec).alias("m"))
    return parsed.select("p_partkey", F.explode("m").alias("idx", "arity"))


@query("f12_threshold", f"SELECT x0, CAST(CASE WHEN x0 - x1 * 0.5 >= 0 THEN 1 ELSE 0 END AS DOUBLE) "
       f"AS prediction FROM ({LINE_POINTS}) AS p")
def f12_threshold(spark):
    return sql(spark, LINE_POINTS).select(
        "x0", at_least_zero(F.col("x0") - F.col("x1") * F.lit(0.5)).alias("prediction"))


CUT_SQL = f"""
SELECT CAST(k AS STRING) AS key, CAST(y AS DOUBLE) AS label,
       CAST(CASE WHEN x0 - 0.5 >= 0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction
FROM ({LINE_POINTS}) AS p"""


@query("f13_mismatches", f"SELECT * FROM ({CUT_SQL}) AS c WHERE label <> prediction")
def f13_mismatches(spark):
    return metrics.mismatches(_cut_predictions(spark, 0.5)).select("key", "label", "prediction")


@query("f14_upper_triangle", "SELECT l_partkey AS src, l_suppkey AS dst, count(*) AS n FROM lineitem "
       "WHERE l_partkey < l_suppkey GROUP BY l_partkey, l_suppkey")
def f14_upper_triangle(spark):
    """Each unordered pair once: only the edges with ``src < dst``."""
    edges = spark.table("lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))
    return edges.where(F.col("src") < F.col("dst")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


# --- splits ----------------------------------------------------------------------------

BUCKET_SQL = "CAST('0x' || substr(md5(CAST(k AS STRING)), 1, 8) AS BIGINT) / 4294967296.0"


@query("p1_split", f"""
SELECT CAST(k AS STRING) AS key, x0, CASE WHEN {BUCKET_SQL} < 0.7 THEN 'train' ELSE 'test' END AS fold
FROM ({LINE_POINTS}) AS p""")
def p1_split(spark):
    """Every row with its side of a 0.7 split by key."""
    points = sql(spark, LINE_POINTS).select(F.col("k").cast("string").alias("key"), "x0")
    train, test = split.split_by_key(points, 0.7)
    return (train.withColumn("fold", F.lit("train"))
            .unionByName(test.withColumn("fold", F.lit("test"))))


@query("p1_fine_ratio", f"""
SELECT fold, count(*) AS n FROM (
    SELECT CASE WHEN {BUCKET_SQL} < 0.9996 THEN 'train' ELSE 'test' END AS fold FROM ({LINE_POINTS}) AS p) AS s
GROUP BY fold""")
def p1_fine_ratio(spark):
    """A ratio close to 1 keeps its test rows."""
    points = sql(spark, LINE_POINTS).select(F.col("k").cast("string").alias("key"))
    train, test = split.split_by_key(points, 0.9996)
    both = train.withColumn("fold", F.lit("train")).unionByName(test.withColumn("fold", F.lit("test")))
    return both.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("p2_seeded_split", "SELECT count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem")
def p2_seeded_split(spark):
    """The two sides of a random split hold every row exactly once."""
    train, test = split.split_at_random(spark.table("lineitem"), 0.6, seed=11)
    return train.unionByName(test).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("p3_mini_batch")
def p3_mini_batch(spark):
    """Rows of the first descent iterations at fraction 0.25."""
    lines = spark.table("lineitem")
    batches = [split.mini_batch(lines, 0.25, i).agg(F.count(F.lit(1)).alias("n"))
               .withColumn("iteration", F.lit(i)) for i in (1, 2, 3)]
    return batches[0].unionByName(batches[1]).unionByName(batches[2])


# --- joins -----------------------------------------------------------------------------

ITEM_MEANS = f"SELECT i, avg(r) AS m FROM ({RATINGS}) AS p GROUP BY i"


def _rated_pairs(spark):
    rated = rows.ratings(sql(spark, RATINGS))
    means = rated.groupBy("item").agg(F.avg("rate").alias("prediction"))
    predicted = rows.user_items(rated).join(means, "item")
    return recommend.join_predictions(rated, predicted)


J2_SQL = f"""
SELECT CAST(p.u AS INT) AS "user", CAST(p.i AS INT) AS item, p.r AS rate, m.m AS prediction
FROM ({RATINGS}) AS p JOIN ({ITEM_MEANS}) AS m ON p.i = m.i"""


@query("j2_rating_prediction", f'SELECT "user", item, rate, round(prediction, 6) AS prediction '
       f"FROM ({J2_SQL}) AS j", uses="orders lineitem")
def j2_rating_prediction(spark):
    """Ratings joined to predictions (each item's mean) on user and item."""
    return _rated_pairs(spark).select("user", "item", "rate", *rounded("prediction"))


@query("a4_rmse", f"SELECT round(sqrt(avg(power(rate - prediction, 2))), 6) AS rmse FROM ({J2_SQL}) AS j", uses="orders lineitem")
def a4_rmse(spark):
    return metrics.root_mean_squared_error(_rated_pairs(spark), "rate").select(*rounded("rmse"))


MIN_SIMILARITY = 0.6
PLANE = "SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS a, p_retailprice * 2 AS b FROM part"


@query("j3_similar_pairs", f"""
SELECT s.id AS src, t.id AS dst,
       round(exp(-((s.a - t.a) * (s.a - t.a) + (s.b - t.b) * (s.b - t.b)) / 2), 9) AS weight
FROM ({PLANE}) AS s JOIN ({PLANE}) AS t ON s.id < t.id
WHERE (s.a - t.a) * (s.a - t.a) + (s.b - t.b) * (s.b - t.b) <= {pairs.radius_squared(MIN_SIMILARITY)!r}::DOUBLE
""", uses="part")
def j3_similar_pairs(spark):
    """All pairs of parts with Gaussian similarity 0.6 and more."""
    return pairs.similar_pairs(sql(spark, PLANE), "id", ["a", "b"], MIN_SIMILARITY).select(
        "src", "dst", *rounded("weight", digits=9))


@query("x1_gaussian_similarity", f"""
SELECT k, round(exp(-((x0 - 2.5) * (x0 - 2.5) + (x1 - 2.5) * (x1 - 2.5)) / 2), 9) AS similarity
FROM ({PART_POINTS}) AS p""", uses="part")
def x1_gaussian_similarity(spark):
    """Similarity of every part to the middle of the plane."""
    middle = [F.lit(2.5), F.lit(2.5)]
    distance = squared_distance([F.col("x0"), F.col("x1")], middle)
    return sql(spark, PART_POINTS).select("k", F.round(gaussian_similarity(distance), 9).alias("similarity"))


# --- measures --------------------------------------------------------------------------

ASSIGNED_SQL = nearest_sql(PART_POINTS, PART_CENTRES)


def assigned_parts(spark):
    """Parts with the nearest of four given centres as ``prediction``."""
    points = rows.labelled_points(sql(spark, PART_POINTS))
    return cluster.Centres(PART_CENTRES).transform(points)


@query("a1_contingency", f"SELECT CAST(y AS DOUBLE) AS label, cluster, count(*) AS cnt "
       f"FROM ({ASSIGNED_SQL}) AS a GROUP BY 1, 2", uses="part")
def a1_contingency(spark):
    return metrics.contingency(assigned_parts(spark))


@query("o1_count_order", f"SELECT CAST(y AS DOUBLE) AS label, cluster, count(*) AS cnt "
       f"FROM ({ASSIGNED_SQL}) AS a GROUP BY 1, 2 ORDER BY cnt DESC, label, cluster", uses="part")
def o1_count_order(spark):
    return metrics.contingency(assigned_parts(spark)).orderBy(F.desc("cnt"), "label", "cluster")


@query("a2_accuracy", f"SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy "
       f"FROM ({CUT_SQL}) AS c")
def a2_accuracy(spark):
    return metrics.accuracy(_cut_predictions(spark, 0.5))


@query("a3_mse", f"SELECT round(avg(power(y - x0, 2)), 9) AS mse FROM ({LINE_POINTS}) AS p")
def a3_mse(spark):
    return metrics.mean_squared_error(sql(spark, LINE_POINTS), "y", "x0").select(*rounded("mse", digits=9))


@query("a5_cluster_cost", f"SELECT round(sum(cost), 4) AS cost FROM ({ASSIGNED_SQL}) AS a", uses="part")
def a5_cluster_cost(spark):
    points = rows.labelled_points(sql(spark, PART_POINTS))
    return metrics.within_cluster_cost(points, PART_CENTRES).select(*rounded("cost", digits=4))


@query("a6_test_error", f"SELECT avg(CASE WHEN label <> prediction THEN 1.0 ELSE 0.0 END) AS test_error "
       f"FROM ({CUT_SQL}) AS c")
def a6_test_error(spark):
    return metrics.test_error(_cut_predictions(spark, 0.5))


@query("a7_cluster_sizes", f"SELECT cluster, count(*) AS size FROM ({ASSIGNED_SQL}) AS a GROUP BY 1", uses="part")
def a7_cluster_sizes(spark):
    return metrics.cluster_sizes(assigned_parts(spark), "prediction")


K9_SQL = f"""
SELECT a.cluster, s.size, a.k AS id
FROM ({ASSIGNED_SQL}) AS a
JOIN (SELECT cluster, count(*) AS size FROM ({ASSIGNED_SQL}) AS b GROUP BY 1) AS s
  ON a.cluster = s.cluster ORDER BY size, cluster, id"""


@query("k9_cluster_report", K9_SQL, uses="part")
def k9_cluster_report(spark):
    """Clusters by ascending size, members in order, a row per member (also O-3)."""
    assigned = assigned_parts(spark).withColumn("id", F.col("key").cast("bigint"))
    return cluster.cluster_report(assigned, "prediction", "id")


@query("o3_cluster_order", f"SELECT cluster, count(*) AS size FROM ({ASSIGNED_SQL}) AS a "
       f"GROUP BY 1 ORDER BY size, cluster", uses="part")
def o3_cluster_order(spark):
    return metrics.cluster_sizes(assigned_parts(spark), "prediction").orderBy("size", "cluster")


@query("a8_best_point", """
SELECT job, CAST(arg_max(idx, score) AS INT) AS best, max(share) AS value
FROM (SELECT job, idx, share, share * 1000000 - idx AS score FROM (
        SELECT l_suppkey AS job, l_linenumber AS idx,
               round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 4) AS share
        FROM lineitem GROUP BY 1, 2) AS m) AS r
GROUP BY job""")
def a8_best_point(spark):
    """Best line position of every supplier by share of returns; the first wins a tie."""
    table = sql(spark, """
        SELECT l_suppkey AS job, l_linenumber AS idx, round(avg(
            CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 4) AS value
        FROM lineitem GROUP BY l_suppkey, l_linenumber""")
    return metrics.best_points(table, larger_is_better=True)


def greedy_sql(assigned: str, steps: int) -> str:
    """Greedy one-to-one mapping ``cluster, label`` as one CTE per choice."""
    ctes = [f"c AS (SELECT CAST(y AS DOUBLE) AS label, cluster, count(*) AS cnt "
            f"FROM ({assigned}) AS a GROUP BY 1, 2)"]
    for step in range(steps):
        used = " UNION ALL ".join(f"SELECT label, cluster FROM g{i}" for i in range(step))
        free = (f"WHERE label NOT IN (SELECT label FROM ({used}) AS u) "
                f"AND cluster NOT IN (SELECT cluster FROM ({used}) AS u)") if step else ""
        ctes.append(f"g{step} AS (SELECT label, cluster FROM c {free} "
                    f"ORDER BY cnt DESC, label, cluster LIMIT 1)")
    chosen = " UNION ALL ".join(f"SELECT label, cluster FROM g{i}" for i in range(steps))
    return "WITH " + ", ".join(ctes) + f" SELECT * FROM ({chosen}) AS g"


GREEDY = greedy_sql(ASSIGNED_SQL, len(PART_CENTRES))


@query("a9_greedy_relabel", GREEDY, uses="part")
def a9_greedy_relabel(spark):
    """cluster -> label, one to one."""
    mapping = relabel.relabel_map(metrics.contingency(assigned_parts(spark)), len(PART_CENTRES))
    return spark.createDataFrame([(label, c) for c, label in mapping.items()],
                                 "label double, cluster double")


J4_SQL = f"""
SELECT CAST(a.k AS STRING) AS key, CAST(a.y AS DOUBLE) AS label,
       coalesce(g.label, CAST(0 AS DOUBLE)) AS newLabel, g.label IS NOT NULL AS mapped
FROM ({ASSIGNED_SQL}) AS a LEFT JOIN ({GREEDY}) AS g ON a.cluster = g.cluster"""


@query("j4_relabel_lookup", f"""
SELECT a.k, coalesce(g.label, CAST(0 AS DOUBLE)) AS newLabel, g.label IS NOT NULL AS mapped
FROM ({ASSIGNED_SQL}) AS a
LEFT JOIN (SELECT CAST(0 AS DOUBLE) AS cluster, CAST(3 AS DOUBLE) AS label
           UNION ALL SELECT CAST(2 AS DOUBLE), CAST(1 AS DOUBLE)) AS g ON a.cluster = g.cluster""", uses="part")
def j4_relabel_lookup(spark):
    """A given mapping of two of the four clusters; the others become label 0."""
    joined = relabel.apply_relabel(assigned_parts(spark), {0.0: 3.0, 2.0: 1.0})
    return joined.select(F.col("key").cast("bigint").alias("k"), "newLabel", "mapped")


@query("b9_relabelled_output", J4_SQL, uses="part")
def b9_relabelled_output(spark):
    """Clustered rows with the label their cluster matches best."""
    return relabel.relabel(assigned_parts(spark), len(PART_CENTRES)).select(
        "key", "label", "newLabel", "mapped")
