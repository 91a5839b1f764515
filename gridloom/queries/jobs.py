"""Whole jobs: split, grid, measures, saved models, scoring from the registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.operators import linear, metrics, rows, trees
from gridloom.operators.scoring import score
from gridloom.operators.split import split_by_key
from gridloom.plans.jobs import score_job, train_job
from gridloom.queries.base import (
    LINE_POINTS, SIGNAL_POINTS, TARGET_POINTS, query, rounded, scratch, sql)
from gridloom.queries.models import CLASS_STUMP, STUMP, bayes_sql, descent_ctes
from gridloom.queries.relational import BUCKET_SQL
from gridloom.sinks import tables
from gridloom.sources import control
from gridloom.sources.models import load_model

IN_TRAIN = f"{BUCKET_SQL} < 0.7"
IN_TEST = f"{BUCKET_SQL} >= 0.7"


@query("b5_held_out_scoring", f"""
SELECT CAST(k AS STRING) AS key_id, CAST(y AS DOUBLE) AS rawLabel, prediction AS newLabel,
       'nb-1' AS uniqueId
FROM ({bayes_sql(SIGNAL_POINTS, IN_TRAIN, IN_TEST)}) AS s""")
def b5_held_out_scoring(spark):
    """A naive Bayes job with ratio 0.7; the predictions of its test rows."""
    target = scratch(spark, "held-out")
    train_job(spark, "nb-1", 3, {"data": SIGNAL_POINTS, "ratio": "0.7", "saveresult": target},
              information=None, split_key="key")
    return spark.read.orc(target).drop("timestamp")


GRID = [(0.1, 0.0), (0.1, 0.1), (0.5, 0.0), (0.5, 0.1)]


GRID_PARAMS = {"data": TARGET_POINTS, "ratio": "0.7", "step": "0.1,0.5", "regparam": "0.0,0.1",
               "regtype": "l2", "iterations": "2", "convergencetol": "0"}


def grid_sql() -> str:
    """``idx, step, regparam, mse`` of the grid on the held-out rows."""
    ctes, parts = [], []
    for i, (step, reg) in enumerate(GRID):
        found, last = descent_ctes(f"SELECT * FROM ({TARGET_POINTS}) AS s WHERE {IN_TRAIN}",
                                   linear.SQUARED, step, reg, "l2", 2, f"_{i}")
        ctes += found
        parts.append(
            f"SELECT {i} AS idx, '{step}' AS step, '{reg}' AS regparam, "
            f"avg(power(y - (x0 * w0 + x1 * w1 + x2 * w2 + b), 2)) AS mse "
            f"FROM (SELECT * FROM ({TARGET_POINTS}) AS s WHERE {IN_TEST}) AS t, {last}")
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(parts)


def _grid_metrics(spark):
    result = train_job(spark, "lr-1", 7, GRID_PARAMS, information=None, split_key="key")
    return result.metrics(spark)


@query("b6_grid", f"SELECT idx, step, regparam, round(mse, 6) AS mse FROM ({grid_sql()}) AS g")
def b6_grid(spark):
    """Two steps by two regularisations, first list outermost, measured on the test rows."""
    return _grid_metrics(spark).select(
        "idx", F.col("params")["step"].alias("step"), F.col("params")["regparam"].alias("regparam"),
        F.round("value", 6).alias("mse"))


@query("b8_best_model", f"SELECT 'lr-4' AS job, 4::BIGINT AS saved, round(min(mse), 6) AS mse FROM ({grid_sql()}) AS g")
def b8_best_model(spark):
    """The model that the registry of best points names, loaded and measured on the held-out rows."""
    base = scratch(spark, "models")
    train_job(spark, "lr-4", 7, {**GRID_PARAMS, "savemodel": f"{base}/saved"}, information=None,
              registry=f"{base}/paths", split_key="key")
    path = control.model_path(spark.read.orc(f"{base}/paths{tables.BEST_SUFFIX}"), "lr-4")
    _, test = split_by_key(rows.labelled_points(sql(spark, TARGET_POINTS)), 0.7)
    error = metrics.mean_squared_error(score(load_model(7, path), test)).first()[0]
    saved = spark.read.orc(f"{base}/paths").count()
    return spark.createDataFrame([("lr-4", saved, round(error, 6))], "job string, saved bigint, mse double")


@query("b7_messages", f"""
SELECT idx, 'number: ' || idx || ', iterations: 2, step: ' || step || ', regParam: ' || regparam
       || ', miniBatchFraction: 1.0, regType: l2, intercept: true, convergenceTol: 0, mse: ' AS message,
       round(mse, 6) AS mse
FROM ({grid_sql()}) AS g""")
def b7_messages(spark):
    """The report text of every grid point as the job wrote it, its number apart."""
    target = scratch(spark, "messages")
    train_job(spark, "lr-3", 7, GRID_PARAMS, information=target, split_key="key")
    points = spark.read.orc(target).where(F.col("message").startswith("number: "))
    text = F.regexp_extract("message", r"^(.*: )[^:]*$", 1)
    return points.select(F.regexp_extract("message", r"^number: (\d+)", 1).cast("int").alias("idx"),
                         text.alias("message"),
                         F.round(F.regexp_extract("message", r": ([^:]*)$", 1).cast("double"), 6).alias("mse"))


@query("k3_best_of_grid", f"""
SELECT 'lr-1' AS job, CAST(arg_min(idx, mse) AS INT) AS best, round(min(mse), 6) AS value
FROM ({grid_sql()}) AS g""")
def k3_best_of_grid(spark):
    best = metrics.best_points(_grid_metrics(spark), larger_is_better=False)
    return best.select("job", "best", *rounded("value"))


@query("k3_train_information", f"""
SELECT 'lr-2' AS key_id, idx, round(mse, 6) AS mse FROM ({grid_sql()}) AS g
UNION ALL
SELECT 'lr-2' AS key_id, CAST(arg_min(idx, mse) AS INT) + 100 AS idx, round(min(mse), 6) AS mse
FROM ({grid_sql()}) AS g""")
def k3_train_information(spark):
    """The appended messages, read back: one per grid point and one for the best (index + 100)."""
    target = scratch(spark, "information")
    train_job(spark, "lr-2", 7, GRID_PARAMS, information=target, split_key="key")
    message = F.col("message")
    index = F.coalesce(
        F.nullif(F.regexp_extract(message, r"number: (\d+)", 1), F.lit("")).cast("int"),
        F.regexp_extract(message, r"got by (\d+)-th", 1).cast("int") + 100)
    mse = F.regexp_extract(message, r"(?:mse: |MSE is )(.*)$", 1).cast("double")
    return spark.read.orc(target).select("key_id", index.alias("idx"), F.round(mse, 6).alias("mse"))


@query("k4_save_model", "SELECT 'nb-' || l_returnflag AS jobId, 'NativeBayes' AS appName, "
       "CAST(1 AS BIGINT) AS n, min('nb-' || l_returnflag) AS loaded FROM lineitem "
       "WHERE l_returnflag IN ('A', 'R') GROUP BY l_returnflag")
def k4_save_model(spark):
    """Two jobs save a model each; the registry names one path per job, and it can be loaded."""
    base = scratch(spark, "models")
    for flag in ("A", "R"):
        text = LINE_POINTS.replace("l_returnflag = 'R'", f"l_returnflag = '{flag}'")
        train_job(spark, f"nb-{flag}", 3, {"data": text, "savemodel": f"{base}/{flag}"},
                  information=None, registry=f"{base}/paths")
    paths = spark.read.orc(f"{base}/paths")
    loaded = [(job,) for job in ("nb-A", "nb-R")
              if load_model(3, control.model_path(paths, job)).numClasses == 2]
    known = spark.createDataFrame(loaded, "loaded string")
    counted = paths.groupBy("jobId", "appName").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(known, F.col("jobId") == F.col("loaded"), "left")


@query("s8_model_loader", CLASS_STUMP)
def s8_model_loader(spark):
    """A saved tree, loaded by its algorithm id, scores as the trained one."""
    points = rows.labelled_points(sql(spark, SIGNAL_POINTS))
    path = scratch(spark, "tree")
    trees.train_tree_classifier(points, **STUMP).save(path)
    scored = score(load_model(4, path), points)
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("b8_registry_scoring", f"""
SELECT CAST(k AS STRING) AS key_id, prediction AS predictLabel, 'score-1' AS uniqueId
FROM ({bayes_sql(SIGNAL_POINTS)}) AS s""")
def b8_registry_scoring(spark):
    """Train, save and register (K4), find the newest path (O-2), load (S8), score all rows (K2)."""
    base = scratch(spark, "models")
    train_job(spark, "nb-2", 3, {"data": SIGNAL_POINTS, "savemodel": f"{base}/saved"},
              information=None, registry=f"{base}/paths")
    path = control.model_path(spark.read.orc(f"{base}/paths"), "nb-2")
    target = f"{base}/scores"
    score_job(spark, "score-1", 3, path, f"SELECT k, x0, x1, x2 FROM ({SIGNAL_POINTS}) AS p", target)
    return spark.read.orc(target).drop("timestamp")
