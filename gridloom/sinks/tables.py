"""Append-only result relations. Columns are fixed; the timestamp is epoch millis as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.columns import bracketed, now_millis
from gridloom.operators.rows import NO_LABEL

TRAIN_INFORMATION = "train_information"
MODEL_PATHS = "mode_save_path"
BEST_SUFFIX = "_best"  # the relation of the best points' models beside the registry of all
JOB_RUNS = "applicationID"


def qualified(name: str, database: str | None) -> str:
    """The name with its database unless it has one or the database is blank."""
    if "." in name or not database or not database.strip():
        return name
    return f"{database}.{name}"


def append(rows: DataFrame, target: str, database: str | None = None, fmt: str = "orc") -> str | None:
    """Append to a table, or to a folder when the target has a slash. Blank: nothing to do."""
    if not target or not target.strip():
        return None
    writer = rows.write.mode("append").format(fmt)
    if "/" in target:
        writer.save(target)
        return target
    name = qualified(target.strip(), database)
    writer.saveAsTable(name)
    return name


def prediction_and_label(scored: DataFrame, unique_id: str, timestamp: str,
                         prediction: str = "prediction") -> DataFrame:
    """``key_id, rawLabel, newLabel, uniqueId, timestamp``; -1 for a missing label."""
    return scored.select(
        F.col("key").cast("string").alias("key_id"),
        F.coalesce("label", F.lit(NO_LABEL)).alias("rawLabel"),
        F.col(prediction).cast("double").alias("newLabel"),
        F.lit(unique_id).alias("uniqueId"), F.lit(timestamp).alias("timestamp"))


def prediction_only(scored: DataFrame, job_id: str, timestamp: str, *extra: str) -> DataFrame:
    """``key_id, predictLabel, uniqueId, timestamp``, after any extra columns."""
    return scored.select(
        *extra, F.col("key").cast("string").alias("key_id"),
        F.col("prediction").cast("double").alias("predictLabel"),
        F.lit(job_id).alias("uniqueId"), F.lit(timestamp).alias("timestamp"))


def rating_predictions(scored: DataFrame, unique_id: str, timestamp: str) -> DataFrame:
    """``user, item, rate, prediction, uniqueId, timestamp``."""
    return scored.select("user", "item", "rate", "prediction", F.lit(unique_id).alias("uniqueId"),
                         F.lit(timestamp).alias("timestamp"))


def rating_predictions_packed(scored: DataFrame, timestamp: str) -> DataFrame:
    """The older layout of the same: item as rawLabel, rate as newLabel, prediction as uniqueId."""
    return scored.select(
        F.col("user").cast("string").alias("key_id"), F.col("item").cast("double").alias("rawLabel"),
        F.col("rate").alias("newLabel"), F.col("prediction").cast("string").alias("uniqueId"),
        F.lit(timestamp).alias("timestamp"))


def item_rows(frequent: DataFrame, job_id: str, min_support: float, timestamp: str) -> DataFrame:
    """``key_id, items, freq, timestamp, min_support`` with items rendered ``[a,b]``."""
    return frequent.select(
        F.lit(job_id).alias("key_id"), bracketed("items").alias("items"), "freq",
        F.lit(timestamp).alias("timestamp"), F.lit(float(min_support)).alias("min_support"))


def rule_rows(found: DataFrame, job_id: str, min_support: float, timestamp: str) -> DataFrame:
    return found.select(
        F.lit(job_id).alias("key_id"), bracketed("antecedent").alias("antecedent"),
        bracketed("consequent").alias("consequent"), "confidence",
        F.lit(timestamp).alias("timestamp"), F.lit(float(min_support)).alias("min_support"))


def train_information(spark: SparkSession, job_id: str, messages: list[str], timestamp: str) -> DataFrame:
    """``key_id, message, timestamp``: one row per grid point and one for the best."""
    rows = [(job_id, message, timestamp) for message in messages]
    return spark.createDataFrame(rows, "key_id string, message string, timestamp string")


def save_model(spark: SparkSession, model, base: str, job_id: str, app_name: str,
               registry: str = MODEL_PATHS, database: str | None = None) -> str | None:
    """Save under ``base/<millis>`` and register the path. Blank base: nothing to do."""
    if not base or not base.strip():
        return None
    timestamp = now_millis()
    path = f"{base.rstrip('/')}/{timestamp}"
    model.save(path)
    register(spark, path, job_id, app_name, timestamp, registry, database)
    return path


def register(spark: SparkSession, path: str, job_id: str, app_name: str, timestamp: str, registry: str,
             database: str | None = None) -> None:
    """One row ``jobId, appName, savePath, timestamp``."""
    row = [(job_id, app_name, path, timestamp)]
    schema = "jobId string, appName string, savePath string, timestamp string"
    append(spark.createDataFrame(row, schema).coalesce(1), registry, database)


def record_run(spark: SparkSession, job_id: str, app_name: str, target: str = JOB_RUNS,
               database: str | None = None) -> None:
    """One row per run: ``jobId, appName, appId, timestamp``."""
    row = [(job_id, app_name, spark.sparkContext.applicationId, now_millis())]
    schema = "jobId string, appName string, appId string, timestamp string"
    append(spark.createDataFrame(row, schema).coalesce(1), target, database)


def current_runs(runs: DataFrame) -> DataFrame:
    """The application id of the newest run of every job."""
    newest = F.struct(F.col("timestamp").cast("bigint").alias("at"), "appName", "appId")
    return runs.groupBy("jobId").agg(F.max(newest).alias("newest")).select(
        "jobId", "newest.appName", "newest.appId")
