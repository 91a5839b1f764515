"""Control tables as DataFrames: job parameters, scoring jobs, dictionary, model paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import trimmed


def first_job(job_id: str) -> str:
    """A job id may be a comma list; parameters are looked up by its first element."""
    return job_id.split(",")[0]


def parameter_join(details: DataFrame, key_names: DataFrame, jobs: DataFrame,
                   job_id: str | None = None) -> DataFrame:
    """details ⋈ key names ⋈ jobs as ``(uuid, key_name, key_value)``.

    With a job id the filter is on the jobs side before the join, so that only
    that job's rows meet the large detail table. No broadcast hint: the planner
    broadcasts a side only when its measured size is under the session's limit.
    """
    wanted = jobs.select(F.col("ID").alias("job_pk"), F.col("UUID").alias("uuid"))
    if job_id is not None:
        wanted = wanted.where(F.col("uuid") == first_job(job_id))
    names = key_names.select(F.col("ID").alias("key_pk"), F.col("KEY_NAME").alias("key_name"))
    return (
        details.select("MODEL_ID", "KEY_ID", F.col("KEY_VALUE").alias("key_value"))
        .join(wanted, F.col("MODEL_ID") == F.col("job_pk"))
        .join(names, F.col("KEY_ID") == F.col("key_pk"))
        .select("uuid", "key_name", "key_value")
    )


def clean_parameters(joined: DataFrame) -> DataFrame:
    """One trimmed, non-empty value per ``(uuid, key)``; the greatest when repeated.

    The group-by combines before its shuffle, so a job with very many rows costs
    no more than its distinct keys.
    """
    return (
        joined.select("uuid", F.lower(trimmed("key_name")).alias("key"),
                      trimmed("key_value").alias("value"))
        .where(F.col("value") != "")
        .groupBy("uuid", "key").agg(F.max("value").alias("value"))
    )


def parameter_maps(cleaned: DataFrame) -> DataFrame:
    """``(uuid, params map)``; a map holds at most one entry per known key name."""
    entries = F.collect_list(F.struct("key", "value"))
    return cleaned.groupBy("uuid").agg(F.map_from_entries(entries).alias("params"))


def job_parameters(details: DataFrame, key_names: DataFrame, jobs: DataFrame,
                   job_id: str) -> dict[str, str]:
    """The parameter set of one job, as the driver needs it to start the job."""
    rows = clean_parameters(parameter_join(details, key_names, jobs, job_id))
    return {row["key"]: row["value"] for row in rows.select("key", "value").collect()}


def scoring_jobs(table: DataFrame, job_id: str | None = None) -> DataFrame:
    """``(uuid, sql, muuid, dbtype, tablename)``; blank cells become null (= key absent)."""
    rows = table if job_id is None else table.where(F.col("uuid") == first_job(job_id))

    def cell(source: str, name: str):
        value = trimmed(source)
        return F.when(value != "", value).alias(name)

    return rows.select(
        "uuid", cell("select_table", "sql"), cell("model_uuid", "muuid"),
        cell("output_param", "dbtype"), cell("output_table", "tablename"),
    )


def scoring_job(table: DataFrame, job_id: str) -> dict[str, str]:
    row = scoring_jobs(table, job_id).drop("uuid").first()
    return {k: v for k, v in row.asDict().items() if v is not None} if row else {}


def dictionary_value(dictionary: DataFrame, parent_type: str, name: str) -> str:
    """One dictionary value, ``""`` when there is none."""
    hit = dictionary.where((F.col("PARENT_DIC_TYPE") == parent_type) & (F.col("DIC_NAME") == name))
    return hit.agg(F.coalesce(F.min("dic_value"), F.lit(""))).first()[0]


def algorithm_id(jobs: DataFrame, model_uuid: str) -> str:
    """The algorithm id of a training job, ``""`` when the job is unknown."""
    hit = jobs.where(F.col("UUID") == model_uuid)
    return hit.agg(F.coalesce(F.min(F.col("AL_ID").cast("string")), F.lit(""))).first()[0]


def with_lookup(rows: DataFrame, key: str, table: DataFrame, table_key: str, table_value: str,
                name: str) -> DataFrame:
    """The same lookup for every row at once: a left join, ``""`` when missing."""
    values = table.groupBy(F.col(table_key).alias("_key")).agg(F.min(table_value).alias("_value"))
    joined = rows.join(values, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(name, F.coalesce("_value", F.lit(""))).drop("_key", "_value")


def latest_per_job(paths: DataFrame) -> DataFrame:
    """Newest ``savePath`` of every job (largest epoch millis).

    ``max_by`` keeps one row per job and map task, so a job that holds a third of
    the registry is no hot partition, which a window over the job would make it.
    """
    newest = F.struct(F.col("timestamp").cast("bigint").alias("at"), F.col("savePath"))
    return paths.groupBy("jobId").agg(F.max(newest).alias("newest")).select(
        "jobId", F.col("newest.savePath").alias("savePath"),
        F.col("newest.at").cast("string").alias("timestamp"))


def model_path(paths: DataFrame, job_id: str) -> str:
    row = latest_per_job(paths.where(F.col("jobId") == job_id)).select("savePath").first()
    return row[0] if row else ""
