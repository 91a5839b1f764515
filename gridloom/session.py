"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app_name: str = "gridloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; ``master`` only for local runs."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir`` of the session.

    A temporary folder stands in for it only in local mode, where the driver and
    the executors are one process on one machine.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="gridloom-")
    return _LOCAL_DIRS[app]


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_alone(rows: DataFrame, path: str) -> None:
    """Write the rows as Parquet; what was shuffled for them is deleted with the write, not when garbage is collected."""
    conf = rows.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        rows.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to a new folder of the shared folder and read back."""
    path = f"{shared_dir(rows.sparkSession)}/gridloom/{name}-{uuid.uuid4().hex}"
    write_alone(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and stored blocks of what is no longer held."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at the shared folder so that ``checkpoint()`` works."""
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder
