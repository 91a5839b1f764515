"""Tables of a data folder and tables kept in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import shared_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the folder that all executors share; each call gives another one."""
    return f"{shared_dir(spark)}/gridloom/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of Spark for the queries run inside; it is put back afterwards."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    This cuts the lineage: a lost executor costs a read of the files, not the work above them.
    """
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


TEXT_ROWS = "1000"  # whole texts that go to Python at once: a batch is held on both sides


def stored_by_texts(frame: DataFrame, name: str) -> DataFrame:
    """The same for rows that Python makes of whole texts, in smaller batches than Spark's own."""
    with setting(frame.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS):
        return stored(frame, name)


BROADCAST_IDS = 1 << 20


def ids_side(ids: DataFrame) -> DataFrame:
    """A stored table of ids for a join with long rows: broadcast up to a million ids, else by shuffle."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def free_name(frame: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front while the frame has a column of that name."""
    taken = {c.lower() for c in frame.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def bound(value, body):
    """``body(value)`` with the value computed once for each row, also where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
