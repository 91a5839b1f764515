"""Dense numbers for keys of any type, made without a single-task window."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import shared_dir, write_alone

LARGEST = (1 << 31) - 1  # numbers fit the learners' 32 bits


def dense_keys(rows: DataFrame, column: str) -> DataFrame:
    """``key, id``: every distinct value of the column, nulls left out, with numbers from 0 on without gaps.

    The distinct keys are written to the shared folder with their place in their partition, which
    fixes them for every later read; only the count of each partition is added up, so the
    dictionary may be as large as the keys are many. More than 2^31 - 1 keys raise.
    """
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/gridloom/keys-{uuid.uuid4().hex}"
    found = rows.select(F.col(f"`{column}`").alias("key")).where(F.col("key").isNotNull()).distinct()
    write_alone(found.select("key", F.monotonically_increasing_id().alias("place")), path)
    placed = spark.read.schema(f"key {found.schema['key'].dataType.simpleString()}, place bigint").parquet(path)
    part = F.shiftright("place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("low")).collect()
    shifts, before = [], 0
    for row in sorted(counts):  # one row a partition
        shifts.append((row["part"], before - row["low"]))
        before += row["n"]
    if before > LARGEST:
        raise ValueError(f"{before} distinct keys do not fit into 32 bits")
    offsets = spark.createDataFrame(shifts, "part bigint, shift bigint")
    numbered = placed.withColumn("part", part).join(F.broadcast(offsets), "part")
    return numbered.select("key", (F.col("place") + F.col("shift")).cast("int").alias("id"))


def with_ids(rows: DataFrame, column: str, dictionary: DataFrame, name: str, how: str = "inner") -> DataFrame:
    """The rows with the number of a column's key; the dictionary side has each key once, so skewed keys split."""
    ids = dictionary.select(F.col("key").alias(f"{name}_key"), F.col("id").alias(name))
    return rows.join(ids, F.col(f"`{column}`") == F.col(f"{name}_key"), how).drop(f"{name}_key")
