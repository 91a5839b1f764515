"""SQL-text source: the user's query is run as it is on the catalog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register_tables(spark: SparkSession, folder: str, names: Iterable[str] = TABLES) -> None:
    """Make the parquet tables of a folder known to SQL texts under their names."""
    for name in names:
        read_table(spark, folder, name).createOrReplaceTempView(name)


def spread_out(rows: DataFrame, table: str) -> DataFrame:
    """Rows of a table that has fewer splits than the cluster has cores, over all cores.

    Iterative training on a table of one small file would run in one task. Large
    tables have more splits than cores and are left as they are: no shuffle.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    splits = spark.table(table).rdd.getNumPartitions()
    return rows.repartition(cores) if splits < cores else rows


def run_sql(spark: SparkSession, text: str, database: str | None = None) -> DataFrame:
    """Rows of a SQL text; unqualified names resolve in ``database`` when given.

    The text is never rewritten: the current database does the qualification, so
    decimal literals and keyword case cannot change which table is read.
    """
    if not text or not text.strip():
        raise ValueError("no SQL text given")
    if not database or not database.strip():
        return spark.sql(text)
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database.strip())
    try:
        return spark.sql(text)
    finally:
        spark.catalog.setCurrentDatabase(before)
