"""File sources: blank-separated text and LibSVM."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.columns import trimmed


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One record per line: ``value`` and its blank-separated ``fields``."""
    lines = spark.read.text(path)
    return lines.select("value", F.split(trimmed("value"), " ").alias("fields"))


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    """Blank-separated numeric lines as one ``array<double>`` column ``numbers``."""
    return read_lines(spark, path).select(F.col("fields").cast("array<double>").alias("numbers"))


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``label`` and sparse ``features``; giving the width saves a pass over the files."""
    reader = spark.read.format("libsvm")
    if num_features:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)
