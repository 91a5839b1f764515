"""op6: all documents scored by a class-based model of nine tenths of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.brown_lm import score
from gridloom.llm.common import table
from gridloom.llm.registry import query


@query("op6_brown_classes")
def op6_brown_classes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return score(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0).drop("perplexity")
