"""op4: all documents scored for toxicity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import table
from gridloom.llm.registry import query
from gridloom.llm.toxicity import learn, score

THRESHOLD = 0.7


@query("op4_counterfactual")
def op4_counterfactual(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = learn(docs, table(spark, folder, "labels"), ~held_out)
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
