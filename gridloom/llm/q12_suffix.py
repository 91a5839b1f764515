"""op12: bytes of all documents that repeat an earlier string of 100 bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import table
from gridloom.llm.registry import query
from gridloom.llm.suffix_dedup import drop_repeats


@query("op12_suffix_array")
def op12_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    made, out = drop_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return made.select("doc_id", f"{out}.n_bytes", f"{out}.n_removed",
                       F.size(f"{out}.spans").cast("long").alias("n_spans"),
                       F.sha2(F.col(f"{out}.kept"), 256).alias("kept_sha256"))
