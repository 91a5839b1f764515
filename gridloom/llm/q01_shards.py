"""op1: all documents in eight shards of near equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import table
from gridloom.llm.kd_shards import kd_shards
from gridloom.llm.registry import query

SHARDS = 8


@query("op1_kd_tree")
def op1_kd_tree(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", "lang", "source", "n_chars", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    sharded, shard, slot = kd_shards(docs, ["n_chars", "source", "lang"], F.col("size"), shards=SHARDS,
                                     identity=["doc_id", "text_crc32"], keep=["doc_id", "size", "text_crc32"])
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), shard, slot,
                          F.lit(None).cast("int").alias("grown_shard"))
