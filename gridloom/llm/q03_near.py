"""op3: near duplicates among all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.common import table
from gridloom.llm.near_dups import near_duplicates
from gridloom.llm.registry import query


@query("op3_hyperminhash")
def op3_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), width=2)
