"""op2: ids of all documents, written as Simple-8b files and read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.common import new_path, table
from gridloom.llm.registry import query
from gridloom.llm.token_files import read_ids, write_ids


@query("op2_simple8b")
def op2_simple8b(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    write_ids(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return read_ids(spark, path, digest=True)
