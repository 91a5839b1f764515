"""op10: all documents as pieces, packed into sequences of 1024 tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.common import stored_by_texts, table
from gridloom.llm.packing import pack_pieces, token_pieces
from gridloom.llm.registry import query


def packed(docs: DataFrame) -> DataFrame:
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return pack_pieces(stored_by_texts(pieces, "pieces"))


@query("op10_bin_completion")
def op10_bin_completion(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))
