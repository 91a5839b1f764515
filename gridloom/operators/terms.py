"""Documents as sparse term counts over a vocabulary that is a table."""

from __future__ import annotations

import uuid

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.keys import dense_keys
from gridloom.session import shared_dir


def vocabulary(counts: DataFrame, min_documents: int = 1) -> DataFrame:
    """``term, index, documents`` of the terms of ``id, term, n`` that at least ``min_documents`` documents have."""
    terms = counts.groupBy("term").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") >= min_documents)
    numbers = dense_keys(terms, "term")
    return terms.join(numbers.select(F.col("key").alias("term"), F.col("id").alias("index")), "term") \
        .select("term", "index", "documents")


def count_vectors(tokens: DataFrame, min_documents: int = 1) -> tuple[DataFrame, DataFrame]:
    """``id, features`` (sparse counts) of ``id, term`` rows, and the vocabulary.

    The counts are one aggregation with map-side combine, so a term that a third of the rows are stays one
    partial row a task and document. The vocabulary is never on the driver; only its size is. A
    document without a term of the vocabulary has an empty vector. Rows with a null term count for nothing but the document.
    The vectors are written as what a vector column holds and read back as one, which cuts the lineage too.
    """
    spark = tokens.sparkSession
    base = f"{shared_dir(spark)}/gridloom"
    path = f"{base}/counts-{uuid.uuid4().hex}"
    counted = tokens.groupBy("id", "term").agg(F.count(F.lit(1)).alias("n"))
    counted.write.parquet(path)
    counts = spark.read.schema(counted.schema).parquet(path)
    words = vocabulary(counts.where(F.col("term").isNotNull()), min_documents)
    words_path = f"{base}/vocabulary-{uuid.uuid4().hex}"
    words.write.parquet(words_path)
    words = spark.read.schema(words.schema).parquet(words_path)
    width = words.count()
    numbered = counts.join(words.select("term", "index"), "term", "left")
    pair = F.when(F.col("index").isNotNull(), F.struct("index", "n"))
    pairs = numbered.groupBy("id").agg(F.sort_array(F.collect_list(pair)).alias("pairs"))
    vector = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(width).alias("size"),
                      F.transform("pairs", lambda p: p["index"]).alias("indices"),
                      F.transform("pairs", lambda p: p["n"].cast("double")).alias("values"))
    vectors_path = f"{base}/vectors-{uuid.uuid4().hex}"
    pairs.select("id", vector.alias("features")).write.parquet(vectors_path)
    schema = T.StructType([tokens.schema["id"], T.StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(vectors_path), words
