"""Latent Dirichlet allocation on term-count vectors."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import ensure_checkpoint_dir, shared_dir

SEED = 42


def train_topics(documents: DataFrame, k: int = 3, iterations: int = 20, optimizer: str = "em") -> LDAModel:
    """EM by default; ``optimizer="online"`` keeps memory to one mini-batch of documents."""
    ensure_checkpoint_dir(documents.sparkSession)
    return LDA(k=k, maxIter=iterations, optimizer=optimizer, checkpointInterval=10, seed=SEED).fit(documents)


def topic_terms(model: LDAModel) -> DataFrame:
    """``topic, term, weight`` of every topic and term.

    The counts of an EM model are rows of its own graph: it is saved to the shared folder and
    they are read there, terms under negative ids. An online model is one local matrix.
    """
    if model.isDistributed():
        spark = SparkSession.getActiveSession()
        path = f"{shared_dir(spark)}/gridloom/topics-{uuid.uuid4().hex}"
        model.save(path)
        counts = spark.read.parquet(f"{path}/oldModel/data/topicCounts").where("id < 0")
        weights = F.posexplode(vector_to_array("topicWeights")).alias("topic", "weight")
        return counts.select((-(F.col("id") + 1)).cast("int").alias("term"), weights).select(
            "topic", "term", "weight")
    matrix = model.topicsMatrix().toArray()
    terms, k = matrix.shape
    table = pa.table({"topic": np.repeat(np.arange(k, dtype=np.int32), terms),
                      "term": np.tile(np.arange(terms, dtype=np.int32), k), "weight": matrix.T.ravel()})
    return SparkSession.getActiveSession().createDataFrame(table)


def named_terms(model: LDAModel, words: DataFrame) -> DataFrame:
    """``topic, term, weight`` with the words of a vocabulary ``term, index`` in place of their numbers."""
    weights = topic_terms(model).withColumnRenamed("term", "index")
    return weights.join(words.select("term", "index"), "index").select("topic", "term", "weight")
