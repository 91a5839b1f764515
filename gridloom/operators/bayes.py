"""Naive Bayes: one aggregate over the rows, a model of classes x features."""

from __future__ import annotations

from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.sql import DataFrame


def train_bayes(rows: DataFrame, smoothing: float = 1.0, model_type: str = "multinomial") -> NaiveBayesModel:
    learner = NaiveBayes(smoothing=smoothing, modelType=model_type.lower())
    return learner.fit(rows.select("label", "features"))
