"""Model loader: the algorithm id of a job names the class that reads its saved model."""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassificationModel, GBTClassificationModel, LogisticRegressionModel,
    NaiveBayesModel, RandomForestClassificationModel)
from pyspark.ml.clustering import BisectingKMeansModel, GaussianMixtureModel, KMeansModel
from pyspark.ml.regression import (
    DecisionTreeRegressionModel, GBTRegressionModel, IsotonicRegressionModel,
    RandomForestRegressionModel)

from gridloom.operators.linear import LinearModel
from gridloom.operators.recommend import RatingModel

# Algorithm id -> model class.
MODEL_CLASSES = {
    1: LinearModel,
    2: LogisticRegressionModel,
    3: NaiveBayesModel,
    4: DecisionTreeClassificationModel,
    5: RandomForestClassificationModel,
    6: GBTClassificationModel,
    7: LinearModel,
    8: DecisionTreeRegressionModel,
    9: RandomForestRegressionModel,
    10: GBTRegressionModel,
    11: IsotonicRegressionModel,
    12: RatingModel,
    13: KMeansModel,
    14: GaussianMixtureModel,
    15: BisectingKMeansModel,
}


def load_model(algorithm_id: int | str, path: str):
    """The saved model of an algorithm; ids that cannot score raise ``ValueError``."""
    try:
        model_class = MODEL_CLASSES[int(algorithm_id)]
    except (KeyError, ValueError):
        raise ValueError(f"algorithm id {algorithm_id!r} has no model that can score") from None
    return model_class.load(path)
