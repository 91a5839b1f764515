"""Batch scoring: a model's ``transform`` brought to ``prediction double``."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.isotonic import IsotonicBlocks
from gridloom.operators.recommend import RatingModel, score_ratings


def score(model, points: DataFrame) -> DataFrame:
    """All input columns but the features, and ``prediction``.

    Isotonic models use the first feature only. Rating models take rows of
    ``user, item``.
    """
    if isinstance(model, (ALSModel, RatingModel)):
        return score_ratings(model, points)
    rows = points
    if isinstance(model, (IsotonicRegressionModel, IsotonicBlocks)) and "feature" not in points.columns:
        rows = points.withColumn("feature", vector_to_array("features")[0])
    if hasattr(model, "rawPredictionCol"):  # the label only: no score and probability columns
        unused = [getattr(model, n) for n in ("rawPredictionCol", "probabilityCol") if hasattr(model, n)]
        model = model.copy({param: "" for param in unused})
    kept = [c for c in points.columns if c not in ("features", "feature", "weight")]
    return model.transform(rows).select(*kept, F.col("prediction").cast("double").alias("prediction"))
