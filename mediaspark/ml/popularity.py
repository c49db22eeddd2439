"""Which titles will be popular."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from mediaspark.ml import forest

CATEGORIES = ("content_type", "primary_genre", "language", "content_rating")
NUMBERS = ("runtime_minutes", "release_year", "budget", "n_genres", "n_cast", "avg_rating", "rating_count")


def train(features: DataFrame) -> tuple[PipelineModel, float | None]:
    """Model, and its area under the ROC curve on titles it has not seen (None if those are all of one class)."""
    training, test = forest.split(features, "content_id")
    model = forest.fit(training, CATEGORIES, NUMBERS, "content_id")
    return model, forest.area_under_roc(model, test, CATEGORIES)


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    return forest.score(model, features, CATEGORIES, "popularity_probability").select(
        "content_id", "title", "primary_genre", "total_views", "popularity_probability", "prediction"
    )
