"""Churn risk per user."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from mediaspark.ml import forest

CATEGORIES = ("plan_id",)
# The subscription's length is reported but not learnt from: it is known only at the end.
NUMBERS = ("subscriptions_held", "active_days", "views", "watch_sec", "titles_per_day")


def train(features: DataFrame) -> tuple[PipelineModel, float | None]:
    """Model, and its area under the ROC curve on users it has not seen (None if those are all of one class)."""
    training, test = forest.split(features, "user_id")
    model = forest.fit(training, CATEGORIES, NUMBERS, "user_id")
    return model, forest.area_under_roc(model, test, CATEGORIES)


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    return forest.score(model, features, CATEGORIES, "churn_probability").select(
        "user_id", "plan_id", "subscription_duration_days", "churn_probability", "prediction"
    )
