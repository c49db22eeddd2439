"""Assign a table of questions to the saved query whose key words they mention most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key words of each topic. Of equal scores the topic listed first wins.
TOPIC_WORDS = {
    "top_content": ("top", "most watched", "popular", "trending", "best show", "most viewed"),
    "genre_popularity": ("genre", "genres"),
    "content_ratings": ("rating", "rated", "review"),
    "subscriptions": ("subscription", "plan", "cancel", "cancellation"),
    "dau": ("daily active", "dau", "user growth", "activity trend"),
    "popularity_predictions": ("popularity prediction", "will be popular", "predicted popular"),
    "recommendations": ("recommend", "suggest", "watch next"),
    "churn_risk": ("churn", "retain", "retention", "at risk", "leave", "losing"),
    "streaming_traffic": ("stream", "live", "real-time", "realtime", "traffic", "current"),
    "pipeline_health": ("pipeline", "health", "healthy", "data quality"),
}
NO_TOPIC = "query_analytics"


def topic_scores(question: Column) -> Column:
    """Array of (score, place, topic); the place is negative so that the largest entry is the choice."""
    lowered = F.lower(question)
    entries = []
    for place, (topic, words) in enumerate(TOPIC_WORDS.items()):
        hits = F.lit(0)
        for word in words:
            hits = hits + lowered.contains(word).cast("int")
        entries.append(F.struct(hits.alias("score"), F.lit(-place).alias("place"), F.lit(topic).alias("topic")))
    return F.array(*entries)


def route(questions: DataFrame, text: str = "question") -> DataFrame:
    """Add ``topic`` and ``score``; the words are constants of one projection, so nothing is joined."""
    best = F.array_max(topic_scores(F.coalesce(text, F.lit(""))))
    return (
        questions.withColumn("_best", best)
        .withColumn("topic", F.when(F.col("_best.score") > 0, F.col("_best.topic")).otherwise(NO_TOPIC))
        .withColumn("score", F.col("_best.score"))
        .drop("_best")
    )
