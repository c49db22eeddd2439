"""Marts: one function per gold table.

Facts are aggregated by the join key before they meet the content table. Only one row
per title then crosses the shuffle of the join, so a title with a third of all views
costs no more than any other. Distinct counts are exact; Spark spreads them over
(group, value) pairs before it counts per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediaspark.operators.silver import NO_CANCEL_REASON

PROCESSED_AT = "_gold_processed_at"


def _processed_at():
    return F.current_timestamp().alias(PROCESSED_AT)


def _titles(content: DataFrame) -> DataFrame:
    """Titles with the number of identical copies, so repeated rows weigh as in a plain join."""
    return content.groupBy("content_id", "title", "content_type").agg(F.count(F.lit(1)).alias("copies"))


def daily_active_users(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date").agg(
        F.count_distinct("user_id").alias("daily_active_users"),
        F.count(F.lit(1)).alias("total_views"),
        F.sum("watch_duration_sec").alias("total_watch_time_sec"),
    ).select("*", _processed_at())


def viewer_titles(events: DataFrame) -> DataFrame:
    """Views and watch time per title and viewer.

    Both the title and the genre mart start here; a job that builds both can write this once.
    """
    return events.groupBy("content_id", "user_id").agg(
        F.count(F.lit(1)).alias("views"),
        F.sum("watch_duration_sec").alias("watch_sec"),
        F.count("watch_duration_sec").alias("timed_views"),
    )


def content_watch_metrics(events: DataFrame, content: DataFrame) -> DataFrame:
    return content_watch_from_viewers(viewer_titles(events), content)


def content_watch_from_viewers(viewers: DataFrame, content: DataFrame) -> DataFrame:
    watched = viewers.groupBy("content_id").agg(
        F.sum("views").alias("views"),
        F.count("user_id").alias("unique_viewers"),
        F.sum("watch_sec").alias("watch_sec"),
        F.try_divide(F.sum("watch_sec"), F.sum("timed_views")).alias("avg_watch_time_sec"),
    )
    return watched.join(_titles(content), "content_id").select(
        "content_id",
        "title",
        "content_type",
        (F.col("views") * F.col("copies")).alias("total_views"),
        "unique_viewers",
        (F.col("watch_sec") * F.col("copies")).alias("total_watch_time_sec"),
        "avg_watch_time_sec",
        _processed_at(),
    )


def content_genres(content: DataFrame) -> DataFrame:
    """One row per title and genre; a genre listed twice counts twice, none drops the title."""
    return content.select("content_id", F.explode("genre_array").alias("genre"))


def genre_popularity(events: DataFrame, content: DataFrame) -> DataFrame:
    return genre_popularity_from_viewers(viewer_titles(events), content)


def genre_popularity_from_viewers(viewers: DataFrame, content: DataFrame) -> DataFrame:
    """Every genre of a title gets the full view."""
    return viewers.join(content_genres(content), "content_id").groupBy("genre").agg(
        F.sum("views").alias("total_views"),
        F.count_distinct("user_id").alias("unique_viewers"),
        F.sum("watch_sec").alias("total_watch_time_sec"),
    ).select("*", _processed_at())


def user_engagement(events: DataFrame) -> DataFrame:
    return user_engagement_from_viewers(viewer_titles(events), events)


def user_engagement_from_viewers(viewers: DataFrame, events: DataFrame) -> DataFrame:
    """Titles, views and time come from the rows per title and viewer, sessions from the events.

    Two distinct counts in one aggregation would triple every event; so each event is combined twice, by
    title and by session, and two rows per user are joined.
    """
    watched = viewers.groupBy("user_id").agg(
        F.sum("views").alias("total_views"),
        F.sum("watch_sec").alias("total_watch_time_sec"),
        F.count("content_id").alias("distinct_content_watched"),
    )
    sessions = events.select(F.col("user_id").alias("_user"), "session_id").distinct().groupBy("_user").agg(F.count("session_id").alias("total_sessions"))
    return watched.join(sessions, F.col("user_id").eqNullSafe(F.col("_user"))).select(
        "user_id",
        "total_sessions",
        "total_views",
        "total_watch_time_sec",
        F.try_divide("total_watch_time_sec", "total_sessions").alias("avg_session_watch_sec"),
        "distinct_content_watched",
        _processed_at(),
    )


def cancel_reasons(subscriptions: DataFrame) -> DataFrame:
    """Counts per plan and reason; all that the plan metrics need, in one pass."""
    active = F.col("is_active")
    return subscriptions.groupBy("plan_id", "cancel_reason").agg(
        F.count(F.lit(1)).alias("subscriptions"),
        F.count_if(active).alias("active"),
        F.count_if(~active).alias("cancelled"),
        F.sum("duration_days").alias("days"),
        F.count("duration_days").alias("dated"),
    )


def subscription_metrics(subscriptions: DataFrame) -> DataFrame:
    """Plan totals and the most frequent cancel reason; of equals the first by name.

    The reason histogram is small, so the plan totals and the top reason both come from
    it: one scan, no join. A null plan has totals but no top reason.
    """
    given = (F.col("cancelled") > 0) & (F.col("cancel_reason") != NO_CANCEL_REASON) & F.col("plan_id").isNotNull()
    ranked = F.when(given, F.struct((-F.col("cancelled")).alias("rank"), F.col("cancel_reason").alias("reason")))
    return cancel_reasons(subscriptions).groupBy("plan_id").agg(
        F.sum("subscriptions").alias("total_subscriptions"),
        F.sum("active").alias("active_subscriptions"),
        F.sum("cancelled").alias("cancelled_subscriptions"),
        F.try_divide(F.sum("days"), F.sum("dated")).alias("avg_duration_days"),
        F.min(ranked)["reason"].alias("top_cancel_reason"),
    ).select("*", _processed_at())


def content_ratings_summary(ratings: DataFrame, content: DataFrame) -> DataFrame:
    """Ratings are averaged as doubles; half-star steps then sum without rounding."""
    value = F.col("rating_value").cast("double")
    rated = ratings.groupBy("content_id").agg(
        F.avg(value).alias("avg_rating"),
        F.count(F.lit(1)).alias("ratings"),
        F.min(value).alias("min_rating"),
        F.max(value).alias("max_rating"),
    )
    return rated.join(_titles(content), "content_id").select(
        "content_id",
        "title",
        "content_type",
        "avg_rating",
        (F.col("ratings") * F.col("copies")).alias("rating_count"),
        "min_rating",
        "max_rating",
        _processed_at(),
    )
