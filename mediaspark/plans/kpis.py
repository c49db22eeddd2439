"""Dashboard numbers, aggregated in Spark; only the small result leaves the cluster."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediaspark.functions import numeric, text
from mediaspark.plans.saved import FEWEST_RATINGS

# Bars per chart and bins of the watch-time histogram.
CHART_ROWS = 15
GENRE_ROWS = 10
HISTOGRAM_BINS = 50


def overview(daily: DataFrame, plans: DataFrame) -> DataFrame:
    """One row: total views, mean daily users, hours watched, active subscriptions."""
    active = plans.agg(F.sum("active_subscriptions")).scalar()
    return daily.agg(
        F.sum("total_views").alias("total_views"),
        F.avg("daily_active_users").cast("bigint").alias("avg_daily_active_users"),
        numeric.whole_hours(F.sum("total_watch_time_sec")).alias("total_watch_hours"),
    ).withColumn("active_subscriptions", active)


def timeline(daily: DataFrame) -> DataFrame:
    return daily.select("event_date", "daily_active_users").orderBy("event_date")


def genre_shares(genres: DataFrame) -> DataFrame:
    return genres.select("genre", "total_views").orderBy(F.desc_nulls_last("total_views"), "genre").limit(GENRE_ROWS)


def most_watched(watch: DataFrame) -> DataFrame:
    return (
        watch.orderBy(F.desc_nulls_last("total_views"), "content_id", "title", "content_type")
        .limit(CHART_ROWS)
        .select("content_id", "title", text.chart_label(F.col("title")).alias("short_title"), "total_views")
    )


def best_rated(summary: DataFrame) -> DataFrame:
    """Averages and counts may arrive as text; what is no number is left out by the threshold."""
    return (
        summary.select(
            "content_id",
            "title",
            "content_type",
            numeric.number_or_null(F.col("avg_rating").cast("string")).alias("avg_rating"),
            numeric.number_or_null(F.col("rating_count").cast("string")).alias("rating_count"),
        )
        .filter(F.col("rating_count") >= FEWEST_RATINGS)
        .orderBy(F.desc_nulls_last("avg_rating"), "content_id", "title", "content_type")
        .limit(CHART_ROWS)
        .select("content_id", "title", text.chart_label(F.col("title")).alias("short_title"), "avg_rating")
    )


def plan_status(plans: DataFrame) -> DataFrame:
    """Active and cancelled subscriptions of each plan as rows."""
    return plans.select(
        "plan_id",
        F.col("active_subscriptions").alias("Active"),
        F.col("cancelled_subscriptions").alias("Cancelled"),
    ).unpivot("plan_id", ["Active", "Cancelled"], "status", "subscriptions")


def users_by(users: DataFrame, column: str) -> DataFrame:
    """Users per value of a column, largest first; a null value is not a group."""
    return (
        users.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("users"))
        .orderBy(F.desc("users"), column)
    )


def watch_hours_histogram(engagement: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Users per equal-width bin of hours watched, between the lowest and highest value.

    The bounds are scalar subqueries of the same plan. Bins without users are left out.
    """
    hours = engagement.select((F.col("total_watch_time_sec") / 3600).alias("hours")).filter("hours IS NOT NULL")
    low, high = hours.agg(F.min("hours")).scalar(), hours.agg(F.max("hours")).scalar()
    return (
        hours.select(numeric.bin_number(F.col("hours"), low, high, bins).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("users"))
        .orderBy("bin")
    )


# A chart shows no more; larger results belong in a table.
MOST_CLIENT_ROWS = 10_000


def to_client(small: DataFrame, most: int = MOST_CLIENT_ROWS) -> pd.DataFrame:
    """Hand an aggregated result to a chart; one of more than ``most`` rows is refused, not cut."""
    rows = small.limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are too many for a chart")
    return rows
