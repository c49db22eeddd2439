"""Feature tables for the models, and dense integer ids.

Choices made here: a user has churned if their latest subscription is not active on
``as_of``, and only activity before that subscription's end is used. A title is popular if
its views reach the given quantile, and view counts are then not among its features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediaspark.functions import temporal

POPULAR_QUANTILE = 0.75
LARGEST_ALS_ID = 2**31 - 1


def user_features(subscriptions: DataFrame, events: DataFrame, as_of=None) -> DataFrame:
    """One row per subscriber.

    The latest subscription and the number held come from one aggregation. Events are
    summed per user and day first, so that a very active user is a few hundred rows in the
    join; the day limit differs by user and is applied after it.
    """
    today = temporal.as_date(as_of)
    held = subscriptions.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.max(F.struct("start_date", "subscription_id", "plan_id", "duration_days", "is_active", "end_date")).alias("last"),
        F.count(F.lit(1)).alias("subscriptions_held"),
    )
    current = held.select(
        "user_id",
        "last.plan_id",
        F.col("last.duration_days").alias("subscription_duration_days"),
        "subscriptions_held",
        F.when(F.col("last.is_active"), today).otherwise(F.col("last.end_date")).alias("until"),
        F.when(F.col("last.is_active"), 0.0).otherwise(1.0).alias("label"),
    )
    days = events.groupBy("user_id", "event_date").agg(
        F.count(F.lit(1)).alias("views"),
        F.sum("watch_duration_sec").alias("watch_sec"),
        F.count_distinct("content_id").alias("titles"),
    )
    before = F.col("event_date") < F.col("until")
    measures = {
        "active_days": F.count_if(before),
        "views": F.sum(F.when(before, F.col("views"))),
        "watch_sec": F.sum(F.when(before, F.col("watch_sec"))),
        "titles_per_day": F.avg(F.when(before, F.col("titles"))),
    }
    described = ["user_id", "plan_id", "subscription_duration_days", "subscriptions_held"]
    return (
        current.join(days, "user_id", "left")
        .groupBy(*described, "label")
        .agg(*(F.coalesce(value, F.lit(0)).cast("double").alias(name) for name, value in measures.items()))
        .select(*described, *measures, "label")
    )


def content_features(
    content: DataFrame, watch: DataFrame, ratings_summary: DataFrame, quantile: float = POPULAR_QUANTILE
) -> DataFrame:
    """One row per title that has views; what is unknown of a title is 0 or an empty name."""
    # exact at every size: tasks count how often each number of views occurs, and only these counts meet
    limit = watch.agg(F.expr(f"percentile_disc({quantile}) WITHIN GROUP (ORDER BY total_views)")).scalar()
    described = content.select(
        "content_id",
        "title",
        "content_type",
        F.coalesce(F.try_element_at("genre_array", F.lit(1)), F.lit("")).alias("primary_genre"),
        F.coalesce("language", F.lit("")).alias("language"),
        F.coalesce("content_rating", F.lit("")).alias("content_rating"),
        F.coalesce("runtime_minutes", F.lit(0)).cast("double").alias("runtime_minutes"),
        F.coalesce("release_year", F.lit(0)).cast("double").alias("release_year"),
        F.coalesce("budget", F.lit(0)).cast("double").alias("budget"),
        F.coalesce(F.size("genre_array"), F.lit(0)).cast("double").alias("n_genres"),
        F.coalesce(F.size("cast_members"), F.lit(0)).cast("double").alias("n_cast"),
    )
    viewed = _with_title_columns(described, watch, ["total_views"], "inner")
    return _with_title_columns(viewed, ratings_summary, ["avg_rating", "rating_count"], "left").withColumns({
        "avg_rating": F.coalesce("avg_rating", F.lit(0.0)),
        "rating_count": F.coalesce("rating_count", F.lit(0)).cast("double"),
        "label": F.when(F.col("total_views") >= limit, 1.0).otherwise(0.0),
    })


def _with_title_columns(titles: DataFrame, mart: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Columns of a mart that is keyed by id, name and kind of title; a name or kind may be null."""
    other = mart.select(
        *(F.col(key).alias(f"_{key}") for key in ("content_id", "title", "content_type")), *columns
    )
    same = (
        (titles["content_id"] == other["_content_id"])
        & titles["title"].eqNullSafe(other["_title"])
        & titles["content_type"].eqNullSafe(other["_content_type"])
    )
    return titles.join(other, same, how).drop("_content_id", "_title", "_content_type")


def dense_ids(df: DataFrame, column: str, name: str, buckets: int = 1024) -> DataFrame:
    """Distinct non-null values of a column, numbered 0, 1, 2… without gaps.

    Values are numbered within hash buckets, and each bucket starts where the ones before
    it end. No value passes the driver, and running it again gives the same numbers.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    placed = values.withColumn("_bucket", F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int"))
    sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    # One row per bucket: a bounded window over at most ``buckets`` rows.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(column)) - 1
    numbered = placed.withColumn("_within", within).join(F.broadcast(starts), "_bucket")
    return numbered.select(column, (F.col("_start") + F.col("_within")).alias(name))
