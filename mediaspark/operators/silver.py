"""Cleaning and conforming: one function per silver table.

Intended differences from the plainest reading of the source rules:

* every "keep one row" has a total order, so results do not depend on partitioning;
* events are parsed and filtered before they are deduplicated, so a broken copy
  cannot push out a good one;
* metadata is reduced to one row per title before the join, so titles never fan out
  (``one_metadata_row=False`` turns that off);
* "today" is a parameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediaspark import schemas
from mediaspark.functions import numeric, temporal, text
from mediaspark.operators.keep import keep_first, keep_first_spread, tie_break

PROCESSED_AT = "_silver_processed_at"

# Lowest and highest rating, and the reason written for none.
RATING_RANGE = (0, 5)
NO_CANCEL_REASON = "active"

EVENT_COLUMNS = schemas.VIEWING_EVENT.names


def _processed_at():
    return F.current_timestamp().alias(PROCESSED_AT)


def users(df: DataFrame) -> DataFrame:
    return df.select(
        "user_id",
        "email",
        text.is_email(F.col("email")).alias("is_valid_email"),
        "full_name",
        "signup_date",
        "device_category",
        text.device_system(F.col("user_agent")).alias("device_os"),
        F.upper("country").alias("country"),
        "created_at",
        _processed_at(),
    )


def subscriptions(df: DataFrame, as_of=None) -> DataFrame:
    """``as_of`` is the day that counts as today; a subscription ending that day is active."""
    today = temporal.as_date(as_of)
    return df.select(
        "subscription_id",
        "user_id",
        "plan_id",
        "start_date",
        "end_date",
        F.coalesce("cancel_reason", F.lit(NO_CANCEL_REASON)).alias("cancel_reason"),
        F.coalesce(F.col("end_date") >= today, F.lit(True)).alias("is_active"),
        temporal.days_between(F.col("start_date"), F.coalesce("end_date", today)).alias("duration_days"),
        "created_at",
        _processed_at(),
    )


def content(
    catalogue: DataFrame,
    metadata: DataFrame,
    *,
    strip_whitespace: bool = False,
    one_metadata_row: bool = True,
) -> DataFrame:
    """Catalogue with its metadata, where there is any."""
    extra = metadata.select("content_id", "budget", "cast_members", "content_rating")
    if one_metadata_row:
        extra = keep_first(extra, ["content_id"], tie_break(extra.columns[1:]))
    return catalogue.join(extra, "content_id", "left").select(
        "content_id",
        text.tidy_title(F.col("title"), strip_whitespace).alias("title"),
        "content_type",
        text.genre_list(F.col("genre")).alias("genre_array"),
        numeric.runtime_minutes(F.col("runtime_value"), F.col("runtime_unit")).alias("runtime_minutes"),
        "release_year",
        "language",
        F.col("budget").cast("bigint").alias("budget"),
        text.cast_list(F.col("cast_members")).alias("cast_members"),
        "content_rating",
        "created_at",
        _processed_at(),
    )


def campaigns(df: DataFrame) -> DataFrame:
    budget = F.col("budget").cast("string")
    start, end = F.to_date("start_date"), F.to_date("end_date")
    return df.select(
        "campaign_id",
        "campaign_name",
        text.budget_amount(budget).alias("budget_amount"),
        text.budget_currency(budget).alias("budget_currency"),
        start.alias("start_date"),
        end.alias("end_date"),
        temporal.days_between(start, end).alias("campaign_duration_days"),
        _processed_at(),
    )


def ratings(df: DataFrame) -> DataFrame:
    """Latest rating of each user for each title, of those within the range.

    The bounds take the column's own type, so the filter reaches the file scan.
    """
    kind = df.schema["rating_value"].dataType
    low, high = (F.lit(bound).cast(kind) for bound in RATING_RANGE)
    valid = df.filter(F.col("rating_value").between(low, high)).select(
        "rating_id", "user_id", "content_id", "rating_value", "rating_source", "rated_at"
    )
    latest = [F.desc_nulls_last("rated_at"), F.desc_nulls_last("rating_id")]
    rest = ["rating_value", "rating_source"]
    return keep_first_spread(valid, ["user_id", "content_id"], tie_break(rest, latest)).select(
        "rating_id",
        "user_id",
        "content_id",
        F.col("rating_value").cast("decimal(2,1)").alias("rating_value"),
        "rating_source",
        "rated_at",
        _processed_at(),
    )


def event_order() -> list:
    """Which copy of an event counts: the earliest, ties by the other columns."""
    rest = [name for name in EVENT_COLUMNS if name not in ("event_id", "event_ts")]
    return tie_break(rest, [F.asc("event_ts")])


def events(batch: DataFrame, stream: DataFrame | None = None, zone: str | None = None, *, tables: bool = True) -> DataFrame:
    """Viewing events of the batch file and, if there is one, the stream table, once each.

    ``zone`` is where ``event_date`` is cut; without it the session's zone applies. Events without an id
    cannot be told apart: of all of them the earliest is kept. Ids are counted first where the rows are of ``tables``,
    not of a micro-batch, which is read whole each time.
    """
    together = batch.select(*EVENT_COLUMNS)
    if stream is not None:
        together = together.unionByName(stream.select(*EVENT_COLUMNS))
    parsed = together.withColumns({
        "event_type": F.lower("event_type"),
        "event_ts": temporal.instant(F.col("event_ts")),
        "session_start_ts": temporal.instant(F.col("session_start_ts")),
    }).filter(F.col("event_ts").isNotNull())
    if tables:
        single = keep_first_spread(parsed, ["event_id"], event_order(), source=together.select("event_id"))
    else:
        single = keep_first(parsed, ["event_id"], event_order())
    return single.select(
        "event_id",
        "user_id",
        "content_id",
        "session_id",
        "device_category",
        "event_type",
        "watch_duration_ms",
        numeric.seconds(F.col("watch_duration_ms")).alias("watch_duration_sec"),
        "seek_position_ms",
        "event_ts",
        "session_start_ts",
        temporal.local_date(F.col("event_ts"), zone).alias("event_date"),
        "referrer",
        _processed_at(),
    )
