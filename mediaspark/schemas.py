"""Declared schemas of every source, so that no reader has to scan twice to infer types."""

from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("device_category", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

SUBSCRIPTIONS = T.StructType([
    T.StructField("subscription_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("plan_id", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("cancel_reason", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

CONTENT = T.StructType([
    T.StructField("content_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("runtime_value", T.IntegerType()),
    T.StructField("runtime_unit", T.StringType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("language", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

RATINGS = T.StructType([
    T.StructField("rating_id", T.IntegerType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("rating_value", T.DecimalType(2, 1)),
    T.StructField("rating_source", T.StringType()),
    T.StructField("rated_at", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
])

CONTENT_METADATA = T.StructType([
    T.StructField("content_id", T.StringType()),
    T.StructField("budget", T.LongType()),
    T.StructField("cast_members", T.StringType()),
    T.StructField("content_rating", T.StringType()),
])

VIEWING_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("device_category", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("watch_duration_ms", T.LongType()),
    T.StructField("seek_position_ms", T.LongType()),
    T.StructField("event_ts", T.StringType()),
    T.StructField("session_start_ts", T.StringType()),
    T.StructField("referrer", T.StringType()),
])

CAMPAIGNS = T.StructType([
    T.StructField("campaign_id", T.StringType()),
    T.StructField("campaign_name", T.StringType()),
    T.StructField("budget", T.StringType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("end_date", T.StringType()),
])

# One stored message of the event topic.
MESSAGE = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# One step of an agent run; a run is stored as one JSON array of these.
TRACE_STEP = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("tool_name", T.StringType()),
    T.StructField("tool_args", T.MapType(T.StringType(), T.StringType())),
    T.StructField("sql", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("step_index", T.IntegerType()),
])
