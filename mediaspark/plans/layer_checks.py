"""The checks that gate each layer. A missing table fails its checks, it does not stop them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediaspark import schemas
from mediaspark.layout import LakeLayout, path_exists
from mediaspark.operators import quality as q
from mediaspark.operators.gold import PROCESSED_AT as GOLD_PROCESSED_AT
from mediaspark.operators.silver import PROCESSED_AT as SILVER_PROCESSED_AT

Found = Mapping[str, DataFrame | q.Stored | None]

# Rows expected of each bronze table, with its source tag.
BRONZE_EXPECTED = {
    "users": (5000, 5000, "mysql"),
    "subscriptions": (6000, 8000, "mysql"),
    "content": (2000, 2000, "postgres"),
    "ratings": (15000, 18000, "postgres"),
    "content_metadata": (2000, 2000, "csv"),
    "viewing_events_batch": (50000, 50000, "json"),
    "campaigns": (50, 50, "excel"),
}
STREAM_TABLE = "viewing_events"
SILVER_TABLES = ("users", "subscriptions", "content_enriched", "ratings_clean", "viewing_events", "campaigns")
GOLD_TABLES = (
    "daily_active_users",
    "content_watch_metrics",
    "genre_popularity",
    "user_engagement",
    "subscription_metrics",
    "content_ratings_summary",
)

# Rating bounds and the share of batch events that must survive cleaning.
RATING_BOUNDS = (0.0, 5.0)
EVENTS_KEPT = 0.99

# What is measured beyond rows, nulls, least and greatest while a table is written: rows of a condition, values of keys.
UNJUDGED = "emails not judged"
CONDITIONS = {("silver", "users"): {UNJUDGED: "is_valid_email IS NULL AND email IS NOT NULL"}}
KEYS = {
    ("silver", "subscriptions"): [("plan_id",)],
    ("silver", "ratings_clean"): [("user_id", "content_id")],
    ("silver", "viewing_events"): [("event_id",)],
}

# Rows and files expected of the sources.
SOURCE_USERS = 5000
SOURCE_SUBSCRIPTIONS = (6000, 8000)
SOURCE_CONTENT = 2000
SOURCE_RATINGS = (15000, 20000)
SOURCE_EVENTS = 50000
SOURCE_REVIEWS = (450, 550)
SOURCE_THUMBNAILS = (2500, 3100)
HOME_COUNTRY = "India"
USER_ID_FORM = "USR-%"


def _missing(layer: str, table: str) -> q.Rule:
    return q.fixed(f"{layer}/{table} present", False, "table not found")


def _run(spark: SparkSession, layer: str, found: Found, rules) -> DataFrame:
    """``rules`` maps each table to a function from its DataFrame to its rules."""
    parts, absent = [], []
    for table, make in rules.items():
        df = found.get(table)
        if df is None:
            absent.append(_missing(layer, table))
        else:
            parts.append(q.checks(df, make(df)))
    if absent:
        parts.append(q.verdicts(spark, absent))
    return q.union_all(parts)


def bronze(spark: SparkSession, found: Found, expected=BRONZE_EXPECTED) -> DataFrame:
    def table_rules(table, low, high, tag):
        def make(df):
            named = f"bronze/{table}"
            rules = [q.rows_between(f"{named} row count", low, high), q.has_column(f"{named} has _ingested_at", df, "_ingested_at")]
            if "_source" in df.columns:
                rules.append(q.always_equals(f"{named} source tag", "_source", tag))
            else:
                rules.append(q.fixed(f"{named} source tag", False, "missing"))
            return rules
        return make

    rules = {table: table_rules(table, *limits) for table, limits in expected.items()}
    rules[STREAM_TABLE] = lambda df: [q.fixed(f"bronze/{STREAM_TABLE} exists", True, "readable")]
    return _run(spark, "bronze", found, rules)


def silver(spark: SparkSession, found: Found, bronze_tables: Found) -> DataFrame:
    """Silver tables against themselves and the bronze tables they came from."""

    def against(rule, name, source, *args):
        other = bronze_tables.get(source)
        return _missing("bronze", source) if other is None else rule(name, other, *args)

    def audit(df, table):
        return q.has_column(f"silver/{table} has {SILVER_PROCESSED_AT}", df, SILVER_PROCESSED_AT)

    rules = {
        "users": lambda df: [
            audit(df, "users"),
            against(q.same_rows, "silver/users keeps all rows", "users"),
            q.no_nulls("silver/users user_id", "user_id"),
            q.none_broken("silver/users is_valid_email where an email is given", CONDITIONS["silver", "users"][UNJUDGED], UNJUDGED, "nulls"),
            q.no_nulls("silver/users device_os", "device_os"),
        ],
        "subscriptions": lambda df: [
            audit(df, "subscriptions"),
            against(q.same_rows, "silver/subscriptions keeps all rows", "subscriptions"),
            q.no_nulls("silver/subscriptions duration_days", "duration_days"),
        ],
        "content_enriched": lambda df: [
            audit(df, "content_enriched"),
            against(q.same_rows, "silver/content_enriched keeps all rows", "content"),
            q.no_nulls("silver/content_enriched runtime_minutes", "runtime_minutes"),
            q.has_type("silver/content_enriched genre_array is an array", df, "genre_array", T.ArrayType),
        ],
        "ratings_clean": lambda df: [
            audit(df, "ratings_clean"),
            against(q.no_more_rows, "silver/ratings_clean adds no rows", "ratings"),
            q.unique("silver/ratings_clean one rating per user and title", "user_id", "content_id"),
            q.within("silver/ratings_clean rating_value in range", "rating_value", *RATING_BOUNDS),
        ],
        "viewing_events": lambda df: [
            audit(df, "viewing_events"),
            against(q.share_of, "silver/viewing_events keeps the batch events", "viewing_events_batch", EVENTS_KEPT),
            q.unique("silver/viewing_events event_id is unique", "event_id"),
            q.has_type("silver/viewing_events event_ts is a timestamp", df, "event_ts", T.TimestampType),
            q.no_nulls("silver/viewing_events event_date", "event_date"),
        ],
        "campaigns": lambda df: [
            audit(df, "campaigns"),
            q.no_nulls("silver/campaigns budget_amount", "budget_amount"),
            q.no_nulls("silver/campaigns budget_currency", "budget_currency"),
        ],
    }
    return _run(spark, "silver", found, rules)


def gold(spark: SparkSession, found: Found, silver_tables: Found) -> DataFrame:
    subs = silver_tables.get("subscriptions")

    def audit(df, table):
        return q.has_column(f"gold/{table} has {GOLD_PROCESSED_AT}", df, GOLD_PROCESSED_AT)

    def plan_rows():
        if subs is None:
            return _missing("silver", "subscriptions")
        return q.one_row_per("gold/subscription_metrics one row per plan", subs, "plan_id")

    rules = {
        "daily_active_users": lambda df: [
            audit(df, "daily_active_users"),
            q.not_empty("gold/daily_active_users has rows"),
            q.no_nulls("gold/daily_active_users event_date", "event_date"),
        ],
        "content_watch_metrics": lambda df: [
            audit(df, "content_watch_metrics"),
            q.not_empty("gold/content_watch_metrics has rows"),
            q.at_least("gold/content_watch_metrics total_views at least 1", "total_views", 1),
        ],
        "genre_popularity": lambda df: [
            audit(df, "genre_popularity"),
            q.not_empty("gold/genre_popularity has rows"),
            q.no_nulls("gold/genre_popularity genre", "genre"),
        ],
        "user_engagement": lambda df: [
            audit(df, "user_engagement"),
            q.not_empty("gold/user_engagement has rows"),
            q.no_nulls("gold/user_engagement user_id", "user_id"),
        ],
        "subscription_metrics": lambda df: [audit(df, "subscription_metrics"), plan_rows()],
        "content_ratings_summary": lambda df: [
            audit(df, "content_ratings_summary"),
            q.not_empty("gold/content_ratings_summary has rows"),
            q.within("gold/content_ratings_summary avg_rating in range", "avg_rating", *RATING_BOUNDS),
        ],
    }
    return _run(spark, "gold", found, rules)


def commit_marks(spark: SparkSession, layout: LakeLayout, layer: str, tables) -> DataFrame:
    """Every table carries the mark of a finished write: a log folder, or a success file."""
    mark = "_delta_log" if layout.fmt == "delta" else "_SUCCESS"
    rules = []
    for table in tables:
        there = path_exists(spark, f"{layout.table(layer, table)}/{mark}")
        rules.append(q.fixed(f"{layer}/{table} {mark}", there, "exists" if there else "missing"))
    return q.verdicts(spark, rules)


def source_profile(users: DataFrame, subscriptions: DataFrame, content: DataFrame, ratings: DataFrame) -> DataFrame:
    """Row counts of the database sources, the commonest country, id form, planned repeats.

    The commonest country is taken from a count per country, by name where two are equal.
    """
    per_country = users.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    top = F.min(F.struct((-F.col("n")).alias("rank"), F.col("country")))["country"]
    return q.union_all([
        q.checks(users, [q.rows_between("source users", SOURCE_USERS, SOURCE_USERS)]),
        q.checks(subscriptions, [q.rows_between("source subscriptions", *SOURCE_SUBSCRIPTIONS)]),
        q.checks(content, [q.rows_between("source content", SOURCE_CONTENT, SOURCE_CONTENT)]),
        q.checks(ratings, [
            q.rows_between("source ratings", *SOURCE_RATINGS),
            q.has_like("source ratings user_id form", "user_id", "user_id", USER_ID_FORM),
        ]),
        q.checks(q.duplicate_keys(ratings, "user_id", "content_id"), [q.not_empty("source ratings have repeats")]),
        q.checks(per_country, [q.Rule("source users top country", top == HOME_COUNTRY, top)]),
    ])


def file_profile(metadata: DataFrame, events: DataFrame, reviews: DataFrame, thumbnails: DataFrame) -> DataFrame:
    """Row and file counts of the file sources, and the keys of an event.

    ``events`` must be read with its own keys, not with the declared schema.
    """
    return q.union_all([
        q.checks(metadata, [q.rows_between("source content_metadata", SOURCE_CONTENT, SOURCE_CONTENT)]),
        q.checks(events, [
            q.rows_between("source viewing events", SOURCE_EVENTS, SOURCE_EVENTS),
            q.has_columns("source viewing events have all keys", events, schemas.VIEWING_EVENT.names),
        ]),
        q.checks(reviews, [q.rows_between("source reviews", *SOURCE_REVIEWS)]),
        q.checks(thumbnails, [q.rows_between("source thumbnails", *SOURCE_THUMBNAILS)]),
    ])
