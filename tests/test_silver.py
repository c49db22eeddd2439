import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediaspark import schemas
from mediaspark.operators import silver
from tests.helpers import collected, frame, plan_of

DAY = dt.date(2024, 6, 30)


def stamp(text):
    return dt.datetime.fromisoformat(text)


def test_users(spark):
    df = frame(
        spark, schemas.USERS,
        ("USR-1", "a+b@c.in", "Ann", DAY, "mobile", "Linux; Android 9", "inDia", None),
        ("USR-2", None, "Bob", None, None, None, None, None),
    )
    out = silver.users(df)
    assert out.columns == [
        "user_id", "email", "is_valid_email", "full_name", "signup_date", "device_category", "device_os", "country",
        "created_at", "_silver_processed_at",
    ]
    assert collected(out, "user_id", "is_valid_email", "device_os", "country") == [
        ("USR-1", True, "Android", "INDIA"), ("USR-2", None, "Other", None),
    ]


def test_subscriptions(spark):
    start = dt.date(2024, 6, 1)
    df = frame(
        spark, schemas.SUBSCRIPTIONS,
        ("open", "u", "P", start, None, None, None),
        ("ends today", "u", "P", start, DAY, None, None),
        ("ended", "u", "P", start, dt.date(2024, 6, 29), "price", None),
        ("ended silently", "u", "P", start, dt.date(2024, 6, 2), None, None),
        ("undated", "u", "P", None, None, None, None),
    )
    out = silver.subscriptions(df, DAY)
    assert out.schema["duration_days"].dataType == T.IntegerType()
    assert collected(out, "subscription_id", "is_active", "duration_days", "cancel_reason") == [
        ("ended", False, 28, "price"),
        ("ended silently", False, 1, "active"),
        ("ends today", True, 29, "active"),
        ("open", True, 29, "active"),
        ("undated", True, None, "active"),
    ]
    assert silver.subscriptions(df).columns == out.columns


def test_content(spark):
    catalogue = frame(
        spark, schemas.CONTENT,
        ("C1", " Sea ", "movie", "Drama | Action", 119, "seconds", 2020, "hi", None),
        ("C2", "\tSky", "series", None, 50, "minutes", 2021, "en", None),
        ("C3", "Sun", "series", "A,,B", 50, None, 2021, "en", None),
    )
    metadata = frame(
        spark, schemas.CONTENT_METADATA,
        ("C1", 3_000_000_000, "X|Y", "UA"), ("C1", 5, "Z", "U"), ("C2", None, None, "A"), ("C9", 1, "Q", "S"),
    )
    out = silver.content(catalogue, metadata)
    assert out.columns == [
        "content_id", "title", "content_type", "genre_array", "runtime_minutes", "release_year", "language", "budget",
        "cast_members", "content_rating", "created_at", "_silver_processed_at",
    ]
    wanted = ("content_id", "title", "genre_array", "runtime_minutes", "budget", "cast_members", "content_rating")
    assert collected(out, *wanted) == [
        ("C1", "Sea", ["Drama", "Action"], 1, 5, ["Z"], "U"),
        ("C2", "\tSky", None, 50, None, None, "A"),
        ("C3", "Sun", ["A", "", "B"], 50, None, None, None),
    ]
    every = silver.content(catalogue, metadata, one_metadata_row=False, strip_whitespace=True)
    assert collected(every, "content_id", "title", "budget") == [
        ("C1", "Sea", 3_000_000_000), ("C1", "Sea", 5), ("C2", "Sky", None), ("C3", "Sun", None),
    ]


def test_campaigns(spark):
    df = frame(
        spark, schemas.CAMPAIGNS,
        ("A", "one", "USD 20", "2024-01-01", "2024-03-01"), ("B", "two", "7", "2024-01-01", None),
        ("C", "three", "USD abc", "2024-01-05", "2024-01-01"),
    )
    out = silver.campaigns(df)
    assert collected(out, "campaign_id", "budget_amount", "budget_currency", "campaign_duration_days") == [
        ("A", 20, "USD", 60), ("B", 7, "INR", None), ("C", None, "USD", -4),
    ]
    assert out.schema["start_date"].dataType == T.DateType()


RATED = [
    (1, "u1", "c1", Decimal("3.0"), "app", stamp("2024-01-01T00:00:00"), None),
    (2, "u1", "c1", Decimal("4.5"), "web", stamp("2024-01-02T00:00:00"), None),  # later
    (3, "u1", "c2", Decimal("2.0"), "app", stamp("2024-01-02T00:00:00"), None),
    (4, "u1", "c2", Decimal("1.0"), "app", stamp("2024-01-02T00:00:00"), None),  # same time, higher id
    (5, "u2", "c1", Decimal("5.5"), "tv", stamp("2024-01-09T00:00:00"), None),  # out of range
    (6, "u2", "c1", Decimal("0.0"), "tv", stamp("2024-01-08T00:00:00"), None),
    (7, "u2", "c2", Decimal("-0.5"), "tv", stamp("2024-01-08T00:00:00"), None),
    (8, "u3", "c1", None, "tv", stamp("2024-01-08T00:00:00"), None),
    (9, "u4", "c1", Decimal("5.0"), "tv", None, None),
    (10, "u4", "c1", Decimal("4.0"), "tv", stamp("2020-01-08T00:00:00"), None),  # any time beats none
]


def test_ratings_keep_the_latest_in_range(spark):
    out = silver.ratings(frame(spark, schemas.RATINGS, *RATED))
    assert out.schema["rating_value"].dataType == T.DecimalType(2, 1)
    assert collected(out, "rating_id", "user_id", "content_id", "rating_value") == [
        (10, "u4", "c1", Decimal("4.0")),
        (2, "u1", "c1", Decimal("4.5")),
        (4, "u1", "c2", Decimal("1.0")),
        (6, "u2", "c1", Decimal("0.0")),
    ]


def event(event_id, when, user="u", watched=1500, session="s", kind="PLAY"):
    return (event_id, user, "c", session, "mobile", kind, watched, None, when, None, "home")


def test_events_are_parsed_before_they_are_deduplicated(spark):
    batch = frame(
        spark, schemas.VIEWING_EVENT,
        event("e1", None),  # broken here, good in the stream
        event("e2", "not a time"),
        event("e3", "2025-03-15T20:31:05.123Z", watched=None, kind="SEEK"),
        event("e4", "2025-03-15T10:00:00Z", user="first"),
        event("e5", "2025-03-15T10:00:00Z", user="b"),
    )
    stream = frame(
        spark, schemas.VIEWING_EVENT,
        event("e1", "2025-03-15T10:00:00.000Z"),
        event("e4", "2025-03-15T10:00:01Z", user="second"),
        event("e5", "2025-03-15T15:30:00+05:30", user="a"),  # the same instant
    )
    out = silver.events(batch, stream, "Asia/Kolkata")
    assert out.columns == [
        "event_id", "user_id", "content_id", "session_id", "device_category", "event_type", "watch_duration_ms",
        "watch_duration_sec", "seek_position_ms", "event_ts", "session_start_ts", "event_date", "referrer",
        "_silver_processed_at",
    ]
    assert collected(out, "event_id", "user_id", "event_type", "watch_duration_sec", "event_date") == [
        ("e1", "u", "play", 1.5, dt.date(2025, 3, 15)),
        ("e3", "u", "seek", None, dt.date(2025, 3, 16)),
        ("e4", "first", "play", 1.5, dt.date(2025, 3, 15)),
        ("e5", "a", "play", 1.5, dt.date(2025, 3, 15)),
    ]
    alone = silver.events(batch, zone="Asia/Kolkata")
    assert collected(alone, "event_id") == [("e3",), ("e4",), ("e5",)]


def test_rows_and_partitions_in_any_order_give_the_same_result(spark):
    rng = random.Random(42)
    rated = [
        (rng.randrange(40), f"u{rng.randrange(4)}", f"c{rng.randrange(4)}", Decimal(rng.randrange(-2, 12)) / 2,
         rng.choice(["app", "web"]), stamp(f"2024-01-0{rng.randrange(1, 4)}T00:00:00"), None)
        for _ in range(300)
    ]
    seen = [
        event(f"e{rng.randrange(30)}", rng.choice([None, "x", "2025-01-01T00:00:00Z", "2025-01-01T00:00:01Z"]),
              user=rng.choice("abc"), session=rng.choice([None, "s"]))
        for _ in range(300)
    ]
    results = set()
    for parts in (1, 3, 8):
        rng.shuffle(rated)
        rng.shuffle(seen)
        ratings = silver.ratings(frame(spark, schemas.RATINGS, *rated).repartition(parts)).drop("_silver_processed_at")
        events = silver.events(frame(spark, schemas.VIEWING_EVENT, *seen).repartition(parts)).drop("_silver_processed_at")
        results.add((repr(collected(ratings)), repr(collected(events))))
    assert len(results) == 1


def test_one_hot_key_is_cut_before_the_shuffle(spark):
    plan = plan_of(silver.ratings(frame(spark, schemas.RATINGS, *RATED)))
    exchange = plan.index("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in plan[exchange:]
    hot = spark.range(20_000).select(
        F.lit(None).cast("string").alias("event_id"), *(F.lit("x").alias(c) for c in ("user_id", "content_id", "session_id", "device_category", "event_type")),
        F.col("id").alias("watch_duration_ms"), F.col("id").alias("seek_position_ms"),
        F.lit("2025-01-01T00:00:00Z").alias("event_ts"), F.lit(None).cast("string").alias("session_start_ts"), F.lit("r").alias("referrer"),
    )
    assert collected(silver.events(hot), "watch_duration_ms") == [(0,)]


def test_rating_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "ratings")
    frame(spark, schemas.RATINGS, *RATED).write.parquet(path)
    plan = silver.ratings(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rating_value,0.0)" in plan and "LessThanOrEqual(rating_value,5.0)" in plan
    scan = plan[plan.index("ReadSchema"):]
    assert "created_at" not in scan
