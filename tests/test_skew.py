"""A third of all rows share one key; results must be those of the plain formulation."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from mediaspark.functions import text
from mediaspark.operators import gold, keep, quality, silver
from mediaspark.plans import traffic
from tests.helpers import collected, frame

ROWS = 60_000


@pytest.fixture(scope="module")
def events(spark):
    hot = F.col("id") % 3 == 0

    def key(prefix, n):
        return F.when(hot, F.lit(f"{prefix}-hot")).otherwise(F.concat(F.lit(f"{prefix}-"), F.pmod(F.xxhash64("id", F.lit(prefix)), F.lit(n))))

    return spark.range(0, ROWS, 1, 12).select(
        key("e", 20_000).alias("event_id"), key("u", 500).alias("user_id"), key("c", 50).alias("content_id"), key("s", 900).alias("session_id"),
        (F.col("id") % 100).cast("double").alias("watch_duration_sec"),
        F.when(hot, F.lit(dt.date(2024, 1, 1))).otherwise(F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 30).cast("int"))).alias("event_date"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 3000).alias("event_ts"),
    )


@pytest.fixture(scope="module")
def content(spark):
    return spark.range(50).select(F.concat(F.lit("c-"), "id").alias("content_id"), F.concat(F.lit("t"), "id").alias("title"),
                                  F.lit("m").alias("content_type"), F.array(F.lit("A"), F.concat(F.lit("G"), F.col("id") % 4)).alias("genre_array")).unionByName(
        frame(spark, "content_id string, title string, content_type string, genre_array array<string>", ("c-hot", "hot", "m", ["A", "B"])))


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_marts_with_a_hot_key(spark, events, content, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        events.createOrReplaceTempView("skewed_events")
        content.createOrReplaceTempView("skewed_content")
        plain = {
            "watch": """SELECT content_id, count(*), count(DISTINCT user_id), sum(watch_duration_sec) FROM skewed_events JOIN skewed_content USING (content_id)
                        GROUP BY content_id""",
            "genre": """SELECT genre, count(*), count(DISTINCT user_id), sum(watch_duration_sec) FROM skewed_events JOIN
                        (SELECT content_id, explode(genre_array) genre FROM skewed_content) USING (content_id) GROUP BY genre""",
            "daily": "SELECT event_date, count(DISTINCT user_id), count(*), sum(watch_duration_sec) FROM skewed_events GROUP BY event_date",
            "engagement": """SELECT user_id, count(DISTINCT session_id), count(*), count(DISTINCT content_id) FROM skewed_events GROUP BY user_id""",
        }
        ours = {
            "watch": gold.content_watch_metrics(events, content).select("content_id", "total_views", "unique_viewers", "total_watch_time_sec"),
            "genre": gold.genre_popularity(events, content).drop("_gold_processed_at"),
            "daily": gold.daily_active_users(events).drop("_gold_processed_at"),
            "engagement": gold.user_engagement(events).select("user_id", "total_sessions", "total_views", "distinct_content_watched"),
        }
        for name, df in ours.items():
            assert collected(df) == collected(spark.sql(plain[name])), name
        as_of = F.lit(1_700_003_000).cast("timestamp")
        by_genre = traffic.by_genre(events, content, as_of, 10)
        expected = spark.sql("""SELECT genre, count(*) n, count(DISTINCT user_id) FROM (SELECT * FROM skewed_events WHERE event_ts > timestamp_seconds(1700002400))
            JOIN (SELECT content_id, explode(genre_array) genre FROM skewed_content) USING (content_id) GROUP BY genre ORDER BY n DESC, genre LIMIT 10""")
        assert collected(by_genre) == collected(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_row_per_key_with_a_hot_key(spark, events):
    raw = events.select(
        "event_id", "user_id", "content_id", "session_id", F.lit("m").alias("device_category"), F.lit("PLAY").alias("event_type"),
        F.col("watch_duration_sec").cast("bigint").alias("watch_duration_ms"), F.lit(None).cast("bigint").alias("seek_position_ms"),
        F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("event_ts"), F.lit(None).cast("string").alias("session_start_ts"), F.lit("r").alias("referrer"),
    )
    ours = silver.events(raw).select("event_id", "event_ts")
    assert collected(ours) == collected(events.groupBy("event_id").agg(F.min("event_ts")))
    assert collected(quality.checks(silver.events(raw), [quality.unique("one", "event_id")]), "passed") == [(True,)]


@pytest.mark.parametrize("hot", [0, 500, 10**9])
def test_rare_keys_are_kept_apart_from_hot_ones(spark, events, hot):
    """All keys, only the hot one, and none take the group limit; null keys are one group each way."""
    raw = events.select(F.when(F.col("user_id") != "u-1", F.col("event_id")).alias("event_id"), F.col("content_id"), "event_ts", "user_id")
    keys, order = ["event_id", "content_id"], keep.tie_break(["user_id"], [F.desc_nulls_last("event_ts")])
    ours = keep.keep_first_spread(raw, keys, order, hot=hot)
    assert collected(ours) == collected(keep.keep_first(raw, keys, order))
    assert collected(keep.keep_first_spread(raw, keys, order, source=raw.select(*keys).union(raw.select(*keys)), hot=hot)) == collected(ours)


def test_rare_keys_are_sorted_once(spark, events):
    """Where no key is hot, no rows are sorted before the shuffle."""
    rare = events.filter("event_id != 'e-hot'").select("event_id", "user_id", "event_ts")
    ours = keep.keep_first_spread(rare, ["event_id"], keep.tie_break(["user_id", "event_ts"]))
    ours.collect()
    plan = ours._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "lag(" in plan
    assert re.search(r"row_number\(\), 1, Partial\n.*Sort .*\n.*EmptyRelation", plan)


def test_hot_cancel_reason(spark):
    subs = spark.range(0, 30_000, 1, 8).select(
        F.concat(F.lit("P"), F.col("id") % 2).alias("plan_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 1000)).alias("cancel_reason"),
        F.lit(False).alias("is_active"), F.lit(1).alias("duration_days"),
    )
    assert collected(gold.subscription_metrics(subs), "plan_id", "total_subscriptions", "top_cancel_reason") == [("P0", 15_000, "hot"), ("P1", 15_000, "hot")]


def test_genres_split_like_a_regular_expression(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("Ab ,|\t") for _ in range(rng.randrange(12))) for _ in range(400)]
    rows = frame(spark, "t string", *[(t,) for t in texts]).select("t", text.genre_list(F.col("t")).alias("g")).collect()
    for row in rows:
        assert row["g"] == re.split(r"[ \t]*[,|][ \t]*", row["t"]), row["t"]
