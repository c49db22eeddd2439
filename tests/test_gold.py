import datetime as dt

import pytest

from mediaspark.operators import gold
from tests.helpers import collected, frame, plan_of

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
EVENTS = "event_id string, user_id string, content_id string, session_id string, watch_duration_sec double, event_date date"
CONTENT = "content_id string, title string, content_type string, genre_array array<string>"


@pytest.fixture(scope="module")
def events(spark):
    return frame(
        spark, EVENTS,
        ("e1", "u1", "c1", "s1", 10.0, D1),
        ("e2", "u1", "c1", "s1", 20.0, D1),
        ("e3", "u2", "c1", None, None, D1),
        ("e4", "u2", "c2", None, 5.0, D2),
        ("e5", None, "c2", "s9", 1.0, D2),
        ("e6", "u1", "nowhere", "s2", 100.0, D2),
        ("e7", "u1", None, "s2", 100.0, None),
    )


@pytest.fixture(scope="module")
def content(spark):
    return frame(
        spark, CONTENT,
        ("c1", "Sea", "movie", ["Drama", "Action"]),
        ("c2", "Sky", "movie", ["Drama", "Drama"]),
        ("c3", "Sun", "movie", ["Comedy"]),
        ("c4", "Ice", "movie", None),
    )


def test_daily_active_users(events):
    assert collected(gold.daily_active_users(events).drop("_gold_processed_at")) == sorted([
        (D1, 2, 3, 30.0), (D2, 2, 3, 106.0), (None, 1, 1, 100.0),
    ], key=repr)


def test_content_watch_metrics(events, content):
    out = gold.content_watch_metrics(events, content)
    assert out.columns == [
        "content_id", "title", "content_type", "total_views", "unique_viewers", "total_watch_time_sec",
        "avg_watch_time_sec", "_gold_processed_at",
    ]
    assert collected(out.drop("_gold_processed_at")) == [
        ("c1", "Sea", "movie", 3, 2, 30.0, 15.0), ("c2", "Sky", "movie", 2, 1, 6.0, 3.0),
    ]


def test_repeated_titles_weigh_as_in_a_plain_join(spark, events, content):
    twice = content.unionByName(content.filter("content_id = 'c1'")).unionByName(
        frame(spark, CONTENT, ("c1", "Sea (new)", "movie", ["Drama"]))
    )
    plain = events.join(twice, "content_id").groupBy("content_id", "title", "content_type").agg({"*": "count", "watch_duration_sec": "sum"})
    ours = gold.content_watch_metrics(events, twice)
    assert collected(ours, "content_id", "title", "content_type", "total_views", "total_watch_time_sec") == collected(
        plain, "content_id", "title", "content_type", "count(1)", "sum(watch_duration_sec)"
    )


def test_genre_popularity_gives_every_genre_full_credit(events, content):
    assert collected(gold.genre_popularity(events, content).drop("_gold_processed_at")) == [
        ("Action", 3, 2, 30.0), ("Drama", 3 + 2 * 2, 2, 30.0 + 2 * 6.0),
    ]


def test_user_engagement(events):
    assert collected(gold.user_engagement(events).drop("_gold_processed_at")) == sorted([
        ("u1", 2, 4, 230.0, 115.0, 2), ("u2", 0, 2, 5.0, None, 2), (None, 1, 1, 1.0, 1.0, 1),
    ], key=repr)


SUBS = "plan_id string, cancel_reason string, is_active boolean, duration_days int"


def test_subscription_metrics(spark):
    subs = frame(
        spark, SUBS,
        ("A", "price", False, 10), ("A", "bugs", False, 20), ("A", "active", True, None), ("A", "active", False, 3),
        ("A", "active", False, 3), ("A", "active", False, 4), ("B", "active", True, 7), ("B", "late reason", True, 7),
        (None, "price", False, 1), ("C", "active", False, None),
    )
    out = gold.subscription_metrics(subs).drop("_gold_processed_at")
    assert collected(out) == sorted([
        ("A", 6, 1, 5, 8.0, "bugs"),  # a tie goes to the first by name; 'active' is no reason
        ("B", 2, 2, 0, 7.0, None),
        ("C", 1, 0, 1, None, None),
        (None, 1, 0, 1, 1.0, None),  # a null plan has no top reason
    ], key=repr)


def test_content_ratings_summary_averages_doubles(spark, content):
    values = frame(
        spark, "content_id string, v double", ("c1", 4.5), ("c1", 2.0), ("c1", 2.0), ("c3", 5.0), ("gone", 1.0)
    )
    ratings = values.selectExpr("content_id", "cast(v as decimal(2,1)) as rating_value")
    out = gold.content_ratings_summary(ratings, content)
    assert dict(out.dtypes)["avg_rating"] == "double"
    assert collected(out.drop("_gold_processed_at")) == [
        ("c1", "Sea", "movie", 8.5 / 3, 3, 2.0, 4.5), ("c3", "Sun", "movie", 5.0, 1, 5.0, 5.0),
    ]


def test_facts_are_aggregated_before_they_are_joined(spark, events, content):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a catalogue too large to broadcast
    try:
        for out in (gold.content_watch_metrics(events, content), gold.genre_popularity(events, content)):
            plan = plan_of(out)
            join = plan.index("SortMergeJoin")
            facts = plan[join:]
            assert facts.index("HashAggregate") < facts.index("Scan")
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        wide = collected(gold.content_watch_metrics(events, content).drop("_gold_processed_at"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert wide == collected(gold.content_watch_metrics(events, content).drop("_gold_processed_at"))


def test_empty_facts_give_empty_marts(events, content):
    none = events.limit(0)
    for out in (gold.daily_active_users(none), gold.content_watch_metrics(none, content), gold.genre_popularity(none, content), gold.user_engagement(none)):
        assert out.count() == 0
