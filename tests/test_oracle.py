"""Every registered query against its SQL, and under other session settings."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, open_tables
from checks.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

# Queries without SQL: models and sketches.
NO_SQL = {"ml_churn", "ml_popularity", "ml_recommendations"}


@pytest.fixture(scope="module")
def db():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    fault, _, rows = compare(spark, db, FOLDER, name)
    assert fault is None, fault
    assert rows > 0


def test_only_the_named_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == NO_SQL and set(ORACLES) <= set(QUERIES)


ZONED = [
    "gold_daily_active_users", "gold_user_engagement", "silver_events_dedup", "layers_daily_active_users", "live_traffic_total",
    "live_sliding_from_minutes", "stream_dedup", "stream_traffic_window", "stream_minute_activity", "trace_runs",
]


@pytest.mark.parametrize("zone", ["America/New_York"])
@pytest.mark.parametrize("name", ZONED)
def test_results_do_not_depend_on_the_session_zone(spark, db, name, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        fault, _, _ = compare(spark, db, FOLDER, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert fault is None, fault


UNBROADCAST = [
    "gold_content_watch_metrics", "gold_genre_popularity", "gold_content_ratings_summary", "silver_content_enriched",
    "live_traffic_by_genre", "live_traffic_by_country", "dq_orphans", "ml_user_features", "ml_content_features",
]


@pytest.mark.parametrize("name", UNBROADCAST)
def test_results_do_not_depend_on_broadcasting(spark, db, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        fault, _, _ = compare(spark, db, FOLDER, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert fault is None, fault
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_date", "daily_active_users", "total_views", "total_watch_time_sec"]
    assert df.count() == 30
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
