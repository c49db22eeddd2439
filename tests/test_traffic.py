import datetime as dt

import pytest
from pyspark.sql import functions as F

from mediaspark.plans import traffic
from tests.helpers import collected, frame, optimized_plan_of

NOW = dt.datetime(2024, 5, 1, 12, 0, 0)
EVENTS = "event_ts timestamp, user_id string, content_id string, watch_duration_sec double, event_date date, city string"


def minutes(n, user, title="c1", city="X", watched=10.0):
    when = NOW - dt.timedelta(minutes=n)
    return (when, user, title, watched, when.date(), city)


@pytest.fixture(scope="module")
def events(spark):
    return frame(
        spark, EVENTS,
        minutes(0, "u1"), minutes(0.5, "u1", watched=None), minutes(1, "u2", "c2"), minutes(4, "u2", "c2", None),
        minutes(29.9, "u3", "c1", "Y", 40.0), minutes(30, "u4"), minutes(31, "u5"), minutes(-5, "u6", "c3", "Y"),
    )


def test_totals(events):
    assert collected(traffic.totals(events, NOW)) == [(6, 4, 3, (10 * 4 + 40) / 5, 3, 5)]


def test_by_dimension(events):
    assert collected(traffic.by_dimension(events, "city", NOW)) == [("X", 3, 2), ("Y", 2, 2), (None, 1, 1)]


def test_by_genre_and_country(spark, events):
    content = frame(spark, "content_id string, genre_array array<string>", ("c1", ["A", "B"]), ("c2", ["B"]))
    assert collected(traffic.by_genre(events, content, NOW)) == [("A", 3, 2), ("B", 5, 3)]
    users = frame(spark, "user_id string, country string", ("u1", "IN"), ("u2", "IN"), ("u3", "US"))
    assert collected(traffic.by_country(events, users, NOW)) == [("IN", 4, 2), ("US", 1, 1)]


def test_streaming_traffic_chooses_by_dimension(spark, events):
    content = frame(spark, "content_id string, genre_array array<string>", ("c1", ["A"]))
    assert collected(traffic.streaming_traffic(events, as_of=NOW)) == collected(traffic.totals(events, NOW))
    assert collected(traffic.streaming_traffic(events, "city", as_of=NOW)) == collected(traffic.by_dimension(events, "city", NOW))
    assert collected(traffic.streaming_traffic(events, "genre", content=content, as_of=NOW)) == [("A", 3, 2)]
    with pytest.raises(ValueError):
        traffic.streaming_traffic(events, "genre", as_of=NOW)


def test_nothing_recent_is_a_row_of_zeros(events):
    later = NOW + dt.timedelta(days=3)
    assert collected(traffic.totals(events, later)) == [(0, 0, 0, None, 0, 0)]
    assert traffic.by_dimension(events, "city", later).count() == 0


def test_time_filter_prunes_days(spark, events, tmp_path):
    path = str(tmp_path / "events")
    events.write.partitionBy("event_date").parquet(path)
    stored = spark.read.parquet(path)
    plan = traffic.totals(stored, NOW)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert "event_date" in filters[: filters.index("]")]
    assert collected(traffic.totals(stored, NOW)) == collected(traffic.totals(events, NOW))
    assert "Cartesian" not in optimized_plan_of(traffic.totals(stored, NOW))


def test_sliding_windows_from_minutes(spark):
    activity = frame(
        spark, "minute timestamp, user_id string, events long",
        (dt.datetime(2024, 1, 1, 0, 0), "a", 2), (dt.datetime(2024, 1, 1, 0, 1), "a", 1), (dt.datetime(2024, 1, 1, 0, 2), "b", 1),
    )
    found = collected(traffic.sliding_from_minutes(activity, minutes=2), "window_end", "events", "users")
    assert found == [
        (dt.datetime(2024, 1, 1, 0, 1), 2, 1), (dt.datetime(2024, 1, 1, 0, 2), 3, 1),
        (dt.datetime(2024, 1, 1, 0, 3), 2, 2), (dt.datetime(2024, 1, 1, 0, 4), 1, 1),
    ]
