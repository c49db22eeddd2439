import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from mediaspark.layout import LakeLayout
from mediaspark.operators import silver
from mediaspark.plans import traffic
from mediaspark.sources.messages import read_message_files, topic_options
from mediaspark.sources.tables import read_if_present, read_table
from mediaspark.streaming import ingest, live
from tests.helpers import collected, frame

START = dt.datetime(2024, 3, 1, 12, 0, 0)


def message(offset, event_id, minute, user="u1", title="c1", **extra):
    when = (START + dt.timedelta(minutes=minute)).isoformat() + "Z"
    body = {"event_id": event_id, "user_id": user, "content_id": title, "event_type": "PLAY", "watch_duration_ms": 1000, "event_ts": when}
    return {"value": json.dumps(body | extra), "partition": offset % 3, "offset": offset}


def drop(folder, name, messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, messages)))


@pytest.fixture()
def lake(tmp_path):
    return LakeLayout(str(tmp_path / "lake"))


def finish(query):
    query.awaitTermination(120)
    assert not query.isActive
    return query


def test_ingest_appends_each_drop_once(spark, tmp_path, lake):
    inbox = tmp_path / "in"
    first = [message(0, "e1", 0, new_field=1), {"value": "{broken", "partition": 1, "offset": 1}, {"value": None, "partition": 2, "offset": 2}]
    drop(inbox, "1.json", first)
    query = finish(ingest.start_ingest(read_message_files(spark, str(inbox)), lake, once=True))
    metrics = query.lastProgress["observedMetrics"] if isinstance(query.lastProgress, dict) else query.lastProgress.observedMetrics
    seen = metrics[ingest.PROGRESS]
    assert (seen["rows"], seen["rejected"]) == (3, 2)
    second = [message(3, "e1", 0), message(4, "e2", 1)]
    drop(inbox, "2.json", second)
    finish(ingest.start_ingest(read_message_files(spark, str(inbox)), lake, once=True))
    finish(ingest.start_ingest(read_message_files(spark, str(inbox)), lake, once=True))  # nothing new
    table = read_table(spark, lake, "bronze", ingest.TABLE)
    assert collected(table, "event_id", "_kafka_partition", "_kafka_offset", "_source") == [
        ("e1", 0, 0, "kafka"), (None, 1, 1, "kafka"), (None, 2, 2, "kafka"), ("e1", 0, 3, "kafka"), ("e2", 1, 4, "kafka"),
    ]
    batch = ingest.parse_viewing_events(spark.read.schema("value string, partition int, offset long").json(str(inbox)))
    assert collected(batch.drop("_ingested_at")) == collected(table.drop("_ingested_at"))
    clean = silver.events(table.limit(0), read_if_present(spark, lake, "bronze", ingest.TABLE))
    assert collected(clean, "event_id") == [("e1",), ("e2",)]


def test_rejected_messages_are_kept_with_their_reason(spark, tmp_path, lake):
    inbox = tmp_path / "in"
    bodies = ["{broken", None, "", "[1, 2]", "7", '{"other": 1}', "{}", '{"event_id": "e9", "watch_duration_ms": "long"}']
    drop(inbox, "1.json", [message(0, "e1", 0), *({"value": v, "partition": 1, "offset": i} for i, v in enumerate(bodies))])
    start = lambda: finish(ingest.start_split_ingest(read_message_files(spark, str(inbox)), lake, once=True))
    start()
    drop(inbox, "2.json", [message(20, "e2", 1)])
    start()
    start()
    events, rejected = (read_table(spark, lake, "bronze", t) for t in (ingest.TABLE, ingest.REJECTED))
    assert collected(events, "event_id", "watch_duration_ms", "_kafka_offset") == [("e1", 1000, 0), ("e2", 1000, 20), ("e9", None, 7)]
    assert collected(rejected, "offset", "reason", "value") == [
        (0, "no JSON object", "{broken"), (1, "no value", None), (2, "no JSON object", ""), (3, "no JSON object", "[1, 2]"), (4, "no JSON object", "7"),
        (5, "no known field", '{"other": 1}'), (6, "no known field", "{}"),
    ]
    ingest.split_batch(spark.read.schema("value string, partition int, offset long").json(f"{inbox}/2.json"), 1, layout=lake)  # the batch again
    assert read_table(spark, lake, "bronze", ingest.TABLE).count() == 3


def test_topic_options():
    plain = topic_options("h:1", "t")
    assert plain["startingOffsets"] == "earliest" and plain["maxOffsetsPerTrigger"] == "5000000" and "startingTimestamp" not in plain
    since = topic_options("h:1", "t", since=dt.datetime(2024, 1, 1, tzinfo=dt.UTC), max_per_trigger=None, min_partitions=7)
    assert since["startingTimestamp"] == "1704067200000" and since["minPartitions"] == "7" and "maxOffsetsPerTrigger" not in since
    with pytest.raises(ValueError, match="zone"):
        topic_options("h:1", "t", since=dt.datetime(2024, 1, 1))


def test_binary_messages_are_parsed(spark):
    raw = frame(spark, "value binary, partition int, offset long", (bytearray(b'{"event_id": "e1"}'), 0, 7))
    assert collected(ingest.parse_viewing_events(raw), "event_id", "_kafka_offset") == [("e1", 7)]


def stream_of(spark, inbox):
    return live.timed(ingest.parse_viewing_events(read_message_files(spark, str(inbox))))


def run(spark, df, lake, name):
    finish(ingest.start_append(df, lake.bronze(name), lake.checkpoint(name), lake.fmt, once=True))
    return spark.read.parquet(lake.bronze(name))


@pytest.mark.parametrize("spread", [None, 4])
def test_repeats_are_dropped_across_drops(spark, tmp_path, lake, spread):
    inbox = tmp_path / "in"

    def single():
        over = None if spread is None else F.col("_kafka_offset") % spread
        return live.without_repeats(stream_of(spark, inbox), spread=over)

    drop(inbox, "1.json", [message(0, "e1", 0), message(1, "e1", 0), message(2, "e2", 1)])
    run(spark, single(), lake, "single")
    drop(inbox, "2.json", [message(3, "e2", 1), message(4, "e3", 2), {"value": "junk", "partition": 0, "offset": 5}])
    result = run(spark, single(), lake, "single")
    assert collected(result, "event_id") == [("e1",), ("e2",), ("e3",)]


EVENTS = [message(i, f"e{i}", minute, user) for i, (minute, user) in enumerate(
    [(0, "a"), (0.5, "a"), (4, "b"), (11, "a"), (12, "c"), (12.5, "c"), (25, "b"), (31, "a"), (90, "z")]
)]


def windows_by_hand(length, events=EVENTS):
    """Every window, one a minute: its end, events and users."""
    placed = {}
    for body in (json.loads(m["value"]) for m in events):
        at = int((dt.datetime.fromisoformat(body["event_ts"][:-1]) - START).total_seconds() // 60)
        for end in range(at + 1, at + length + 1):
            placed.setdefault(end, []).append(body["user_id"])
    return sorted((end, len(users), len(set(users))) for end, users in placed.items())


MINUTE = f"CAST((unix_seconds(window_end) - {int(START.replace(tzinfo=dt.UTC).timestamp())}) DIV 60 AS INT)"


def traffic_of(spark, inbox, tables, content=None, sketches=False):
    finish(live.start_traffic(stream_of(spark, inbox), tables, content=content, sketches=sketches, once=True))


@pytest.mark.parametrize("order", ["as sent", "late ones last", "one by one"])
def test_live_windows_match_a_count_by_hand(spark, tmp_path, lake, order):
    inbox, tables = tmp_path / "in", live.Traffic(lake, "all", length=10)
    drops = {"as sent": [EVENTS[:4], EVENTS[4:]], "late ones last": [EVENTS[5:], EVENTS[:2], EVENTS[2:5]], "one by one": [[e] for e in EVENTS[:5]]}[order]
    for i, drop_ in enumerate(drops):
        drop(inbox, f"{i}.json", drop_)
        traffic_of(spark, inbox, tables)
    sent = [e for d in drops for e in d]
    expected = windows_by_hand(10, sent)
    assert sorted(collected(tables.windows(spark).selectExpr(MINUTE, "events", "users"))) == expected
    for since, until in ((0, 12), (5, 15), (11, 30), (40, 95)):
        at = [START.replace(tzinfo=dt.UTC) + dt.timedelta(minutes=m) for m in (since, until)]
        part = tables.windows_between(spark, *at).selectExpr(MINUTE, "events", "users")
        assert sorted(collected(part)) == [w for w in expected if since < w[0] <= until]


def test_live_windows_by_dimension_equal_a_roll_up_of_all(spark, tmp_path, lake):
    rng = random.Random(3)
    inbox, tables = tmp_path / "in", live.Traffic(lake, "device", ("device_category",), length=7)
    for go in range(3):
        drop(inbox, f"{go}.json", [message(i, f"e{go}-{i}", rng.randrange(90), rng.choice("abcd"), device_category=rng.choice([None, "tv", "web"])) for i in range(60)])
        traffic_of(spark, inbox, tables)
    everything = live.timed(ingest.parse_viewing_events(spark.read.schema("value string, partition int, offset long").json(str(inbox))))
    whole = traffic.sliding_from_minutes(live.minute_counts(everything, ["device_category"]), ["device_category"], minutes=7)
    key = lambda df: sorted(map(repr, df.select("window_end", "device_category", "events", "users").collect()))
    assert key(tables.windows(spark)) == key(whole)


def test_a_batch_that_is_run_again_replaces_its_own_rows(spark, lake):
    tables = live.Traffic(lake, "again", length=10)
    times = lambda *minutes: spark.createDataFrame([(START + dt.timedelta(minutes=m), "u") for m in minutes], "event_ts timestamp, user_id string")
    live.take_traffic(times(0, 3), 0, tables=tables)
    live.take_traffic(times(8, 30), 1, tables=tables)
    once = collected(tables.windows(spark))
    live.take_traffic(times(8, 30), 1, tables=tables)
    assert collected(tables.windows(spark)) == once
    live.take_traffic(times(), 2, tables=tables)
    assert collected(tables.windows(spark)) == once


@pytest.mark.parametrize("picked, times", [(0, 10), (0, 0), (1_000, 10)])
def test_batches_of_any_size_add_up_to_the_whole(spark, lake, monkeypatch, picked, times):
    """Large batches meet all stored minutes, others those of their users; all equal windows over all events."""
    monkeypatch.setattr(live, "MOST_PICKED", picked)
    monkeypatch.setattr(live, "PICKED_FROM", times)
    rng, tables = random.Random(5), live.Traffic(lake, "genre", ("genre",), length=6)
    content = frame(spark, "content_id string, genre_array array<string>", ("c1", ["A", "B"]), ("c2", ["B", "B"]), ("c3", None), ("c2", ["C"]))
    rows = [(START + dt.timedelta(minutes=rng.randrange(60)), rng.choice(["u", "v", "w", None]), rng.choice(["c1", "c2", "c3", "c4"]), n % 3) for n in range(150)]
    events = spark.createDataFrame(rows, "event_ts timestamp, user_id string, content_id string, go int")
    for batch in range(3):
        live.take_traffic(events.filter(F.col("go") == batch), batch, tables=tables, content=content)
    placed = events.join(content, "content_id").select("*", F.explode("genre_array").alias("genre"), F.explode(F.sequence(F.lit(1), F.lit(6))).alias("n"))
    window_end = F.date_trunc("minute", "event_ts") + F.make_dt_interval(mins=F.col("n"))
    expected = placed.groupBy(window_end.alias("window_end"), "genre").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"))
    assert collected(tables.windows(spark).select(expected.columns)) == collected(expected)


def test_changes_shuffle_and_sort_the_rows_of_users_once(spark):
    activity = spark.range(100).selectExpr("timestamp_seconds(id * 60) AS minute", "id % 3 AS user_id", "id % 2 AS genre", "1L AS events")
    for stored in (None, activity.limit(50)):
        changes = traffic.activity_changes(activity, ["genre"], stored=stored)
        plan = changes._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[-1]
        assert plan.count("Window [") == 1
        assert plan.count("Exchange hashpartitioning") == 2 and "hashpartitioning(minute" not in plan


def test_estimates_are_near_the_exact_numbers(spark, lake):
    rng = random.Random(4)
    rows = [(START + dt.timedelta(minutes=rng.randrange(20)), rng.randrange(4_000)) for _ in range(10_000)]
    events, tables = spark.createDataFrame(rows, "event_ts timestamp, user_id long"), live.Traffic(lake, "sketch", length=10)
    for batch in range(2):
        live.take_traffic(events.filter(F.col("user_id") % 2 == batch), batch, tables=tables, sketches=True)
    exact = {r.window_end: (r.events, r.users) for r in traffic.sliding_from_minutes(live.minute_counts(events), minutes=10).collect()}
    found = {r.window_end: (r.events, r.users) for r in tables.estimates(spark).collect()}
    assert found.keys() == exact.keys() and all(found[k][0] == exact[k][0] for k in exact)
    assert all(abs(found[k][1] - exact[k][1]) <= max(1, 0.05 * exact[k][1]) for k in exact)


def test_no_estimate_of_many_strays(spark, lake):
    tables = live.Traffic(lake, "many", length=1)
    events = spark.range(400 * 4_000).select(F.timestamp_seconds(1_700_000_000 + (F.col("id") % 400) * 60).alias("event_ts"), F.col("id").alias("user_id"))
    live.take_traffic(events, 0, tables=tables, sketches=True)
    low, high, windows = tables.estimates(spark).agg(F.min("users"), F.max("users"), F.count(F.lit(1))).first()
    assert windows == 400 and 3_860 <= low and high <= 4_140


def test_only_days_and_minutes_within_reach_are_read(spark, lake):
    tables = live.Traffic(lake, "days")
    far = spark.range(96).select(F.timestamp_seconds(F.col("id") * 3600 + 1_700_000_000).alias("event_ts"), F.lit("u").alias("user_id"))
    live.take_traffic(far, 0, tables=tables)
    live.take_traffic(far.limit(0), 1, tables=tables)
    counts = live.minute_counts(far.limit(1).withColumn("event_ts", F.timestamp_seconds(F.lit(1_700_040_000))))
    plan = live._affected(spark, tables, 2, counts)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters"):]
    assert "day" in scan[: scan.index("]")] and "GreaterThanOrEqual(minute" in scan and "CartesianProduct" not in plan


def test_late_events_are_left_out_of_closed_windows(spark, tmp_path, lake):
    inbox = tmp_path / "in"
    drop(inbox, "1.json", EVENTS)  # the watermark moves to minute 80
    run(spark, live.minute_activity(stream_of(spark, inbox)), lake, "m")
    drop(inbox, "2.json", [message(50, "late", 1, "a"), message(51, "later", 200, "a")])
    result = run(spark, live.minute_activity(stream_of(spark, inbox)), lake, "m")
    minute = F.minute("minute") + F.hour("minute") * 60
    first = result.agg(F.min(minute)).first()[0]
    found = collected(result.select(minute - first, "user_id", "events"))
    assert found == [(0, "a", 2), (4, "b", 1), (11, "a", 1), (12, "c", 2), (25, "b", 1), (31, "a", 1), (90, "z", 1)]


def test_stream_is_joined_to_titles(spark, tmp_path, lake):
    inbox, tables = tmp_path / "in", live.Traffic(lake, "genre", ("genre",), length=2)
    content = frame(spark, "content_id string, genre_array array<string>", ("c1", ["A", "B"]), ("c2", ["B"]))
    drop(inbox, "1.json", [message(0, "e1", 0, "a", "c1"), message(1, "e2", 1, "b", "c2")])
    traffic_of(spark, inbox, tables, content)
    drop(inbox, "2.json", [message(2, "e3", 1, "b", "gone"), message(3, "e4", 0, "a", "c2")])
    traffic_of(spark, inbox, tables, content)
    found = tables.windows(spark).selectExpr(MINUTE, "genre", "events", "users")
    assert collected(found) == [(1, "A", 1, 1), (1, "B", 2, 1), (2, "A", 1, 1), (2, "B", 3, 2), (3, "B", 1, 1)]


def test_the_stream_job_keeps_live_tables(spark, tmp_path, lake):
    from mediaspark.jobs import stream
    from mediaspark.sinks.tables import overwrite

    inbox = tmp_path / "in"
    overwrite(frame(spark, "content_id string, genre_array array<string>", ("c1", ["A", "B"])), lake.silver("content_enriched"), lake.fmt)
    drop(inbox, "1.json", [*EVENTS[:3], {"value": "{broken", "partition": 1, "offset": 100}])
    for query in stream.start(spark, read_message_files(spark, str(inbox)), lake, with_live=True, once=True):
        finish(query)
    assert read_table(spark, lake, "bronze", ingest.TABLE).count() == 4
    tables = stream.live_tables(lake)
    whole = collected(tables["all"].windows(spark))
    assert len(whole) == 34 and [row[3] for row in collected(tables["genre"].windows(spark).filter("genre = 'B'"))] == [row[2] for row in whole]
    assert collected(tables["device"].windows(spark).select("device_category").distinct()) == [(None,)]


def test_interrupt_stops_the_query():
    class Query:
        stopped = False

        def awaitTermination(self):
            raise KeyboardInterrupt

        def stop(self):
            self.stopped = True

    query = Query()
    ingest.run_until_stopped(query)
    assert query.stopped
