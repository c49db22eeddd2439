import datetime as dt
import json

import pytest

from mediaspark import schemas
from mediaspark.jobs import bronze, gold, models, silver, validate
from mediaspark.layout import LakeLayout
from mediaspark.plans import saved
from mediaspark.sources.tables import read_table
from tests.helpers import collected, frame, write_workbook

N = 60


def write_files(folder):
    for name in ("csv", "json", "excel"):
        (folder / name).mkdir(parents=True)
    lines = ["content_id,budget,cast_members,content_rating"] + [f"CNT-{i},{i * 10},A|B,U" for i in range(N)]
    (folder / "csv" / "content_metadata.csv").write_text("\n".join(lines) + "\n")
    events = [
        {"event_id": f"EVT-{i}", "user_id": f"USR-{i % N}", "content_id": f"CNT-{i * 7 % N}", "session_id": f"SES-{i % 90}",
         "event_type": "PLAY", "watch_duration_ms": i * 100, "event_ts": f"2024-01-{i % 28 + 1:02}T19:00:00.000Z"}
        for i in range(N * 10)
    ]
    (folder / "json" / "viewing_events_batch.json").write_text(json.dumps(events))
    write_workbook(folder / "excel" / "ad_campaigns.xlsx", [schemas.CAMPAIGNS.names, ["CAM-1", "One", "USD 5", "2024-01-01", "2024-02-01"], ["CAM-2", "Two", 9, 45292, 45300]], {3, 4})


def database_frames(spark):
    """What the databases would give; the reader itself is tested apart."""
    day, now = dt.date(2023, 1, 1), dt.datetime(2023, 1, 1)
    from decimal import Decimal

    return {
        "users": (frame(spark, schemas.USERS, *[(f"USR-{i}", f"u{i}@x.in", "N", day, "mobile", "iPhone", "India", now) for i in range(N)]), "mysql"),
        "subscriptions": (frame(spark, schemas.SUBSCRIPTIONS, *[
            (f"S{i}", f"USR-{i}", "VIP" if i % 2 else "FREE", day, None if i % 3 else dt.date(2024, 1, 20), None if i % 2 else "price", now) for i in range(N)]), "mysql"),
        "content": (frame(spark, schemas.CONTENT, *[(f"CNT-{i}", f" T{i}", "movie", "Drama|Action", 600, "seconds", 2020, "hi", now) for i in range(N)]), "postgres"),
        "ratings": (frame(spark, schemas.RATINGS, *[(i, f"USR-{i % 10}", f"CNT-{i % 6}", Decimal("4.0"), "app", now, now) for i in range(N)]), "postgres"),
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    write_files(folder / "files")
    layout = LakeLayout(str(folder / "lake"))
    sources = database_frames(spark) | bronze.file_sources(spark, str(folder / "files"))
    counts = {
        "bronze": dict(collected(bronze.run(spark, layout, sources))),
        "silver": dict(collected(silver.run(spark, layout, "2024-01-31"))),
        "gold": dict(collected(gold.run(spark, layout))),
    }
    return layout, counts


EXPECTED = {
    "users": (N, N, "mysql"), "subscriptions": (N, N, "mysql"), "content": (N, N, "postgres"), "ratings": (N, N, "postgres"),
    "content_metadata": (N, N, "csv"), "viewing_events_batch": (N * 10, N * 10, "json"), "campaigns": (2, 2, "excel"),
}


def test_counts_are_of_what_was_written(spark, lake):
    layout, counts = lake
    assert counts["bronze"] == {"users": N, "subscriptions": N, "content": N, "ratings": N, "content_metadata": N, "viewing_events_batch": N * 10, "campaigns": 2}
    assert counts["silver"] == {"users": N, "subscriptions": N, "content_enriched": N, "campaigns": 2, "ratings_clean": 30, "viewing_events": N * 10}
    assert counts["gold"] == {"daily_active_users": 28, "content_watch_metrics": N, "genre_popularity": 2, "user_engagement": N, "subscription_metrics": 2, "content_ratings_summary": 6}
    for layer, tables in counts.items():
        for table, rows in tables.items():
            assert read_table(spark, layout, layer, table).count() == rows


def test_events_are_stored_by_local_day(spark, lake):
    layout, _ = lake
    stored = read_table(spark, layout, "silver", "viewing_events")
    days = collected(stored.select("event_date").distinct())
    assert (dt.date(2024, 1, 2),) in days and (dt.date(2024, 1, 1),) not in days  # 19:00 UTC is the next day in India
    plan = stored.filter("event_date = '2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan[plan.index("PartitionFilters"):]


@pytest.mark.parametrize("layer", validate.LAYERS)
def test_layers_pass_their_checks(spark, lake, layer):
    layout, _ = lake
    results = collected(validate.run(spark, layout, layer, EXPECTED))
    failed = [row for row in results if not row[1]]
    if layer == "bronze":  # no stream has been ingested
        assert [row[0] for row in failed] == ["bronze/viewing_events present"]
    else:
        assert failed == []
    assert any("_SUCCESS" in row[0] for row in results)


def test_checks_of_an_empty_lake_all_fail(spark, tmp_path):
    results = collected(validate.run(spark, LakeLayout(str(tmp_path)), "gold"))
    assert results and not any(passed for _, passed, _ in results)
    with pytest.raises(ValueError):
        validate.run(spark, LakeLayout(str(tmp_path)), "platinum")


def test_runs_may_be_repeated(spark, lake):
    layout, counts = lake
    assert dict(collected(gold.run(spark, layout))) == counts["gold"]


def test_models_write_what_the_saved_queries_read(spark, lake):
    layout, _ = lake
    counts = dict(collected(models.run(spark, layout, "2024-01-31", als_blocks=2)))
    assert counts["user_churn_prediction"] == N and counts["content_popularity_prediction"] == N
    assert counts["user_recommendations"] == N * 10
    names = ("user_churn_prediction", "content_popularity_prediction", "user_recommendations")
    tables = {name: read_table(spark, layout, "gold", name) for name in names}
    assert saved.churn_risk(tables).count() == 15 and saved.churn_risk(tables, by="plan").count() == 2
    assert saved.churn_risk(tables, user_id="USR-7").count() == 1
    assert saved.popularity_predictions(tables).count() == 10
    assert [r["recommendation_rank"] for r in saved.recommendations(tables, "USR-3").collect()] == list(range(1, 11))


def test_all_layers_run_in_order_and_stop_at_a_failed_check(spark, tmp_path):
    from mediaspark.jobs import all_layers

    write_files(tmp_path / "files")
    sources = database_frames(spark) | bronze.file_sources(spark, str(tmp_path / "files"))
    users, tag = sources["users"]
    broken = sources | {"users": (users.withColumn("user_id", users["user_id"].substr(1, 0)).replace("", None, "user_id"), tag)}
    layout = LakeLayout(str(tmp_path / "broken"))
    with pytest.raises(all_layers.ChecksFailed) as caught:
        all_layers.run(spark, layout, broken, "2024-01-31", als_blocks=2)
    assert caught.value.layer == "silver" and caught.value.failed == ["silver/users user_id"]
    assert not (tmp_path / "broken" / "gold").exists()
    written = all_layers.run(spark, LakeLayout(str(tmp_path / "good")), sources, "2024-01-31", als_blocks=2)
    assert list(written) == ["bronze", "silver", "gold", "models"]


def test_lookup_tables_are_sorted_within_their_files(spark, tmp_path):
    import pyarrow.parquet as pq

    from mediaspark.sinks.tables import overwrite

    path = str(tmp_path / "t")
    df = spark.range(5000).selectExpr("concat('USR-', id) as user_id", "id as score").repartition(2)
    assert overwrite(df, path, "parquet", lookup_by=["user_id"]) == 5000
    stored = spark.read.parquet(path)
    assert collected(stored.filter("user_id = 'USR-77'")) == [("USR-77", 77)]
    for file in (tmp_path / "t").glob("*.parquet"):
        ids = pq.read_table(file)["user_id"].to_pylist()
        assert ids == sorted(ids)


def test_questions_are_answered_from_the_tables_of_the_lake(spark, lake):
    from mediaspark.jobs import ask

    layout, _ = lake
    for name in ("top_content", "genre_popularity", "subscriptions", "kpi_overview", "kpi_most_watched", "watch_hours_histogram"):
        assert ask.answer(spark, layout, name).count() > 0, name
    assert ask.answer(spark, layout, "top_content", {"limit": "2"}).count() == 2
    assert ask.answer(spark, layout, "query_analytics", {"sql": "SELECT count(*) AS n FROM genre_popularity"}).first()[0] > 0
    assert ask.answer(spark, layout, "pipeline_health").count() == len(saved.WATCHED_TABLES)
    assert ask.answer(spark, layout, "streaming_traffic", {"dimension": "genre"}).columns == ["genre", "events", "users"]
    with pytest.raises(ValueError, match="no query"):
        ask.answer(spark, layout, "anything")
    with pytest.raises(ValueError, match="may not read"):
        ask.answer(spark, layout, "query_analytics", {"sql": "SELECT * FROM nowhere"})
    empty = LakeLayout(layout.base + "-empty")
    for name, table in (("streaming_traffic", "viewing_events"), ("top_content", "content_watch_metrics")):
        with pytest.raises(ValueError, match=table):
            ask.answer(spark, empty, name)
    path, rows = ask.write_answer(ask.answer(spark, layout, "genre_popularity"), layout, "genre_popularity")
    assert rows == 2 == spark.read.parquet(path).count() and path.startswith(layout.table("answers", ""))


def test_events_as_lines_replace_the_array(spark, tmp_path):
    write_files(tmp_path / "files")
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "1.json").write_text('{"event_id": "e1"}\n{"event_id": "e2"}\n')
    df, _ = bronze.file_sources(spark, str(tmp_path / "files"), f"{tmp_path}/lines")["viewing_events_batch"]
    assert collected(df, "event_id") == [("e1",), ("e2",)]
