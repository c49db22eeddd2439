import datetime as dt
import json

import pytest

from mediaspark import schemas
from mediaspark.layout import Database, LakeLayout, mysql, path_exists, postgres
from mediaspark.plans import layer_checks, questions, traces
from mediaspark.sinks.tables import compact, overwrite
from mediaspark.sources import files, jdbc, workbook
from mediaspark.sources.tables import read_if_present, read_table, with_source
from tests.helpers import collected, frame, plan_of, write_workbook


def test_layout():
    lake = LakeLayout("s3://bucket/lake/", "delta")
    assert lake.silver("users") == "s3a://bucket/lake/silver/users"
    assert lake.checkpoint("x") == "s3a://bucket/lake/checkpoints/x"
    assert LakeLayout("/data").bronze("t") == "/data/bronze/t"


def test_database_properties():
    db = mysql("h", "d", "me", "secret")
    assert db.url == "jdbc:mysql://h:3306/d" and "secret" not in repr(db)
    assert db.properties() == {
        "driver": "com.mysql.cj.jdbc.Driver", "user": "me", "password": "secret", "fetchsize": "10000", "useCursorFetch": "true",
    }
    assert postgres("h", "d", "me", "p", 1).url == "jdbc:postgresql://h:1/d"
    assert Database("u", "drv", options={"fetchsize": "100"}).properties() == {"driver": "drv", "fetchsize": "100"}


class Reader:
    """Stands in for the session's reader and notes how it is called."""

    def __init__(self, bounds):
        self.bounds, self.calls = bounds, []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self

    def select(self, *_):
        return self

    def first(self):
        return self.bounds


@pytest.mark.parametrize("bounds,parallel", [(("1", "900"), True), ((None, None), False)])
def test_database_reads_are_split_by_the_bounds_found(spark, bounds, parallel):
    reader = Reader(bounds)
    jdbc.read_database_table(reader, Database("u", "d"), "ratings", jdbc.Split("rating_id", 8))
    asked, read = reader.calls
    assert "MIN(rating_id)" in asked[0] and "MAX(rating_id)" in asked[0]
    if parallel:
        assert read[1]["lowerBound"] == "1" and read[1]["upperBound"] == "900" and read[1]["numPartitions"] == 8
    else:
        assert "numPartitions" not in read[1]


def test_database_reads_with_given_bounds_ask_nothing(spark):
    reader = Reader(None)
    jdbc.read_database_table(reader, Database("u", "d"), "users", jdbc.Split("created_at", 4, "2020-01-01", "2026-01-01"))
    jdbc.read_database_table(reader, Database("u", "d"), "users")
    assert [call[0] for call in reader.calls] == ["users", "users"] and "column" not in reader.calls[1][1]


def test_users_and_titles_are_split_by_a_hash_of_their_ids():
    reader = Reader(None)
    for source, url in ((jdbc.USERS, "jdbc:mysql://h/d"), (jdbc.CONTENT, "jdbc:postgresql://h/d")):
        jdbc.read_database_table(reader, Database(url, "d"), source.table, source.split(4))
        conditions = reader.calls[-1][1]["predicates"]
        assert len(conditions) == 4 and source.split_column in conditions[3] and "IS NULL" in conditions[0]
    assert jdbc.HashSplit("k", 2).conditions("jdbc:other:x") == ["1 = 1"]
    assert jdbc.RATINGS.split(3) == jdbc.Split("rating_id", 3)


def test_csv(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("content_id,budget,cast_members,content_rating\nC1,3000000000,A|B,U\nC2,,,\n")
    df = files.read_content_metadata(spark, str(path))
    assert df.schema["budget"].dataType.simpleString() == "bigint"
    assert collected(df) == [("C1", 3000000000, "A|B", "U"), ("C2", None, None, None)]


def test_json_array_and_lines(spark, tmp_path):
    rows = [{"event_id": "e1", "watch_duration_ms": 5, "event_ts": "2024-01-01T00:00:00Z", "extra": 1}, {"event_id": "e2"}]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "l.json").write_text("\n".join(map(json.dumps, rows)))
    wanted = [("e1", 5, "2024-01-01T00:00:00Z"), ("e2", None, None)]
    for name, lines in (("a.json", False), ("l.json", True)):
        df = files.read_viewing_events(spark, str(tmp_path / name), lines=lines)
        assert df.columns == schemas.VIEWING_EVENT.names
        assert collected(df, "event_id", "watch_duration_ms", "event_ts") == wanted


def test_workbooks(spark, tmp_path):
    header = ["campaign_id", "campaign_name", "budget", "start_date", "end_date", "note"]
    write_workbook(
        tmp_path / "a.xlsx",
        [header, ["CAM-1", "One", 5000000, 45292, 45300, "x"], ["CAM-2", "Two & a half".replace("&", "and"), "USD 12345", 45292, None, None],
         [None] * 6, ["CAM-3", None, 12.5, "2024-02-01", None, None]],
        date_columns={3, 4},
    )
    write_workbook(tmp_path / "b.xlsx", [["budget", "campaign_id"], [7, "CAM-9"]])
    write_workbook(tmp_path / "c.xlsx", [header])
    df = workbook.read_workbooks(spark, str(tmp_path))
    assert df.schema.names == schemas.CAMPAIGNS.names
    assert collected(df) == [
        ("CAM-1", "One", "5000000", "2024-01-01", "2024-01-09"),
        ("CAM-2", "Two and a half", "USD 12345", "2024-01-01", None),
        ("CAM-3", None, "12.5", "2024-02-01", None),
        ("CAM-9", None, "7", None, None),
    ]


def test_large_workbook_comes_in_batches(spark, tmp_path):
    n = workbook.BATCH_ROWS * 2 + 3
    write_workbook(tmp_path / "big.xlsx", [["campaign_id", "budget"]] + [[f"CAM-{i}", i] for i in range(n)])
    df = workbook.read_workbooks(spark, str(tmp_path / "big.xlsx"))
    assert df.selectExpr("count(*)", "count(distinct campaign_id)", "sum(bigint(budget))").first() == (n, n, n * (n - 1) // 2)


def test_reviews_and_thumbnails(spark, tmp_path):
    reviews, thumbs = tmp_path / "reviews", tmp_path / "thumbs"
    reviews.mkdir()
    thumbs.mkdir()
    (reviews / "USR-1_CNT-000002_2024-05-06.txt").write_text("Good.\n\nVery good.\nReally.")
    (reviews / "odd.txt").write_text("x")
    (reviews / "readme.md").write_text("no review")
    for name in ("CNT-1_v1.jpg", "CNT-1_v2.jpg", "CNT-2_v1.jpg"):
        (thumbs / name).write_bytes(b"123")
    assert collected(files.read_reviews(spark, str(reviews))) == [
        ("USR-1", "CNT-000002", dt.date(2024, 5, 6), ["Good.", "Very good.\nReally."]), (None, None, None, ["x"]),
    ]
    images = files.read_thumbnails(spark, str(thumbs))
    assert collected(images) == [("CNT-1", 1, 3), ("CNT-1", 2, 3), ("CNT-2", 1, 3)]
    assert "content#" not in plan_of(images)
    assert collected(files.thumbnail_versions(images)) == [("CNT-1", 2, 6), ("CNT-2", 1, 3)]
    metadata = frame(spark, schemas.CONTENT_METADATA, ("c", 1, "a", "U"))
    found = layer_checks.file_profile(metadata, spark.read.json(spark.sparkContext.emptyRDD(), schemas.VIEWING_EVENT), files.read_reviews(spark, str(reviews)), images)
    assert dict(collected(found, "name", "passed")) == {
        "source content_metadata": False, "source viewing events": False, "source viewing events have all keys": True,
        "source reviews": False, "source thumbnails": False,
    }


def test_writes_count_their_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    path = str(tmp_path / "t")
    assert overwrite(spark.range(1000).mapInPandas(count, "id long"), path, "parquet") == 1000
    assert seen.value == 1000  # the rows were computed once
    assert overwrite(spark.range(5), path, "parquet") == 5
    assert spark.read.parquet(path).count() == 5
    assert overwrite(spark.range(0), path, "parquet") == 0


def test_partitioned_writes_and_compaction(spark, tmp_path):
    df = spark.range(3000).selectExpr("id", "if(id < 2000, 'hot', 'cold') as day").repartition(30)
    path, packed = str(tmp_path / "t"), str(tmp_path / "packed")
    assert overwrite(df, path, "parquet", ["day"]) == 3000
    assert len(list((tmp_path / "t").glob("day=*/*.parquet"))) <= 4
    df.write.parquet(str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("*.parquet"))) == 30
    assert compact(spark, str(tmp_path / "many"), packed, "parquet") == 3000
    assert len(list((tmp_path / "packed").glob("*.parquet"))) == 1


def test_optional_tables(spark, tmp_path):
    lake = LakeLayout(str(tmp_path))
    assert read_if_present(spark, lake, "bronze", "none") is None and not path_exists(spark, lake.bronze("none"))
    overwrite(with_source(spark.range(2), "csv"), lake.bronze("t"), lake.fmt)
    assert read_if_present(spark, lake, "bronze", "t").count() == 2
    assert read_table(spark, lake, "bronze", "t").columns == ["id", "_ingested_at", "_source"]
    (tmp_path / "bronze" / "broken").mkdir()
    with pytest.raises(Exception):
        read_if_present(spark, lake, "bronze", "broken")  # a fault, not an absence


def test_questions(spark):
    asked = frame(
        spark, "id int, question string",
        (1, "What are the TOP trending shows?"), (2, "genres please"), (3, "Which plan do people cancel?"), (4, "hello"),
        (5, None), (6, "Is the pipeline healthy, any data quality issue?"), (7, "popularity prediction"), (8, "live rating"),
    )
    assert collected(questions.route(asked), "id", "topic", "score") == [
        (1, "top_content", 2), (2, "genre_popularity", 2), (3, "subscriptions", 2), (4, "query_analytics", 0),
        (5, "query_analytics", 0), (6, "pipeline_health", 4), (7, "top_content", 1), (8, "content_ratings", 1),
    ]
    assert "Join" not in plan_of(questions.route(asked))


def test_traces(spark, tmp_path):
    def step(kind, title, index, tool="", ms=0, status="ok"):
        return {"kind": kind, "title": title, "detail": "", "tool_name": tool, "tool_args": {"limit": 5}, "sql": "",
                "duration_ms": ms, "status": status, "step_index": index}

    runs = {
        "a.json": [step("thought", "t", 1), step("tool_call", "dau", 1, "dau"), step("observation", "dau result", 1, ms=17),
                   step("final", "Answer ready", 2)],
        "b.json": [step("tool_call", "dau", 1, "dau"), step("observation", "dau result", 1, ms=3, status="error"),
                   step("fallback", "using rules", 2, status="fallback"), step("tool_call", "top_content", 2, "top_content"),
                   step("observation", "top_content result", 2, ms=1), step("final", "Answer ready", 3)],
    }
    for name, steps in runs.items():
        (tmp_path / name).write_text(json.dumps(steps))
    steps = files.read_traces(spark, str(tmp_path))
    assert collected(traces.tool_usage(steps)) == [("dau", 2, 2, 0.5, 10.0, 17), ("top_content", 1, 1, 0.0, 1.0, 1)]
    summary = traces.run_summary(steps)
    assert collected(summary) == [("a.json", 2, 1, 17, False), ("b.json", 3, 2, 4, True)]
    assert collected(traces.run_overview(summary)) == [(2, 2.5, 1.5, 0.5)]


def test_connections_come_from_a_file(tmp_path):
    from mediaspark.jobs import bronze

    path = tmp_path / "databases.json"
    path.write_text(json.dumps({"mysql": {"url": "u", "driver": "d", "user": "me", "password": "p", "options": {"fetchsize": "5"}}}))
    assert bronze.read_databases(str(path))["mysql"].properties() == {"driver": "d", "fetchsize": "5", "user": "me", "password": "p"}


def test_database_tables_feed_their_bronze_tables(spark):
    from mediaspark.jobs import bronze

    reader = Reader(("1", "9"))
    databases = {"mysql": Database("my", "d"), "postgres": Database("pg", "d")}
    sources = bronze.database_sources(reader, databases, 4)
    assert {name: tag for name, (_, tag) in sources.items()} == {"users": "mysql", "subscriptions": "mysql", "content": "postgres", "ratings": "postgres"}
    assert [call[0] for call in reader.calls if not call[0].startswith("(")] == ["users", "subscriptions", "content_catalogue", "ratings"]
