import datetime as dt

import pytest
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from mediaspark.plans import kpis, saved
from tests.helpers import collected, frame, plan_of

WATCH = "content_id string, title string, content_type string, total_views long, unique_viewers long"


@pytest.mark.parametrize("given,used", [(None, 10), (3, 3), ("7", 7), (50, 50), (51, 51), (500, 500)])
def test_limits(given, used):
    assert saved.row_limit(given) == used


@pytest.mark.parametrize("given", [0, -1, "-5", "many", []])
def test_other_limits_are_refused(given):
    with pytest.raises(ValueError):
        saved.row_limit(given)


def in_order(df):
    return [tuple(row) for row in df.collect()]


def test_top_content_breaks_ties_by_id(spark):
    watch = frame(spark, WATCH, ("c2", "B", "m", 5, 1), ("c1", "A", "m", 5, 2), ("c3", "C", "m", 9, 3), ("c4", "D", "m", None, 0))
    tables = {"content_watch_metrics": watch}
    assert in_order(saved.top_content(tables, 3)) == [("C", "m", 9, 3), ("A", "m", 5, 2), ("B", "m", 5, 1)]
    assert in_order(saved.top_content(tables))[-1] == ("D", "m", None, 0)
    assert "TakeOrderedAndProject" in plan_of(saved.top_content(tables))


def test_content_ratings_needs_five_ratings(spark):
    rated = frame(
        spark, "content_id string, title string, content_type string, avg_rating double, rating_count long",
        ("c1", "A", "m", 4.0, 5), ("c2", "B", "m", 5.0, 4), ("c3", "C", "m", 4.0, 9),
    )
    assert in_order(saved.content_ratings({"content_ratings_summary": rated})) == [("C", "m", 4.0, 9), ("A", "m", 4.0, 5)]


def test_daily_activity_is_the_last_fifteen_days(spark):
    days = spark.range(20).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("event_date"),
        F.col("id").alias("daily_active_users"), F.col("id").alias("total_views"),
    )
    found = in_order(saved.daily_activity({"daily_active_users": days}))
    assert len(found) == 15 and found[0][0] == dt.date(2024, 1, 20) and found[-1][0] == dt.date(2024, 1, 6)


CHURN = "user_id string, plan_id string, subscription_duration_days int, churn_probability double, prediction int"


def test_churn_risk_has_three_forms(spark):
    tables = {"user_churn_prediction": frame(
        spark, CHURN, ("u1", "A", 10, 0.9, 1), ("u2", "A", 20, 0.2, 0), ("u'3", "B", 30, 0.9, 1), ("u4", None, 1, 0.33333, 0)
    )}
    assert in_order(saved.churn_risk(tables, user_id="u'3")) == [("u'3", "B", 30, 0.9, 1)]
    assert in_order(saved.churn_risk(tables, by="PLAN")) == [("B", 1, 1, 0.9), ("A", 2, 1, 0.55), (None, 1, 0, 0.3333)]
    assert [row[0] for row in in_order(saved.churn_risk(tables))] == ["u'3", "u1", "u4", "u2"]


def test_no_match_is_an_empty_result(spark):
    tables = {
        "user_churn_prediction": frame(spark, CHURN, ("u1", "A", 10, 0.9, 1)),
        "user_recommendations": frame(
            spark, "user_id string, recommended_content string, content_type string, recommendation_rank int, score double",
            ("USR-1000001", "B", "m", 2, 0.1), ("USR-1000001", "A", "m", 1, 0.2), ("u2", "C", "m", 1, 0.2),
        ),
    }
    nobody = saved.churn_risk(tables, user_id="nobody' OR '1'='1")
    assert nobody.count() == 0 and nobody.columns[0] == "user_id"
    assert saved.recommendations(tables, "nobody").count() == 0
    assert in_order(saved.recommendations(tables)) == [("A", "m", 1, 0.2), ("B", "m", 2, 0.1)]


def test_pipeline_health(spark):
    tables = {name: spark.range(n) for n, name in enumerate(saved.WATCHED_TABLES)}
    health = saved.pipeline_health(spark, tables)
    assert collected(health) == [(name, n, "OK") for n, name in enumerate(saved.WATCHED_TABLES)]
    assert in_order(saved.overall_health(health)) == [(6, 6, "HEALTHY")]
    del tables["genre_popularity"]
    health = saved.pipeline_health(spark, tables)
    assert ("genre_popularity", 0, "ERROR") in collected(health)
    assert in_order(saved.overall_health(health)) == [(5, 6, "DEGRADED")]


def test_query_analytics_runs_queries_only(spark):
    tables = {"genre_popularity": frame(spark, "genre string, total_views long", ("A", 1), ("B", 2))}
    sql = "  (SELECT genre FROM genre_popularity WHERE total_views > 1)"
    assert in_order(saved.query_analytics(spark, tables, sql)) == [("B",)]
    assert in_order(saved.query_analytics(spark, tables, "WITH t AS (SELECT 1 x) SELECT x FROM t")) == [(1,)]
    ordered = "SELECT genre FROM genre_popularity ORDER BY total_views DESC; -- the most viewed first"
    with pytest.raises(ParseException):
        saved.query_analytics(spark, tables, ordered)  # two statements in one text
    assert in_order(saved.query_analytics(spark, tables, ordered.split("--")[0])) == [("B",), ("A",)]
    assert in_order(saved.query_analytics(spark, tables, ordered.replace(";", ""))) == [("B",), ("A",)]
    for bad in ("DROP VIEW genre_popularity", "insert into genre_popularity values ('C', 3)",
                "WITH t AS (SELECT 'C', 3) INSERT INTO genre_popularity SELECT * FROM t", "CREATE TABLE x AS SELECT 1"):
        with pytest.raises(ParseException):
            saved.query_analytics(spark, tables, bad)
    for none in ("", "  ;"):
        with pytest.raises(ValueError):
            saved.query_analytics(spark, tables, none)


def test_query_analytics_reads_the_given_tables_only(spark, tmp_path):
    tables = {"genres": frame(spark, "genre string", ("A",))}
    frame(spark, "x long", (1,)).write.parquet(f"{tmp_path}/t")
    frame(spark, "x long", (1,)).createOrReplaceTempView("genres")  # the caller's own view of that name
    frame(spark, "x long", (1,)).createOrReplaceTempView("elsewhere")
    for sql in (f"SELECT * FROM parquet.`{tmp_path}/t`", "SELECT * FROM elsewhere", "SELECT (SELECT max(x) FROM elsewhere) FROM genres",
                "WITH t AS (SELECT * FROM elsewhere) SELECT * FROM t"):
        with pytest.raises(ValueError, match="may not read"):
            saved.query_analytics(spark, tables, sql)
    assert in_order(saved.query_analytics(spark, tables, "SELECT genre FROM GENRES WHERE genre IN (SELECT genre FROM genres)")) == [("A",)]
    assert spark.table("genres").columns == ["x"]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("genres_")]


def test_what_a_name_is_resolved_to_is_judged(spark, tmp_path):
    tables = {"ok": frame(spark, "x long", (1,), (2,)), "few": frame(spark, "x long", (1,), (2,)).filter("x = 1")}
    frame(spark, "x long", (7,)).write.parquet(f"{tmp_path}/t")
    spark.read.parquet(f"{tmp_path}/t").createOrReplaceTempView("secret")
    spark.range(3).createOrReplaceTempView("numbers_elsewhere")
    spark.udf.register("shout", lambda x: x)
    for sql in (
        f"SELECT count(*) FROM IDENTIFIER('parquet.`{tmp_path}/t`')",
        "SELECT * FROM IDENTIFIER('secret')",
        "SELECT * FROM IDENTIFIER('se' || 'cret')",
        "SELECT count(*) FROM secret WHERE 1 IN (WITH secret AS (SELECT 1 AS x) SELECT x FROM secret)",
        "SELECT x FROM ok WHERE EXISTS (SELECT 1 FROM numbers_elsewhere WHERE id = x)",
        "SELECT x, (SELECT max(x) FROM secret) AS most FROM ok",
        "SELECT * FROM ok, LATERAL (SELECT max(x) AS most FROM secret)",
        "SELECT x FROM ok UNION ALL SELECT x FROM secret",
        "SELECT * FROM range(10)",
        "SELECT * FROM ok JOIN range(10) ON x = id",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home') FROM ok",
        "SELECT x FROM ok ORDER BY java_method('java.util.UUID', 'randomUUID')",
        "SELECT input_file_name() FROM ok",
        "SELECT shout(x) FROM ok",
        "SELECT * FROM (TABLE secret)",
    ):
        with pytest.raises(ValueError, match="may not read"):
            saved.query_analytics(spark, tables, sql)
    for sql, expected in (
        ("SELECT sum(x) FROM ok WHERE x IN (SELECT x FROM few)", [(1,)]),
        ("WITH t AS (SELECT x FROM ok), u AS (SELECT x + 1 AS y FROM t) SELECT max(y) FROM u JOIN t ON x = y", [(2,)]),
        ("SELECT y FROM ok LATERAL VIEW explode(array(x, x * 10)) AS y WHERE x = 2 ORDER BY y", [(2,), (20,)]),
        ("SELECT a.x FROM ok a JOIN IDENTIFIER('few') b ON a.x = b.x", [(1,)]),
        ("SELECT count(*) FROM (VALUES (1), (2)) v(x) JOIN ok USING (x)", [(2,)]),
        ("SELECT max(x) FROM ok WHERE x > (SELECT min(x) FROM few)", [(2,)]),
        ("WITH ok AS (SELECT 9 AS x) SELECT x FROM ok", [(9,)]),
    ):
        assert in_order(saved.query_analytics(spark, tables, sql)) == expected
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(("ok_", "few_"))]


def test_overview(spark):
    daily = frame(
        spark, "event_date string, daily_active_users long, total_views long, total_watch_time_sec double",
        ("d1", 3, 10, 3600.0), ("d2", 4, 20, 7199.0),
    )
    plans = frame(spark, "plan_id string, active_subscriptions long, cancelled_subscriptions long", ("A", 5, 1), ("B", 6, 2))
    assert in_order(kpis.overview(daily, plans)) == [(30, 3, 2, 11)]
    assert in_order(kpis.timeline(daily)) == [("d1", 3), ("d2", 4)]
    assert collected(kpis.plan_status(plans)) == [
        ("A", "Active", 5), ("A", "Cancelled", 1), ("B", "Active", 6), ("B", "Cancelled", 2)
    ]
    assert list(kpis.to_client(plans)["plan_id"]) == ["A", "B"] and len(kpis.to_client(plans, most=2)) == 2
    with pytest.raises(ValueError, match="too many"):
        kpis.to_client(plans, most=1)


def test_charts(spark):
    rated = frame(
        spark, "content_id string, title string, content_type string, avg_rating string, rating_count string",
        ("c1", "T" * 40, "m", "4.5", "5"), ("c2", "B", "m", "n/a", "9"), ("c3", "C", "m", "5.0", "x"), ("c4", "D", "m", "4.6", "5"),
    )
    assert in_order(kpis.best_rated(rated)) == [("c4", "D", "D", 4.6), ("c1", "T" * 40, "T" * 30, 4.5), ("c2", "B", "B", None)]
    genres = frame(spark, "genre string, total_views long", *[(f"g{i:02}", i % 3) for i in range(12)])
    assert [row[0] for row in in_order(kpis.genre_shares(genres))][:5] == ["g02", "g05", "g08", "g11", "g01"]
    assert kpis.genre_shares(genres).count() == 10
    users = frame(spark, "user_id string, country string", ("a", "IN"), ("b", "IN"), ("c", "US"), ("d", None), ("e", "UK"))
    assert in_order(kpis.users_by(users, "country")) == [("IN", 2), ("UK", 1), ("US", 1)]


def test_histogram_keeps_every_user(spark):
    engagement = spark.range(101).select((F.col("id") * 3600.0).alias("total_watch_time_sec"))
    found = in_order(kpis.watch_hours_histogram(engagement))
    assert found == [(bin_, 2) for bin_ in range(1, 50)] + [(50, 3)]
    same = frame(spark, "total_watch_time_sec double", (5.0,), (5.0,), (None,))
    assert in_order(kpis.watch_hours_histogram(same)) == [(1, 2)]
    plan = plan_of(kpis.watch_hours_histogram(engagement))
    assert "Subquery" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
