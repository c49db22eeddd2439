"""Every registered query: a Spark function of (session, folder), and SQL where SQL can say it.

Dates and times are shown as text and sums rounded, so that both engines print alike.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import standins as s
from mediaspark.functions import temporal
from mediaspark.jobs import ask as ask_job
from mediaspark.jobs import bronze as bronze_job
from mediaspark.jobs import gold as gold_job
from mediaspark.jobs import increments
from mediaspark.jobs import silver as silver_job
from mediaspark.jobs import validate as validate_job
from mediaspark.layout import LakeLayout
from mediaspark.ml import churn, features, forest, popularity, products, recommend
from mediaspark.operators import gold, quality, silver
from mediaspark.plans import kpis, layer_checks, questions, saved, traces, traffic
from mediaspark.session import shared_folder
from mediaspark.sinks.measures import read_measures
from mediaspark.sinks.tables import append, overwrite
from mediaspark.sources import files
from mediaspark.sources.tables import read_table, with_source
from mediaspark.streaming import ingest, live

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def shown(df: DataFrame, **places: int) -> DataFrame:
    """Drop audit columns, show dates as text and round the named columns."""
    columns = []
    for name, kind in df.dtypes:
        if name.endswith("_processed_at") or name == "_ingested_at":
            continue
        column = F.col(name)
        if name in places:
            column = F.round(column, places[name])
        elif kind in ("date", "timestamp_ntz"):
            column = column.cast("string")
        elif kind == "timestamp":
            column = temporal.wall_clock(column, "UTC").cast("string")
        elif kind.startswith("array"):
            column = F.array_join(column, "|")
        columns.append(column.alias(name))
    return df.select(*columns)


# ---- marts ---------------------------------------------------------------------------

DAILY_SQL = f"""
    SELECT event_date, count(DISTINCT user_id) AS daily_active_users, count(*) AS total_views,
           sum(watch_duration_sec) AS total_watch_time_sec
    FROM ({s.VIEWING_EVENTS_SQL}) GROUP BY event_date"""
WATCH_SQL = f"""
    SELECT content_id, title, content_type, count(*) AS total_views, count(DISTINCT user_id) AS unique_viewers,
           sum(watch_duration_sec) AS total_watch_time_sec, avg(watch_duration_sec) AS avg_watch_time_sec
    FROM ({s.VIEWING_EVENTS_SQL}) JOIN ({s.CONTENT_SQL}) USING (content_id) GROUP BY content_id, title, content_type"""
GENRE_SQL = f"""
    SELECT genre, count(*) AS total_views, count(DISTINCT user_id) AS unique_viewers,
           sum(watch_duration_sec) AS total_watch_time_sec
    FROM ({s.VIEWING_EVENTS_SQL}) JOIN (SELECT content_id, unnest(genre_array) AS genre FROM ({s.CONTENT_SQL})) USING (content_id)
    GROUP BY genre"""
ENGAGEMENT_SQL = f"""
    SELECT user_id, count(DISTINCT session_id) AS total_sessions, count(*) AS total_views,
           sum(watch_duration_sec) AS total_watch_time_sec,
           sum(watch_duration_sec) / nullif(count(DISTINCT session_id), 0) AS avg_session_watch_sec,
           count(DISTINCT content_id) AS distinct_content_watched
    FROM ({s.VIEWING_EVENTS_SQL}) GROUP BY user_id"""
PLANS_SQL = f"""
    SELECT p.plan_id, total_subscriptions, active_subscriptions, cancelled_subscriptions, avg_duration_days, top_cancel_reason
    FROM (SELECT plan_id, count(*) AS total_subscriptions, count(*) FILTER (WHERE is_active) AS active_subscriptions,
                 count(*) FILTER (WHERE NOT is_active) AS cancelled_subscriptions, avg(duration_days) AS avg_duration_days
          FROM ({s.SILVER_SUBSCRIPTIONS_SQL}) GROUP BY plan_id) p
    LEFT JOIN (SELECT plan_id, cancel_reason AS top_cancel_reason FROM (
                 SELECT plan_id, cancel_reason, row_number() OVER (PARTITION BY plan_id ORDER BY count(*) DESC, cancel_reason) AS rn
                 FROM ({s.SILVER_SUBSCRIPTIONS_SQL}) WHERE NOT is_active AND cancel_reason <> 'active'
                 GROUP BY plan_id, cancel_reason) WHERE rn = 1) r ON p.plan_id = r.plan_id"""
RATED_SQL = f"""
    SELECT content_id, title, content_type, avg(CAST(rating_value AS DOUBLE)) AS avg_rating, count(*) AS rating_count,
           CAST(min(rating_value) AS DOUBLE) AS min_rating, CAST(max(rating_value) AS DOUBLE) AS max_rating
    FROM ({s.SILVER_RATINGS_SQL}) JOIN ({s.CONTENT_SQL}) USING (content_id) GROUP BY content_id, title, content_type"""


@query("gold_daily_active_users", f"""
    SELECT CAST(event_date AS VARCHAR) AS event_date, daily_active_users, total_views,
           round(total_watch_time_sec, 2) AS total_watch_time_sec FROM ({DAILY_SQL})""")
def gold_daily_active_users(spark, folder):
    return shown(s.daily(spark, folder), total_watch_time_sec=2)


@query("gold_content_watch_metrics", f"""
    SELECT content_id, title, content_type, total_views, unique_viewers,
           round(total_watch_time_sec, 2) AS total_watch_time_sec, round(avg_watch_time_sec, 9) AS avg_watch_time_sec
    FROM ({WATCH_SQL})""")
def gold_content_watch_metrics(spark, folder):
    return shown(s.watch(spark, folder), total_watch_time_sec=2, avg_watch_time_sec=9)


@query("gold_genre_popularity", f"""
    SELECT genre, total_views, unique_viewers, round(total_watch_time_sec, 2) AS total_watch_time_sec FROM ({GENRE_SQL})""")
def gold_genre_popularity(spark, folder):
    return shown(s.genres(spark, folder), total_watch_time_sec=2)


@query("gold_user_engagement", f"""
    SELECT user_id, total_sessions, total_views, round(total_watch_time_sec, 2) AS total_watch_time_sec,
           round(avg_session_watch_sec, 9) AS avg_session_watch_sec, distinct_content_watched FROM ({ENGAGEMENT_SQL})""")
def gold_user_engagement(spark, folder):
    return shown(s.engagement(spark, folder), total_watch_time_sec=2, avg_session_watch_sec=9)


@query("gold_subscription_metrics", f"""
    SELECT plan_id, total_subscriptions, active_subscriptions, cancelled_subscriptions,
           round(avg_duration_days, 9) AS avg_duration_days, top_cancel_reason FROM ({PLANS_SQL})""")
def gold_subscription_metrics(spark, folder):
    return shown(s.plans(spark, folder), avg_duration_days=9)


@query("gold_cancel_reasons", f"""
    SELECT plan_id, cancel_reason, count(*) AS subscriptions, count(*) FILTER (WHERE is_active) AS active,
           count(*) FILTER (WHERE NOT is_active) AS cancelled, CAST(sum(duration_days) AS BIGINT) AS days, count(duration_days) AS dated
    FROM ({s.SILVER_SUBSCRIPTIONS_SQL}) GROUP BY plan_id, cancel_reason""")
def gold_cancel_reasons(spark, folder):
    return gold.cancel_reasons(s.silver_subscriptions(spark, folder))


@query("gold_content_ratings_summary", f"""
    SELECT content_id, title, content_type, round(avg_rating, 9) AS avg_rating, rating_count, min_rating, max_rating
    FROM ({RATED_SQL})""")
def gold_content_ratings_summary(spark, folder):
    return shown(s.rated(spark, folder), avg_rating=9)


@query("gold_viewer_titles", f"""
    SELECT content_id, user_id, count(*) AS views, round(sum(watch_duration_sec), 2) AS watch_sec,
           count(watch_duration_sec) AS timed_views FROM ({s.VIEWING_EVENTS_SQL}) GROUP BY content_id, user_id""")
def gold_viewer_titles(spark, folder):
    return shown(gold.viewer_titles(s.viewing_events(spark, folder)), watch_sec=2)


# ---- cleaning ------------------------------------------------------------------------


@query("silver_users_device_os", rf"""
    SELECT user_id, email, regexp_matches(email, '^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,}}$') AS is_valid_email,
           full_name, CAST(signup_date AS VARCHAR) AS signup_date, device_category,
           CASE WHEN regexp_matches(user_agent, '(?i)iphone|ios') THEN 'iOS' WHEN regexp_matches(user_agent, '(?i)android') THEN 'Android'
                WHEN regexp_matches(user_agent, '(?i)windows') THEN 'Windows' WHEN regexp_matches(user_agent, '(?i)macintosh|mac os') THEN 'macOS'
                WHEN regexp_matches(user_agent, '(?i)linux|tizen') THEN 'Linux' ELSE 'Other' END AS device_os,
           upper(country) AS country
    FROM ({s.USERS_SQL})""")
def silver_users_device_os(spark, folder):
    return shown(silver.users(s.users(spark, folder)).drop("created_at"))


@query("silver_subscriptions_duration", f"""
    SELECT subscription_id, user_id, plan_id, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
           cancel_reason, is_active, duration_days FROM ({s.SILVER_SUBSCRIPTIONS_SQL})""")
def silver_subscriptions_duration(spark, folder):
    return shown(s.silver_subscriptions(spark, folder).drop("created_at"))


@query("silver_content_enriched", rf"""
    SELECT c.content_id, trim(title, ' ') AS title, content_type,
           array_to_string(regexp_split_to_array(genre, '\s*[,|]\s*'), '|') AS genre_array,
           CAST(CASE WHEN runtime_unit = 'seconds' THEN trunc(runtime_value / 60) ELSE runtime_value END AS INTEGER) AS runtime_minutes,
           release_year, language, budget, cast_members, content_rating
    FROM ({s.CATALOGUE_SQL}) c
    LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY budget NULLS FIRST,
                 cast_members NULLS FIRST, content_rating NULLS FIRST) AS rn FROM ({s.METADATA_SQL})) WHERE rn = 1) m
    ON c.content_id = m.content_id""")
def silver_content_enriched(spark, folder):
    return shown(silver.content(s.catalogue(spark, folder), s.metadata(spark, folder)).drop("created_at"))


@query("silver_content_every_metadata_row", f"""
    SELECT c.content_id, trim(title, ' ') AS title, budget, content_rating
    FROM ({s.CATALOGUE_SQL}) c LEFT JOIN ({s.METADATA_SQL}) m ON c.content_id = m.content_id""")
def silver_content_every_metadata_row(spark, folder):
    return silver.content(s.catalogue(spark, folder), s.metadata(spark, folder), one_metadata_row=False).select(
        "content_id", "title", "budget", "content_rating"
    )


@query("silver_ratings_latest", f"""
    SELECT rating_id, user_id, content_id, CAST(rating_value AS DOUBLE) AS rating_value, rating_source,
           CAST(rated_at AS VARCHAR) AS rated_at FROM ({s.SILVER_RATINGS_SQL})""")
def silver_ratings_latest(spark, folder):
    df = silver.ratings(s.ratings(spark, folder))
    return shown(df.withColumn("rating_value", F.col("rating_value").cast("double")))


@query("silver_events_dedup", f"""
    SELECT event_id, user_id, content_id, session_id, device_category, event_type, watch_duration_ms, watch_duration_sec,
           seek_position_ms, CAST(event_ts AS VARCHAR) AS event_ts, CAST(session_start_ts AS VARCHAR) AS session_start_ts,
           CAST(event_date AS VARCHAR) AS event_date, referrer FROM ({s.SILVER_EVENTS_SQL})""")
def silver_events_dedup(spark, folder):
    return shown(s.silver_events_pipeline(spark, folder))


def _incremented(spark, folder):
    """The silver table after two runs over new files: first the second copies of half of the events, then the rest.

    Later files hold earlier copies of stored events and, a day's end away, some in another day; the third run finds none.
    """
    layout, events = _shared_layout(spark), s.read(spark, folder, "events")
    half = F.col("event_id") % 2 == 0
    append(s.bronze_events(events.filter(half), 1), layout.bronze("viewing_events"), layout.fmt)
    increments.run(spark, layout, s.ZONE)
    append(s.bronze_events(events, 0), layout.bronze("viewing_events_batch"), layout.fmt)
    append(s.bronze_events(events.filter(~half), 1), layout.bronze("viewing_events"), layout.fmt)
    increments.run(spark, layout, s.ZONE)
    increments.run(spark, layout, s.ZONE)
    return layout


@query("silver_events_incremental", ORACLES["silver_events_dedup"])
def silver_events_incremental(spark, folder):
    stored = read_table(spark, _incremented(spark, folder), "silver", increments.TABLE)
    return shown(stored.select(*[c for c in stored.columns if c != "event_date"], "event_date"))


@query("silver_increments", """
    WITH e AS (SELECT event_id % 2 = 0 AS even, event_id % 10 AS k FROM events)
    SELECT 'viewing_events' AS source, 0 AS batch, count(*) FILTER (even) AS taken, count(*) FILTER (even AND k <> 4) AS added, 0 AS removed FROM e
    UNION ALL SELECT 'viewing_events_batch', 0, count(*), count(*) FILTER (k <> 3), count(*) FILTER (even AND k <> 4) FROM e
    UNION ALL SELECT 'viewing_events', 1, count(*) FILTER (NOT even), count(*) FILTER (k = 3), 0 FROM e""")
def silver_increments(spark, folder):
    """What each increment read (by the ledger of files, none twice), added and removed."""
    layout = _incremented(spark, folder)
    ledger, log = (read_table(spark, layout, "silver", t) for t in (increments.LEDGER, increments.LOG))
    once = ledger.groupBy("file").agg(F.min("source").alias("source"), F.min("batch").alias("batch"), F.max("rows").alias("rows"))
    read = once.groupBy("source", "batch").agg(F.sum("rows").alias("taken"))
    number = F.substring_index("batch", "_", 1).cast("int").alias("batch")
    return log.join(read, ["source", "batch"]).select("source", number, "taken", "added", "removed")


@query("silver_campaign_budget", r"""
    SELECT campaign_id, campaign_name,
           TRY_CAST(CASE WHEN regexp_matches(budget, '^[A-Za-z]') THEN regexp_extract(budget, '(\d+)$', 1)
                         ELSE regexp_replace(budget, '\.\d*$', '') END AS BIGINT) AS budget_amount,
           CASE WHEN regexp_matches(budget, '^[A-Za-z]') THEN regexp_extract(budget, '^([A-Za-z]+)', 1) ELSE 'INR' END AS budget_currency,
           CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
           CAST(end_date - start_date AS INTEGER) AS campaign_duration_days
    FROM (""" + s.CAMPAIGNS_SQL + ")")
def silver_campaign_budget(spark, folder):
    return shown(silver.campaigns(s.campaigns(spark, folder)))


@query("layers_daily_active_users", f"""
    SELECT CAST(event_date AS VARCHAR) AS event_date, count(DISTINCT user_id) AS daily_active_users, count(*) AS total_views,
           round(sum(watch_duration_sec), 2) AS total_watch_time_sec FROM ({s.SILVER_EVENTS_SQL}) GROUP BY event_date""")
def layers_daily_active_users(spark, folder):
    """Bronze to gold in one plan: parse, deduplicate, cut dates in the service's zone, aggregate."""
    return shown(gold.daily_active_users(s.silver_events_pipeline(spark, folder)), total_watch_time_sec=2)


# ---- saved queries -------------------------------------------------------------------


@query("top_content", f"""
    SELECT title, content_type, total_views, unique_viewers FROM ({WATCH_SQL})
    ORDER BY total_views DESC NULLS LAST, content_id LIMIT 10""")
def top_content(spark, folder):
    return saved.top_content({"content_watch_metrics": s.watch(spark, folder)})


@query("top_content_500", f"""
    SELECT title, content_type, total_views, unique_viewers FROM ({WATCH_SQL})
    ORDER BY total_views DESC NULLS LAST, content_id LIMIT 500""")
def top_content_500(spark, folder):
    return saved.top_content({"content_watch_metrics": s.watch(spark, folder)}, limit=500)


@query("genre_top10", f"""
    SELECT genre, total_views, unique_viewers FROM ({GENRE_SQL}) ORDER BY total_views DESC NULLS LAST, genre LIMIT 10""")
def genre_top10(spark, folder):
    return saved.genre_popularity({"genre_popularity": s.genres(spark, folder)})


@query("top_rated", f"""
    SELECT title, content_type, round(avg_rating, 9) AS avg_rating, rating_count FROM ({RATED_SQL}) WHERE rating_count >= 5
    ORDER BY avg_rating DESC NULLS LAST, rating_count DESC NULLS LAST, content_id LIMIT 10""")
def top_rated(spark, folder):
    return shown(saved.content_ratings({"content_ratings_summary": s.rated(spark, folder)}), avg_rating=9)


@query("plans_by_total", f"""
    SELECT plan_id, total_subscriptions, active_subscriptions, cancelled_subscriptions, top_cancel_reason FROM ({PLANS_SQL})
    ORDER BY total_subscriptions DESC NULLS LAST, plan_id""")
def plans_by_total(spark, folder):
    return saved.subscriptions({"subscription_metrics": s.plans(spark, folder)})


@query("dau_last15", f"""
    SELECT CAST(event_date AS VARCHAR) AS event_date, daily_active_users, total_views FROM ({DAILY_SQL})
    ORDER BY event_date DESC NULLS LAST LIMIT 15""")
def dau_last15(spark, folder):
    return shown(saved.daily_activity({"daily_active_users": s.daily(spark, folder)}))


@query("popularity_top10", f"""
    SELECT title, primary_genre, total_views, round(popularity_probability, 6) AS popularity_probability, prediction
    FROM ({s.POPULARITY_SQL}) ORDER BY popularity_probability DESC NULLS LAST, content_id LIMIT 10""")
def popularity_top10(spark, folder):
    tables = {"content_popularity_prediction": s.popularity_scores(spark, folder)}
    return shown(saved.popularity_predictions(tables), popularity_probability=6)


@query("recommendations_of_user", f"""
    SELECT recommended_content, content_type, recommendation_rank, score FROM ({s.RECOMMENDED_SQL})
    WHERE user_id = 'USR-1000001' ORDER BY recommendation_rank LIMIT 10""")
def recommendations_of_user(spark, folder):
    return saved.recommendations({"user_recommendations": s.recommended(spark, folder)})


@query("churn_of_user", f"""
    SELECT * FROM ({s.CHURN_SQL}) WHERE user_id = 'USR-1000042' LIMIT 1""")
def churn_of_user(spark, folder):
    return saved.churn_risk({"user_churn_prediction": s.churn_scores(spark, folder)}, user_id="USR-1000042")


@query("churn_by_plan", f"""
    SELECT plan_id, count(*) AS total_users, count(*) FILTER (WHERE prediction = 1) AS predicted_churners,
           round(avg(churn_probability), 4) AS avg_churn_prob FROM ({s.CHURN_SQL})
    GROUP BY plan_id ORDER BY avg_churn_prob DESC NULLS LAST, plan_id""")
def churn_by_plan(spark, folder):
    return saved.churn_risk({"user_churn_prediction": s.churn_scores(spark, folder)}, by="plan")


@query("churn_riskiest", f"""
    SELECT user_id, plan_id, churn_probability, prediction FROM ({s.CHURN_SQL})
    ORDER BY churn_probability DESC NULLS LAST, user_id LIMIT 15""")
def churn_riskiest(spark, folder):
    return saved.churn_risk({"user_churn_prediction": s.churn_scores(spark, folder)})


HEALTH_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", count(*) AS "rows", 'OK' AS status FROM ({sql})"""
    for name, sql in (
        ("daily_active_users", DAILY_SQL),
        ("content_watch_metrics", WATCH_SQL),
        ("genre_popularity", GENRE_SQL),
        ("subscription_metrics", PLANS_SQL),
        ("content_ratings_summary", RATED_SQL),
    )
) + """ UNION ALL SELECT 'user_churn_prediction', 0, 'ERROR'"""


def _health(spark, folder):
    tables = {
        "daily_active_users": s.daily(spark, folder),
        "content_watch_metrics": s.watch(spark, folder),
        "genre_popularity": s.genres(spark, folder),
        "subscription_metrics": s.plans(spark, folder),
        "content_ratings_summary": s.rated(spark, folder),
    }
    return saved.pipeline_health(spark, tables)


@query("tables_health", HEALTH_SQL)
def tables_health(spark, folder):
    """The prediction table is not given, so its line is an error."""
    return _health(spark, folder)


@query("tables_health_overall", f"""
    SELECT count(*) FILTER (WHERE status = 'OK') AS tables_ok, count(*) AS "tables",
           CASE WHEN count(*) FILTER (WHERE status = 'OK') = count(*) THEN 'HEALTHY' ELSE 'DEGRADED' END AS overall
    FROM ({HEALTH_SQL})""")
def tables_health_overall(spark, folder):
    return saved.overall_health(_health(spark, folder))


@query("query_analytics", f"""
    SELECT content_type, CAST(sum(total_views) AS BIGINT) AS views, max(unique_viewers) AS widest
    FROM ({WATCH_SQL}) GROUP BY content_type""")
def query_analytics(spark, folder):
    tables = {"content_watch_metrics": s.watch(spark, folder)}
    return saved.query_analytics(
        spark,
        tables,
        "SELECT content_type, sum(total_views) AS views, max(unique_viewers) AS widest "
        "FROM content_watch_metrics GROUP BY content_type",
    )


# ---- live traffic (batch) ------------------------------------------------------------

WIDE = 3 * 24 * 60
SINCE = f"""(SELECT *, max(event_ts) OVER () AS as_of FROM ({s.VIEWING_EVENTS_SQL})) WHERE event_ts > as_of - INTERVAL {WIDE} MINUTE"""


def _live(spark, folder):
    """Events, and their last time as a subquery of the same plan."""
    events = s.viewing_events(spark, folder)
    return events, events.agg(F.max("event_ts").cast("timestamp_ntz")).scalar()


TOTALS_SQL = f"""
    SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_users, count(DISTINCT content_id) AS unique_content,
           round(avg(watch_duration_sec), 9) AS avg_watch_sec,
           count(*) FILTER (WHERE event_ts > as_of - INTERVAL 1 MINUTE) AS events_last_min,
           count(*) FILTER (WHERE event_ts > as_of - INTERVAL 5 MINUTE) AS events_last_5min FROM """


@query("live_traffic_total", TOTALS_SQL + SINCE.replace(f"INTERVAL {WIDE} MINUTE", "INTERVAL 30 MINUTE"))
def live_traffic_total(spark, folder):
    return shown(traffic.totals(*_live(spark, folder)), avg_watch_sec=9)


@query("live_traffic_total_wide", TOTALS_SQL + SINCE)
def live_traffic_total_wide(spark, folder):
    return shown(traffic.totals(*_live(spark, folder), minutes=WIDE), avg_watch_sec=9)


@query("live_traffic_by_dimension", f"""
    SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM {SINCE}
    GROUP BY event_type ORDER BY events DESC, event_type LIMIT 10""")
def live_traffic_by_dimension(spark, folder):
    events, as_of = _live(spark, folder)
    return traffic.by_dimension(events, "event_type", as_of, WIDE)


@query("live_traffic_by_genre", f"""
    SELECT genre, count(*) AS events, count(DISTINCT user_id) AS users
    FROM (SELECT * FROM {SINCE}) JOIN (SELECT content_id, unnest(genre_array) AS genre FROM ({s.CONTENT_SQL})) USING (content_id)
    GROUP BY genre ORDER BY events DESC, genre LIMIT 10""")
def live_traffic_by_genre(spark, folder):
    events, as_of = _live(spark, folder)
    return traffic.by_genre(events, s.content(spark, folder), as_of, WIDE)


@query("live_traffic_by_country", f"""
    SELECT country, count(*) AS events, count(DISTINCT user_id) AS users
    FROM (SELECT * FROM {SINCE}) JOIN (SELECT c_custkey AS user_id, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey) USING (user_id)
    GROUP BY country ORDER BY events DESC, country LIMIT 10""")
def live_traffic_by_country(spark, folder):
    events, as_of = _live(spark, folder)
    nation = s.read(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    users = s.read(spark, folder, "customer").join(nation, "c_nationkey").select(F.col("c_custkey").alias("user_id"), "country")
    return traffic.by_country(events, users, as_of, WIDE)


def _windows_sql(length: int, slide: int) -> str:
    """Sliding windows of ``length`` minutes every ``slide``."""
    steps = length // slide
    return f"""
    SELECT CAST(window_end - INTERVAL {length} MINUTE AS VARCHAR) AS window_start, CAST(window_end AS VARCHAR) AS window_end,
           count(*) AS events, count(DISTINCT user_id) AS users
    FROM (SELECT user_id, time_bucket(INTERVAL {slide} MINUTE, ts) + INTERVAL ({slide}) MINUTE * n AS window_end
          FROM events, range(1, {steps + 1}) r(n)) GROUP BY window_end"""


@query("live_sliding_from_minutes", _windows_sql(30, 1))
def live_sliding_from_minutes(spark, folder):
    """Exact sliding windows rolled up from the per-minute table."""
    events = s.viewing_events(spark, folder)
    activity = events.groupBy(F.date_trunc("minute", "event_ts").cast("timestamp_ntz").alias("minute"), "user_id").agg(
        F.count(F.lit(1)).alias("events")
    )
    return shown(traffic.sliding_from_minutes(activity))


# ---- dashboard -----------------------------------------------------------------------


@query("kpi_overview", f"""
    SELECT CAST(sum(total_views) AS BIGINT) AS total_views, CAST(trunc(avg(daily_active_users)) AS BIGINT) AS avg_daily_active_users,
           CAST(trunc(sum(total_watch_time_sec) / 3600) AS BIGINT) AS total_watch_hours,
           (SELECT CAST(sum(active_subscriptions) AS BIGINT) FROM ({PLANS_SQL})) AS active_subscriptions FROM ({DAILY_SQL})""")
def kpi_overview(spark, folder):
    return kpis.overview(s.daily(spark, folder), s.plans(spark, folder))


@query("kpi_timeline", f"SELECT CAST(event_date AS VARCHAR) AS event_date, daily_active_users FROM ({DAILY_SQL}) ORDER BY 1")
def kpi_timeline(spark, folder):
    return shown(kpis.timeline(s.daily(spark, folder)))


@query("kpi_genre_shares", f"SELECT genre, total_views FROM ({GENRE_SQL}) ORDER BY total_views DESC NULLS LAST, genre LIMIT 10")
def kpi_genre_shares(spark, folder):
    return kpis.genre_shares(s.genres(spark, folder))


@query("kpi_most_watched", f"""
    SELECT content_id, title, substr(title, 1, 30) AS short_title, total_views FROM ({WATCH_SQL})
    ORDER BY total_views DESC NULLS LAST, content_id LIMIT 15""")
def kpi_most_watched(spark, folder):
    return kpis.most_watched(s.watch(spark, folder))


@query("kpi_best_rated", f"""
    SELECT content_id, title, substr(title, 1, 30) AS short_title, round(avg_rating, 9) AS avg_rating FROM ({RATED_SQL})
    WHERE rating_count >= 5 ORDER BY r.avg_rating DESC NULLS LAST, content_id LIMIT 15""".replace(f"FROM ({RATED_SQL})", f"FROM ({RATED_SQL}) r"))
def kpi_best_rated(spark, folder):
    return shown(kpis.best_rated(s.rated(spark, folder)), avg_rating=9)


@query("kpi_plan_status", f"""
    SELECT plan_id, 'Active' AS status, active_subscriptions AS subscriptions FROM ({PLANS_SQL})
    UNION ALL SELECT plan_id, 'Cancelled', cancelled_subscriptions FROM ({PLANS_SQL})""")
def kpi_plan_status(spark, folder):
    return kpis.plan_status(s.plans(spark, folder))


@query("users_by_country", f"""
    SELECT upper(country) AS country, count(*) AS users FROM ({s.USERS_SQL}) WHERE country IS NOT NULL
    GROUP BY 1 ORDER BY users DESC, country""")
def users_by_country(spark, folder):
    return kpis.users_by(silver.users(s.users(spark, folder)), "country")


@query("users_by_device", f"""
    SELECT device_category, count(*) AS users FROM ({s.USERS_SQL}) WHERE device_category IS NOT NULL
    GROUP BY 1 ORDER BY users DESC, device_category""")
def users_by_device(spark, folder):
    return kpis.users_by(silver.users(s.users(spark, folder)), "device_category")


@query("watch_hours_histogram", f"""
    SELECT CAST(CASE WHEN lo = hi THEN 1 ELSE greatest(least(floor((hours - lo) / (hi - lo) * 50) + 1, 50), 1) END AS INTEGER) AS bin,
           count(*) AS users
    FROM (SELECT hours, min(hours) OVER () AS lo, max(hours) OVER () AS hi
          FROM (SELECT total_watch_time_sec / 3600 AS hours FROM ({ENGAGEMENT_SQL}) WHERE total_watch_time_sec IS NOT NULL))
    GROUP BY 1 ORDER BY 1""")
def watch_hours_histogram(spark, folder):
    return kpis.watch_hours_histogram(s.engagement(spark, folder))


# ---- quality -------------------------------------------------------------------------


@query("dq_duplicates", """
    SELECT l_suppkey AS user_id, l_partkey AS content_id, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_duplicates(spark, folder):
    return quality.duplicate_keys(s.ratings(spark, folder), "user_id", "content_id")


@query("dq_null_counts", " UNION ALL ".join(
    f"SELECT '{column}' AS column_name, count(*) - count({column}) AS nulls FROM ({s.SILVER_EVENTS_SQL})"
    for column in ("event_id", "session_id", "watch_duration_ms", "seek_position_ms", "event_ts", "session_start_ts")))
def dq_null_counts(spark, folder):
    columns = ("event_id", "session_id", "watch_duration_ms", "seek_position_ms", "event_ts", "session_start_ts")
    return quality.null_counts(s.silver_events_pipeline(spark, folder), columns)


@query("dq_orphans", f"""
    SELECT count(*) FILTER (WHERE o_custkey IN (SELECT user_id FROM events)) AS matched,
           count(*) FILTER (WHERE o_custkey NOT IN (SELECT user_id FROM events)) AS orphans,
           count(*) FILTER (WHERE o_custkey IS NULL) AS without_key FROM orders""")
def dq_orphans(spark, folder):
    """Subscriptions of users who have watched anything."""
    return quality.references(s.subscriptions(spark, folder), s.viewing_events(spark, folder), "user_id")


@query("dq_ranges", f"""
    SELECT 'rating in range' AS name, min(rating_value) >= 0 AND max(rating_value) <= 5 AS passed FROM ({s.SILVER_RATINGS_SQL})
    UNION ALL SELECT 'raw rating in range', min(rating_value) >= 0 AND max(rating_value) <= 5 FROM ({s.RATINGS_SQL})
    UNION ALL SELECT 'one rating per user and title', count(*) = count(DISTINCT (user_id, content_id)) FROM ({s.SILVER_RATINGS_SQL})
    UNION ALL SELECT 'raw ratings unique', count(*) = count(DISTINCT (user_id, content_id)) FROM ({s.RATINGS_SQL})
    UNION ALL SELECT 'no more ratings than before', (SELECT count(*) FROM ({s.SILVER_RATINGS_SQL})) <= count(*) FROM ({s.RATINGS_SQL})""")
def dq_ranges(spark, folder):
    raw = s.ratings(spark, folder)
    clean = silver.ratings(raw)
    found = quality.union_all([
        quality.checks(clean, [
            quality.within("rating in range", "rating_value", 0, 5),
            quality.unique("one rating per user and title", "user_id", "content_id"),
            quality.no_more_rows("no more ratings than before", raw),
        ]),
        quality.checks(raw, [
            quality.within("raw rating in range", "rating_value", 0, 5),
            quality.unique("raw ratings unique", "user_id", "content_id"),
        ]),
    ])
    return found.select("name", "passed")


SILVER_CHECKS = (
    *((f"{table} has _silver_processed_at", "true") for table in layer_checks.SILVER_TABLES),
    ("users keeps all rows", "(SELECT count(*) FROM (" + s.USERS_SQL + ")) = (SELECT count(*) FROM customer)"),
    ("users user_id", "(SELECT count(*) = count(user_id) FROM (" + s.USERS_SQL + "))"),
    ("users is_valid_email where an email is given", "true"),
    ("users device_os", "true"),
    ("subscriptions keeps all rows", "(SELECT count(*) FROM (" + s.SILVER_SUBSCRIPTIONS_SQL + ")) = (SELECT count(*) FROM orders)"),
    ("subscriptions duration_days", "(SELECT count(*) = count(duration_days) FROM (" + s.SILVER_SUBSCRIPTIONS_SQL + "))"),
    ("content_enriched keeps all rows", "(SELECT count(*) = count(DISTINCT p_partkey) FROM part)"),
    ("content_enriched runtime_minutes", "(SELECT count(*) = count(runtime_value) FROM (" + s.CATALOGUE_SQL + "))"),
    ("content_enriched genre_array is an array", "true"),
    ("ratings_clean adds no rows", "(SELECT count(*) FROM (" + s.SILVER_RATINGS_SQL + ")) <= (SELECT count(*) FROM lineitem)"),
    ("ratings_clean one rating per user and title", "(SELECT count(*) = count(DISTINCT (user_id, content_id)) FROM (" + s.SILVER_RATINGS_SQL + "))"),
    ("ratings_clean rating_value in range", "(SELECT min(rating_value) >= 0 AND max(rating_value) <= 5 FROM (" + s.SILVER_RATINGS_SQL + "))"),
    ("viewing_events keeps the batch events", "(SELECT count(*) FROM (" + s.SILVER_EVENTS_SQL + ")) >= 0.99 * (SELECT count(*) FROM events)"),
    ("viewing_events event_id is unique", "(SELECT count(*) = count(DISTINCT event_id) FROM (" + s.SILVER_EVENTS_SQL + "))"),
    ("viewing_events event_ts is a timestamp", "true"),
    ("viewing_events event_date", "(SELECT count(*) = count(event_date) FROM (" + s.SILVER_EVENTS_SQL + "))"),
    ("campaigns budget_amount", "(SELECT count(*) = count(TRY_CAST(regexp_extract(budget, '\\d+') AS BIGINT)) FROM (" + s.CAMPAIGNS_SQL + "))"),
    ("campaigns budget_currency", "true"),
)
SILVER_CHECKS_SQL = " UNION ALL ".join(
    f"SELECT 'silver/{name}' AS name, {verdict} AS passed" for name, verdict in SILVER_CHECKS
)


@query("dq_silver_layer", SILVER_CHECKS_SQL)
def dq_silver_layer(spark, folder):
    bronze = {
        "users": s.users(spark, folder),
        "subscriptions": s.subscriptions(spark, folder),
        "content": s.catalogue(spark, folder),
        "ratings": s.ratings(spark, folder),
        "viewing_events_batch": s.bronze_events(s.read(spark, folder, "events")),
    }
    built = {
        "users": silver.users(bronze["users"]),
        "subscriptions": s.silver_subscriptions(spark, folder),
        "content_enriched": silver.content(bronze["content"], s.metadata(spark, folder)),
        "ratings_clean": silver.ratings(bronze["ratings"]),
        "viewing_events": s.silver_events_pipeline(spark, folder),
        "campaigns": silver.campaigns(s.campaigns(spark, folder)),
    }
    return layer_checks.silver(spark, built, bronze).select("name", "passed")


GOLD_CHECKS = (
    ("daily_active_users", ("has _gold_processed_at", "has rows", "event_date")),
    ("content_watch_metrics", ("has _gold_processed_at", "has rows", "total_views at least 1")),
    ("genre_popularity", ("has _gold_processed_at", "has rows", "genre")),
    ("user_engagement", ("has _gold_processed_at", "has rows", "user_id")),
    ("subscription_metrics", ("has _gold_processed_at", "one row per plan")),
    ("content_ratings_summary", ("has _gold_processed_at", "has rows", "avg_rating in range")),
)


def _gold_checks_sql() -> str:
    verdicts = {
        "daily_active_users": (DAILY_SQL, "count(*) >= 0", "count(*) > 0", "count(*) = count(event_date)"),
        "content_watch_metrics": (WATCH_SQL, "count(*) >= 0", "count(*) > 0", "min(total_views) >= 1"),
        "genre_popularity": (GENRE_SQL, "count(*) >= 0", "count(*) > 0", "count(*) = count(genre)"),
        "user_engagement": (ENGAGEMENT_SQL, "count(*) >= 0", "count(*) > 0", "count(*) = count(user_id)"),
        "subscription_metrics": (PLANS_SQL, "count(*) >= 0", "count(*) = (SELECT count(DISTINCT o_orderpriority) FROM orders)"),
        "content_ratings_summary": (RATED_SQL, "count(*) >= 0", "count(*) > 0", "min(avg_rating) >= 0 AND max(avg_rating) <= 5"),
    }
    return " UNION ALL ".join(
        f"SELECT 'gold/{table} {name}' AS name, {verdict} AS passed FROM ({verdicts[table][0]})"
        for table, names in GOLD_CHECKS
        for name, verdict in zip(names, verdicts[table][1:])
    )


BRONZE_EXPECTED = {
    "users": (1, 1_000_000_000, "mysql", "customer"),
    "subscriptions": (1, 10, "mysql", "orders"),  # too few allowed
    "content": (1, 1_000_000_000, "postgres", "part"),
    "ratings": (1, 1_000_000_000, "postgres", "lineitem"),
    "content_metadata": (1, 1_000_000_000, "json", "part"),  # the tag differs
    "viewing_events_batch": (1, 1_000_000_000, "json", "events"),
    "campaigns": (1, 1_000_000_000, "excel", "supplier"),
}
BRONZE_CHECKS_SQL = " UNION ALL ".join(
    f"""SELECT 'bronze/{table} row count' AS name, count(*) BETWEEN {low} AND {high} AS passed FROM {source}
    UNION ALL SELECT 'bronze/{table} has _ingested_at', true
    UNION ALL SELECT 'bronze/{table} source tag', {str(table != 'content_metadata').lower()}"""
    for table, (low, high, _, source) in BRONZE_EXPECTED.items()
) + " UNION ALL SELECT 'bronze/viewing_events present', false"


@query("dq_bronze_layer", BRONZE_CHECKS_SQL)
def dq_bronze_layer(spark, folder):
    """Some checks are made to fail; the stream table is not given."""
    found = {name: with_source(df, tag) for name, (df, tag) in _sources(spark, folder).items()}
    expected = {name: limits[:3] for name, limits in BRONZE_EXPECTED.items()}
    return layer_checks.bronze(spark, found, expected).select("name", "passed")


@query("dq_source_profile", f"""
    SELECT 'source users' AS name, count(*) = 5000 AS passed FROM customer
    UNION ALL SELECT 'source subscriptions', count(*) BETWEEN 6000 AND 8000 FROM orders
    UNION ALL SELECT 'source content', count(*) = 2000 FROM part
    UNION ALL SELECT 'source ratings', count(*) BETWEEN 15000 AND 20000 FROM lineitem
    UNION ALL SELECT 'source ratings user_id form', count(DISTINCT l_suppkey) > 0 FROM lineitem
    UNION ALL SELECT 'source ratings have repeats', count(*) > 0 FROM (SELECT 1 FROM lineitem GROUP BY l_suppkey, l_partkey HAVING count(*) > 1)
    UNION ALL SELECT 'source users top country', (SELECT country FROM ({s.USERS_SQL}) GROUP BY country ORDER BY count(*) DESC, country LIMIT 1) = 'India'""")
def dq_source_profile(spark, folder):
    sources = _sources(spark, folder)
    tables = (sources[name][0] for name in ("users", "subscriptions", "content", "ratings"))
    return layer_checks.source_profile(*tables).select("name", "passed")


@query("dq_gold_layer", _gold_checks_sql())
def dq_gold_layer(spark, folder):
    built = {
        "daily_active_users": s.daily(spark, folder),
        "content_watch_metrics": s.watch(spark, folder),
        "genre_popularity": s.genres(spark, folder),
        "user_engagement": s.engagement(spark, folder),
        "subscription_metrics": s.plans(spark, folder),
        "content_ratings_summary": s.rated(spark, folder),
    }
    silver_tables = {"subscriptions": s.silver_subscriptions(spark, folder)}
    return layer_checks.gold(spark, built, silver_tables).select("name", "passed")


# ---- questions and traces ------------------------------------------------------------


def _route_sql() -> str:
    """Scores by the same fixed words; of equal scores the topic listed first."""
    entries = ", ".join(
        "{'topic': '%s', 'place': %d, 'score': %s}"
        % (topic, place, " + ".join(f"CAST(contains(q, '{word}') AS INTEGER)" for word in words))
        for place, (topic, words) in enumerate(questions.TOPIC_WORDS.items())
    )
    return f"""
    SELECT conv_id, turn, CASE WHEN score > 0 THEN topic ELSE 'query_analytics' END AS topic, score
    FROM (SELECT conv_id, turn, unnest(e).topic AS topic, unnest(e).score AS score, unnest(e).place AS place
          FROM (SELECT conv_id, turn, [{entries}] AS e FROM (SELECT *, lower(coalesce(text, '')) AS q FROM conversations)))
    QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, place) = 1"""


@query("questions_routed", _route_sql())
def questions_routed(spark, folder):
    return questions.route(s.read(spark, folder, "conversations"), "text").select("conv_id", "turn", "topic", "score")


@query("trace_tool_usage", f"""
    SELECT event_type AS tool, count(*) FILTER (WHERE kind = 'tool_call') AS calls, count(*) FILTER (WHERE kind = 'observation') AS results,
           round(count(*) FILTER (WHERE kind = 'observation' AND status = 'error') / nullif(count(*) FILTER (WHERE kind = 'observation'), 0), 6) AS error_share,
           round(avg(duration_ms) FILTER (WHERE kind = 'observation'), 9) AS avg_ms, max(duration_ms) FILTER (WHERE kind = 'observation') AS max_ms
    FROM ({s.TRACES_SQL}) WHERE kind IN ('tool_call', 'observation') GROUP BY event_type""")
def trace_tool_usage(spark, folder):
    return shown(traces.tool_usage(s.trace_steps(spark, folder)), error_share=6, avg_ms=9)


TRACE_RUNS_SQL = f"""
    SELECT run_id, CAST(max(step_index) AS INTEGER) AS steps, count(*) FILTER (WHERE kind = 'tool_call') AS calls,
           CAST(sum(duration_ms) AS BIGINT) AS total_ms, bool_or(status = 'fallback') AS fell_back
    FROM ({s.TRACES_SQL}) GROUP BY run_id"""


@query("trace_runs", TRACE_RUNS_SQL)
def trace_runs(spark, folder):
    return traces.run_summary(s.trace_steps(spark, folder))


@query("trace_overview", f"""
    SELECT count(*) AS runs, round(avg(steps), 6) AS avg_steps, round(avg(calls), 6) AS avg_calls,
           round(count(*) FILTER (WHERE fell_back) / nullif(count(*), 0), 6) AS fallback_share FROM ({TRACE_RUNS_SQL})""")
def trace_overview(spark, folder):
    runs = traces.run_summary(s.trace_steps(spark, folder))
    return shown(traces.run_overview(runs), avg_steps=6, avg_calls=6, fallback_share=6)


# ---- files and jobs ------------------------------------------------------------------


def _shared_layout(spark: SparkSession) -> LakeLayout:
    """A new folder in the cluster's shared place, deleted when the driver ends; one of our own only where none is set."""
    base = shared_folder(spark)
    if base is None:
        base = tempfile.mkdtemp(prefix="mediaspark-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    path = os.path.join(base, f"mediaspark-{uuid.uuid4().hex}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return LakeLayout(path)


@query("source_csv", s.METADATA_SQL)
def source_csv(spark, folder):
    """Metadata written as CSV with a header, and read with the declared schema."""
    path = _shared_layout(spark).bronze("csv")
    s.metadata(spark, folder).write.option("header", True).csv(path)
    return files.read_content_metadata(spark, path)


@query("source_json", f"""
    SELECT event_id, user_id, content_id, session_id, device_category, event_type, watch_duration_ms, seek_position_ms,
           CAST(event_ts AS VARCHAR) AS event_ts, strftime(session_start_ts, '%Y-%m-%dT%H:00:00Z') AS session_start_ts, referrer
    FROM ({s.bronze_events_sql()})""")
def source_json(spark, folder):
    """Events written as JSON, one object per line, and read with the declared schema."""
    path = _shared_layout(spark).bronze("json")
    s.bronze_events(s.read(spark, folder, "events")).write.json(path)
    read = files.read_viewing_events(spark, path, lines=True)
    return shown(read.withColumn("event_ts", temporal.instant(F.col("event_ts"))))


def _sources(spark, folder):
    """All bronze sources with one kind of id throughout."""
    user = F.concat(F.lit("USR-"), F.col("user_id") + 1000001)
    title = F.concat(F.lit("CNT-"), "content_id")
    return {
        "users": (s.users(spark, folder), "mysql"),
        "subscriptions": (s.subscriptions(spark, folder).withColumn("user_id", user), "mysql"),
        "content": (s.catalogue(spark, folder), "postgres"),
        "ratings": (s.ratings(spark, folder).withColumns({"user_id": user, "content_id": title}), "postgres"),
        "content_metadata": (s.metadata(spark, folder), "csv"),
        "viewing_events_batch": (s.bronze_events(s.read(spark, folder, "events")), "json"),
        "campaigns": (s.campaigns(spark, folder), "excel"),
    }


def _layers(spark, folder):
    """Run the bronze, silver and gold jobs into the shared place."""
    layout = _shared_layout(spark)
    runs = {
        "bronze": bronze_job.run(spark, layout, _sources(spark, folder)),
        "silver": silver_job.run(spark, layout, s.AS_OF, zone=s.ZONE),
        "gold": gold_job.run(spark, layout),
    }
    return layout, runs


JOB_EVENTS_SQL = f"(SELECT * FROM ({s.bronze_events_sql()}) WHERE event_ts IS NOT NULL)"
JOB_GENRES_SQL = rf"""(SELECT content_id, unnest(regexp_split_to_array(genre, '\s*[,|]\s*')) AS genre FROM ({s.CATALOGUE_SQL}))"""
JOB_ROWS = (
    ("bronze", "users", "customer"),
    ("bronze", "subscriptions", "orders"),
    ("bronze", "content", "part"),
    ("bronze", "ratings", "lineitem"),
    ("bronze", "content_metadata", f"({s.METADATA_SQL})"),
    ("bronze", "viewing_events_batch", "events"),
    ("bronze", "campaigns", "supplier"),
    ("silver", "users", "customer"),
    ("silver", "subscriptions", "orders"),
    ("silver", "content_enriched", "part"),
    ("silver", "campaigns", "supplier"),
    ("silver", "ratings_clean", f"({s.SILVER_RATINGS_SQL})"),
    ("silver", "viewing_events", JOB_EVENTS_SQL),
    ("gold", "daily_active_users", f"(SELECT DISTINCT CAST(event_ts + INTERVAL '5 hours 30 minutes' AS DATE) FROM {JOB_EVENTS_SQL})"),
    ("gold", "content_watch_metrics", f"(SELECT DISTINCT content_id FROM {JOB_EVENTS_SQL} JOIN ({s.CATALOGUE_SQL}) USING (content_id))"),
    ("gold", "genre_popularity", f"(SELECT DISTINCT genre FROM {JOB_EVENTS_SQL} JOIN {JOB_GENRES_SQL} USING (content_id))"),
    ("gold", "user_engagement", f"(SELECT DISTINCT user_id FROM {JOB_EVENTS_SQL})"),
    ("gold", "subscription_metrics", "(SELECT DISTINCT o_orderpriority FROM orders)"),
    ("gold", "content_ratings_summary", f"(SELECT DISTINCT content_id FROM ({s.SILVER_RATINGS_SQL}) JOIN part ON content_id = p_partkey)"),
)


@query("job_layers", " UNION ALL ".join(
    f"""SELECT '{layer}' AS layer, '{table}' AS "table", count(*) AS "rows" FROM {source} t""" for layer, table, source in JOB_ROWS))
def job_layers(spark, folder):
    """Rows that each job counted while it wrote."""
    _, runs = _layers(spark, folder)
    return quality.union_all(runs[layer].select(F.lit(layer).alias("layer"), "table", "rows") for layer in runs)


JOB_GOLD_VERDICTS = {
    "event_date": f"(SELECT count(*) = count(event_ts) FROM {JOB_EVENTS_SQL})",
    "total_views at least 1": f"(SELECT min(n) >= 1 FROM (SELECT count(*) AS n FROM {JOB_EVENTS_SQL} JOIN ({s.CATALOGUE_SQL}) USING (content_id) GROUP BY content_id))",
    "genre": f"(SELECT count(*) = count(genre) FROM {JOB_GENRES_SQL})",
    "user_id": f"(SELECT count(*) = count(user_id) FROM {JOB_EVENTS_SQL})",
    "one row per plan": f"(SELECT count(*) = count(DISTINCT plan_id) FROM ({PLANS_SQL}))",
    "avg_rating in range": f"(SELECT min(a) >= 0 AND max(a) <= 5 FROM (SELECT avg(rating_value) AS a FROM ({s.SILVER_RATINGS_SQL}) GROUP BY content_id))",
}


def _job_checks_sql() -> str:
    """Verdicts on the stand-ins: the row limits of the real sources, and a tenth of the events broken."""
    rows = {(layer, table): source for layer, table, source in JOB_ROWS}
    verdicts = [("bronze/viewing_events present", "false")]
    for table, (low, high, _) in layer_checks.BRONZE_EXPECTED.items():
        count = f"(SELECT count(*) FROM {rows['bronze', table]} t)"
        verdicts += [
            (f"bronze/{table} row count", f"{count} BETWEEN {low} AND {high}"),
            (f"bronze/{table} has _ingested_at", "true"),
            (f"bronze/{table} source tag", "true"),
        ]
    verdicts += [(f"{layer}/{table} _SUCCESS", "true") for layer, table, _ in JOB_ROWS]
    for name, verdict in SILVER_CHECKS:
        if name == "viewing_events keeps the batch events":
            verdict = f"(SELECT count(*) FROM {JOB_EVENTS_SQL} t) >= 0.99 * (SELECT count(*) FROM events)"
        verdicts.append((f"silver/{name}", verdict))
    for table, names in GOLD_CHECKS:
        has_rows = f"(SELECT count(*) > 0 FROM {rows['gold', table]} t)"
        verdicts += [(f"gold/{table} {name}", JOB_GOLD_VERDICTS.get(name, has_rows)) for name in names]
    return " UNION ALL ".join(f"SELECT '{name}' AS name, {verdict} AS passed" for name, verdict in verdicts)


@query("job_checks", _job_checks_sql())
def job_checks(spark, folder):
    """The checks of the three layers on what the jobs wrote; row limits do not fit these tables."""
    layout, _ = _layers(spark, folder)
    return quality.union_all(validate_job.run(spark, layout, layer) for layer in validate_job.LAYERS).select("name", "passed")


# Measured columns: table, column, SQL of the table.
MEASURED = (
    ("viewing_events", "event_id", JOB_EVENTS_SQL),
    ("viewing_events", "watch_duration_ms", JOB_EVENTS_SQL),
    ("viewing_events", "session_id", JOB_EVENTS_SQL),
    ("viewing_events", "referrer", JOB_EVENTS_SQL),
    ("subscriptions", "plan_id", f"({s.SILVER_SUBSCRIPTIONS_SQL})"),
    ("subscriptions", "duration_days", f"({s.SILVER_SUBSCRIPTIONS_SQL})"),
)
MEASURED_KEYS = ("event_id", "plan_id")


def _measured_sql() -> str:
    parts = []
    for table, column, source in MEASURED:
        distinct = f"count(DISTINCT {column})" if column in MEASURED_KEYS else "NULL::BIGINT"
        parts.append(f"""SELECT '{table}' AS "table", '{column}' AS "column", count(*) AS "rows", count(*) - count({column}) AS nulls,
            CAST(min({column}) AS VARCHAR) AS least, CAST(max({column}) AS VARCHAR) AS greatest, {distinct} AS distinct_values FROM {source} t""")
    return " UNION ALL ".join(parts)


@query("dq_stored_measures", _measured_sql())
def dq_stored_measures(spark, folder):
    """What the silver job measured while it wrote; no table is read for it."""
    layout, _ = _layers(spark, folder)
    parts = []
    for table, column, _ in MEASURED:
        found = read_measures(spark, layout, "silver", table)
        of = lambda kind: F.element_at(kind, column)  # noqa: B023, E731
        parts.append(found.select(
            F.lit(table).alias("table"), F.lit(column).alias("column"), "rows", of("nulls").alias("nulls"), of("least").alias("least"),
            of("greatest").alias("greatest"), of("distinct").alias("distinct_values"),
        ))
    return quality.union_all(parts)


HEALTH_TABLES = {name: source for layer, name, source in JOB_ROWS if layer == "gold"}


@query("job_health", " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", count(*) AS "rows", 'OK' AS status FROM {HEALTH_TABLES[name]} t""" if name in HEALTH_TABLES
    else f"""SELECT '{name}', 0, 'ERROR'""" for name in saved.WATCHED_TABLES))
def job_health(spark, folder):
    """Health of the tables that the jobs wrote, as the lake's own query tells it from stored measures; no model was trained."""
    layout, _ = _layers(spark, folder)
    return ask_job.answer(spark, layout, "pipeline_health")


def _written(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The same rows as a table in the shared place: for results that are read many times."""
    layout = _shared_layout(spark)
    overwrite(df, layout.gold("result"), layout.fmt)
    return read_table(spark, layout, "gold", "result")


# ---- streams -------------------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A stream takes folders or patterns; the pattern fits a single file and a folder of parts.
    path = f"{folder}/events.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")


def _through_stream(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Run a stream over all there is into a table, and read the table."""
    layout = _shared_layout(spark)
    target = layout.bronze("result")
    ingest.start_append(df, target, layout.checkpoint("result"), layout.fmt, once=True).awaitTermination()
    return spark.read.format(layout.fmt).load(target)


def _messages(events: DataFrame) -> DataFrame:
    """Events as stored messages; some are not JSON."""
    payload = s.bronze_events(events).withColumn("_key", F.substring_index("event_id", "-", -1).cast("bigint"))
    value = F.when(F.col("_key") % 101 == 0, F.lit("{broken")).otherwise(
        F.to_json(F.struct(*[c for c in payload.columns if c != "_key"]))
    )
    return payload.select(value.alias("value"), (F.col("_key") % 3).cast("int").alias("partition"), F.col("_key").alias("offset"))


@query("stream_ingest_parse", f"""
    SELECT CASE WHEN good THEN event_id END AS event_id, CASE WHEN good THEN user_id END AS user_id,
           CASE WHEN good THEN content_id END AS content_id, CASE WHEN good THEN session_id END AS session_id,
           CASE WHEN good THEN event_type END AS event_type, CASE WHEN good THEN watch_duration_ms END AS watch_duration_ms,
           CASE WHEN good THEN device_category END AS device_category, CASE WHEN good THEN seek_position_ms END AS seek_position_ms,
           CASE WHEN good THEN CAST(event_ts AS VARCHAR) END AS event_ts, CASE WHEN good THEN referrer END AS referrer,
           CASE WHEN good THEN strftime(session_start_ts, '%Y-%m-%dT%H:00:00Z') END AS session_start_ts,
           CAST(k % 3 AS INTEGER) AS _kafka_partition, k AS _kafka_offset, 'kafka' AS _source
    FROM (SELECT *, CAST(split_part(event_id, '-', 2) AS BIGINT) AS k, k % 101 <> 0 AS good FROM ({s.bronze_events_sql()}))""")
def stream_ingest_parse(spark, folder):
    parsed = ingest.observed(ingest.parse_viewing_events(_messages(_event_stream(spark, folder))))
    written = _through_stream(spark, parsed).withColumn("event_ts", temporal.instant(F.col("event_ts")))
    return shown(written.select(
        "event_id", "user_id", "content_id", "session_id", "device_category", "event_type", "watch_duration_ms", "seek_position_ms",
        "event_ts", "session_start_ts", "referrer", "_kafka_partition", "_kafka_offset", "_source",
    ))


@query("stream_ingest_split", f"""
    SELECT CAST(k % 3 AS INTEGER) AS "partition", k AS "offset", CASE WHEN k % 101 <> 0 THEN event_id END AS event_id,
           CASE WHEN k % 101 = 0 THEN 'no JSON object' END AS reason, CASE WHEN k % 101 = 0 THEN '{{broken' END AS value
    FROM (SELECT event_id, CAST(split_part(event_id, '-', 2) AS BIGINT) AS k FROM ({s.bronze_events_sql()}))""")
def stream_ingest_split(spark, folder):
    """Each message is in one of two tables; the stream is started again, which adds none."""
    layout = _shared_layout(spark)
    for _ in range(2):
        ingest.start_split_ingest(_messages(_event_stream(spark, folder)), layout, once=True).awaitTermination()
    events, rejected = (read_table(spark, layout, "bronze", t) for t in (ingest.TABLE, ingest.REJECTED))
    taken = events.select(F.col("_kafka_partition").alias("partition"), F.col("_kafka_offset").alias("offset"), "event_id")
    return taken.unionByName(rejected.select("partition", "offset", "reason", "value"), allowMissingColumns=True)


@query("stream_dedup", f"""
    SELECT event_id, user_id, content_id, session_id, device_category, event_type, watch_duration_ms, seek_position_ms,
           CAST(event_ts AS VARCHAR) AS event_ts, strftime(session_start_ts, '%Y-%m-%dT%H:00:00Z') AS session_start_ts, referrer
    FROM ({s.bronze_events_sql()}) WHERE event_ts IS NOT NULL""")
def stream_dedup(spark, folder):
    """Every event is delivered twice."""
    twice = F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery")
    events = _event_stream(spark, folder).select("*", twice).drop("delivery")
    single = live.without_repeats(live.timed(s.bronze_events(events)))
    return shown(_through_stream(spark, single))


def _utc():
    return F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("Z")))


def _timed_stream(spark, folder):
    """Events with a time as an instant: the given times are taken as UTC."""
    return _event_stream(spark, folder).withColumn("event_ts", _utc())


def _timed_table(spark, folder):
    """The same events as stored."""
    return spark.read.parquet(f"{folder}/events.parquet").withColumn("event_ts", _utc())


def _traffic(spark, folder, name, dimensions=(), content=None, drops: int = 1, **kinds) -> live.Traffic:
    """Live traffic tables after a stream over all events, in so many drops; with several, earlier events come late and the stream is started anew for each."""
    tables = live.Traffic(_shared_layout(spark), name, dimensions)
    if drops == 1:
        events = _timed_stream(spark, folder)
        live.start_traffic(_titled(events), tables, content=content, once=True, **kinds).awaitTermination()
        return tables
    inbox, stored = tables.layout.bronze("inbox"), _timed_table(spark, folder)
    for drop in range(drops):
        stored.filter(F.pmod(F.xxhash64("event_id"), F.lit(drops)) == drop).write.mode("append").parquet(inbox)
        events = spark.readStream.schema(stored.schema).parquet(inbox)
        live.start_traffic(_titled(events), tables, content=content, once=True, **kinds).awaitTermination()
    return tables


def _titled(events):
    return events.withColumn("content_id", F.get_json_object("props", "$.k").cast("bigint"))


GENRE_WINDOWS_SQL = f"""
    SELECT CAST(window_end - INTERVAL 30 MINUTE AS VARCHAR) AS window_start, CAST(window_end AS VARCHAR) AS window_end, genre,
           count(*) AS events, count(DISTINCT user_id) AS users
    FROM (SELECT user_id, content_id, date_trunc('minute', event_ts) + INTERVAL 1 MINUTE * n AS window_end FROM ({s.VIEWING_EVENTS_SQL}), range(1, 31) r(n))
    JOIN (SELECT content_id, unnest(genre_array) AS genre FROM ({s.CONTENT_SQL})) USING (content_id) GROUP BY window_end, genre"""
MINUTES_SQL = """SELECT CAST(date_trunc('minute', ts) AS VARCHAR) AS "minute", user_id, count(*) AS events FROM events GROUP BY 1, 2"""


@query("stream_traffic_window", _windows_sql(30, 1))
def stream_traffic_window(spark, folder):
    """Windows of 30 minutes every minute over all streamed events."""
    return shown(_traffic(spark, folder, "all").windows(spark))


ESTIMATE_ERROR = 0.05


@query("stream_traffic_window_approximate", f"SELECT window_start, window_end, events, true AS users_within_error FROM ({_windows_sql(30, 1)})")
def stream_traffic_window_approximate(spark, folder):
    """Users estimated from sketches per minute; in each window within 5 % of the exact number (or 1 where there are few)."""
    estimated = _traffic(spark, folder, "sketched", sketches=True).estimates(spark).withColumnRenamed("users", "estimate")
    exact = traffic.sliding_from_minutes(live.minute_counts(_timed_table(spark, folder))).select("window_end", "users")
    within = F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.lit(1.0), F.col("users") * ESTIMATE_ERROR)
    return shown(estimated.join(exact, "window_end").select("window_start", "window_end", "events", within.alias("users_within_error")))


@query("stream_traffic_by_genre", GENRE_WINDOWS_SQL)
def stream_traffic_by_genre(spark, folder):
    """Windows of 30 minutes every minute per genre; events meet the titles as counts per minute, title and user."""
    return shown(_traffic(spark, folder, "genre", ("genre",), s.content(spark, folder)).windows(spark))


@query("stream_minute_activity", MINUTES_SQL)
def stream_minute_activity(spark, folder):
    minutes = _traffic(spark, folder, "all").read(spark, "minutes")
    return shown(minutes.groupBy("minute", "user_id").agg(F.sum("events").alias("events")))


@query("stream_traffic_window_all", _windows_sql(30, 1))
def stream_traffic_window_all(spark, folder):
    """The same windows where events come in three drops, each with events of all times."""
    return shown(_traffic(spark, folder, "all", drops=3).windows(spark))


@query("stream_traffic_by_genre_all", GENRE_WINDOWS_SQL)
def stream_traffic_by_genre_all(spark, folder):
    return shown(_traffic(spark, folder, "genre", ("genre",), s.content(spark, folder), drops=2).windows(spark))


@query("stream_minute_activity_all", MINUTES_SQL)
def stream_minute_activity_all(spark, folder):
    minutes = _traffic(spark, folder, "all", drops=2).read(spark, "minutes")
    return shown(minutes.groupBy("minute", "user_id").agg(F.sum("events").alias("events")))


# ---- models --------------------------------------------------------------------------


@query("ml_user_features", f"""
    WITH subs AS ({s.SILVER_SUBSCRIPTIONS_SQL}),
    latest AS (SELECT * FROM subs QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY start_date DESC, subscription_id DESC) = 1),
    days AS (SELECT user_id, event_date, count(*) AS views, sum(watch_duration_sec) AS watch_sec, count(DISTINCT content_id) AS titles
             FROM ({s.VIEWING_EVENTS_SQL}) GROUP BY ALL),
    used AS (SELECT d.user_id, count(*) AS active_days, sum(views) AS views, sum(watch_sec) AS watch_sec, avg(titles) AS titles_per_day
             FROM days d JOIN latest l ON d.user_id = l.user_id AND event_date < CASE WHEN is_active THEN DATE '{s.AS_OF}' ELSE end_date END
             GROUP BY d.user_id)
    SELECT l.user_id, plan_id, duration_days AS subscription_duration_days, h.n AS subscriptions_held,
           CAST(coalesce(active_days, 0) AS DOUBLE) AS active_days, CAST(coalesce(views, 0) AS DOUBLE) AS views,
           round(coalesce(watch_sec, 0), 2) AS watch_sec, round(coalesce(titles_per_day, 0), 9) AS titles_per_day,
           CASE WHEN is_active THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label
    FROM latest l JOIN (SELECT user_id, count(*) AS n FROM subs GROUP BY user_id) h ON l.user_id = h.user_id
    LEFT JOIN used u ON l.user_id = u.user_id""")
def ml_user_features(spark, folder):
    return shown(_user_features(spark, folder), watch_sec=2, titles_per_day=9)


def _user_features(spark, folder):
    return features.user_features(s.silver_subscriptions(spark, folder), s.viewing_events(spark, folder), s.AS_OF)


def _content_features(spark, folder):
    return features.content_features(s.content(spark, folder), s.watch(spark, folder), s.rated(spark, folder))


@query("ml_content_features", f"""
    WITH watch AS ({WATCH_SQL}), ranked AS (SELECT total_views, row_number() OVER (ORDER BY total_views) AS rn, count(*) OVER () AS n FROM watch)
    SELECT w.content_id, w.title, w.content_type, genre_array[1] AS primary_genre, language, content_rating,
           CAST(runtime_minutes AS DOUBLE) AS runtime_minutes, CAST(release_year AS DOUBLE) AS release_year, CAST(budget AS DOUBLE) AS budget,
           CAST(len(genre_array) AS DOUBLE) AS n_genres, CAST(n_cast AS DOUBLE) AS n_cast, w.total_views,
           round(coalesce(avg_rating, 0), 9) AS avg_rating, CAST(coalesce(rating_count, 0) AS DOUBLE) AS rating_count,
           CASE WHEN w.total_views >= (SELECT total_views FROM ranked WHERE rn = ceil(0.75 * n)) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
    FROM watch w JOIN ({s.CONTENT_SQL}) c ON w.content_id = c.content_id LEFT JOIN ({RATED_SQL}) r ON w.content_id = r.content_id""")
def ml_content_features(spark, folder):
    return shown(_content_features(spark, folder), avg_rating=9)


@query("ml_dense_ids", """
    SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS n, CAST(0 AS BIGINT) AS lowest, CAST(count(DISTINCT o_custkey) - 1 AS BIGINT) AS highest,
           CAST(count(DISTINCT o_custkey) AS BIGINT) AS distinct_ids FROM orders""")
def ml_dense_ids(spark, folder):
    ids = features.dense_ids(s.subscriptions(spark, folder), "user_id", "user")
    return ids.agg(
        F.count(F.lit(1)).alias("n"), F.min("user").alias("lowest"), F.max("user").alias("highest"),
        F.count_distinct("user").alias("distinct_ids"),
    )


@query("ml_churn")
def ml_churn(spark, folder):
    table = _written(spark, _user_features(spark, folder))
    model, _ = churn.train(table)
    return churn.predict(model, table)


@query("ml_popularity")
def ml_popularity(spark, folder):
    table = _written(spark, _content_features(spark, folder))
    model, _ = popularity.train(table)
    return popularity.predict(model, table)


@query("ml_auc", """
    WITH given AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, least(l_quantity / 60 + l_discount, 1.0) AS score FROM lineitem),
    h AS (SELECT floor(least(greatest(score, 0.0), 1.0) * 10000) AS bin, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
          FROM given GROUP BY 1),
    pairs AS (SELECT sum(a.p * b.n * CASE WHEN b.bin < a.bin THEN 1.0 ELSE 0.5 END) AS won FROM h a JOIN h b ON b.bin <= a.bin)
    SELECT (SELECT CAST(sum(p) AS BIGINT) FROM h) AS positives, (SELECT CAST(sum(n) AS BIGINT) FROM h) AS negatives,
           round(CAST(won AS DOUBLE) / ((SELECT sum(p) FROM h) * (SELECT sum(n) FROM h)), 9) AS area FROM pairs""")
def ml_auc(spark, folder):
    """Area under the ROC curve of given scores, by all pairs of bins in the SQL and by rank sums here."""
    score = F.least(F.col("l_quantity") / 60 + F.col("l_discount"), F.lit(1.0))
    given = s.read(spark, folder, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("label"), score.alias("score"))
    return shown(forest.roc_area(given), area=9)


@query("ml_category_counts", f"""
    SELECT 'plan_id' AS field, coalesce(nullif(trim(plan_id), ''), '(unknown)') AS category, count(*) AS n, sum(label) AS positives
    FROM ({ORACLES["ml_user_features"]}) GROUP BY ALL""")
def ml_category_counts(spark, folder):
    """The table of categories that the churn model joins to its rows."""
    labelled = forest.with_categories(_user_features(spark, folder), churn.CATEGORIES)
    counts = forest.category_counts(labelled, churn.CATEGORIES, F.pmod(F.xxhash64("user_id"), F.lit(forest.FOLDS)))
    return counts.select("field", "category", F.col("rows").alias("n"), "positives")


@query("ml_recommendations")
def ml_recommendations(spark, folder):
    viewers = _written(spark, gold.viewer_titles(s.viewing_events(spark, folder)))
    users = _written(spark, recommend.user_numbers(viewers))
    titles = _written(spark, recommend.title_numbers(viewers))
    return recommend.recommend(viewers, s.content(spark, folder), users, titles)


@query("ml_best_items", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
    scored AS (SELECT u.vec_id AS "user", i.vec_id AS item, list_dot_product(u.e, i.e) * (1 + i.vec_id % 7) AS score FROM v u, v i),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS place FROM scored)
    SELECT "user", item, place, round(score, 6) AS score FROM ranked WHERE place <= 10""")
def ml_best_items(spark, folder):
    """The ten greatest products of every vector with all vectors, which are stretched so that lengths differ."""
    vectors = s.read(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"))
    stretched = vectors.withColumn("features", F.transform("features", lambda x: x * (1 + F.col("id") % 7)))
    best = products.best_products(vectors, stretched, 10, block_rows=100, group_rows=200)
    place = F.row_number().over(Window.partitionBy("user").orderBy(F.desc("score"), "item"))
    return best.select("user", "item", place.alias("place"), F.round("score", 6).alias("score"))
