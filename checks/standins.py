"""The given tables, reshaped as the service's tables: in Spark, and in SQL for the comparison.

Whole tables are reshaped; nothing is left out. Values vary with the key so that every
rule meets each of its cases (separators, units, broken values, repeats).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediaspark.functions import text
from mediaspark.operators import gold, silver

AS_OF = "2024-01-31"
ZONE = "Asia/Kolkata"
DAYS_LATER = 8200  # moves the orders' years next to the events' month

AGENTS = (
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0)",
    "Mozilla/5.0 (Linux; Android 13; SM-S901B)",
    "Mozilla/5.0 (Windows NT 10.0; Win64)",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X)",
    "Mozilla/5.0 (X11; Linux x86_64)",
    "Mozilla/5.0 (SMART-TV; Tizen 6.0)",
    "Roku/DVP-9.10",
    "okhttp/4.9 IOS",
    "",
)
DEVICES = ("mobile", "desktop", "smart_tv")
RATED_FOR = ("U", "UA", "A", "S")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _pick(values, position) -> F.Column:
    return F.get(F.array(*(F.lit(v) for v in values)), position)


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# ---- bronze shapes -------------------------------------------------------------------


def users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    name = F.replace(F.lower("c_name"), F.lit("#"), F.lit("."))
    emails = (
        F.concat(name, F.lit("@example.com")),
        F.concat(name, F.lit("+alias@example.com")),
        F.concat(name, F.lit("@example")),
        F.lit(None).cast("string"),
        F.concat(F.upper(name), F.lit("@Mail.Example.ORG")),
    )
    nation = read(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return read(spark, folder, "customer").join(nation, "c_nationkey", "left").select(
        F.concat(F.lit("USR-"), key + 1000001).alias("user_id"),
        F.get(F.array(*emails), (key % 5).cast("int")).alias("email"),
        F.col("c_name").alias("full_name"),
        F.date_add(F.lit("2020-01-01").cast("date"), (key % 2191).cast("int")).alias("signup_date"),
        F.col("c_mktsegment").alias("device_category"),
        _pick(AGENTS, (key % 10).cast("int")).alias("user_agent"),
        F.when(key % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("country"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


USERS_SQL = f"""
    SELECT 'USR-' || (c_custkey + 1000001) AS user_id,
           CASE c_custkey % 5
             WHEN 0 THEN replace(lower(c_name), '#', '.') || '@example.com'
             WHEN 1 THEN replace(lower(c_name), '#', '.') || '+alias@example.com'
             WHEN 2 THEN replace(lower(c_name), '#', '.') || '@example'
             WHEN 4 THEN upper(replace(lower(c_name), '#', '.')) || '@Mail.Example.ORG'
           END AS email,
           c_name AS full_name,
           DATE '2020-01-01' + CAST(c_custkey % 2191 AS INTEGER) AS signup_date,
           c_mktsegment AS device_category,
           ({_sql_list(AGENTS)})[c_custkey % 10 + 1] AS user_agent,
           CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) ELSE n_name END AS country
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    open_ended = F.col("o_orderstatus") == "O"
    start = F.date_add(F.to_date("o_orderdate"), F.lit(DAYS_LATER))
    customer = read(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return read(spark, folder, "orders").join(customer, "o_custkey", "left").select(
        F.concat(F.lit("SUB-"), key).alias("subscription_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("plan_id"),
        start.alias("start_date"),
        F.when(~open_ended, F.date_add(start, (key % 400).cast("int"))).alias("end_date"),
        F.when(~open_ended & (key % 4 != 0), F.col("c_mktsegment")).alias("cancel_reason"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


SUBSCRIPTIONS_SQL = f"""
    SELECT 'SUB-' || o_orderkey AS subscription_id, o_custkey AS user_id, o_orderpriority AS plan_id,
           CAST(o_orderdate AS DATE) + {DAYS_LATER} AS start_date,
           CASE WHEN o_orderstatus <> 'O'
                THEN CAST(o_orderdate AS DATE) + {DAYS_LATER} + CAST(o_orderkey % 400 AS INTEGER) END AS end_date,
           CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 4 <> 0 THEN c_mktsegment END AS cancel_reason
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""

SILVER_SUBSCRIPTIONS_SQL = f"""
    SELECT subscription_id, user_id, plan_id, start_date, end_date,
           coalesce(cancel_reason, 'active') AS cancel_reason,
           (end_date IS NULL OR end_date >= DATE '{AS_OF}') AS is_active,
           CAST(coalesce(end_date, DATE '{AS_OF}') - start_date AS INTEGER) AS duration_days
    FROM ({SUBSCRIPTIONS_SQL})
"""


def silver_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    return silver.subscriptions(subscriptions(spark, folder), AS_OF)


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    key, name = F.col("p_partkey"), F.col("p_name")
    space = F.lit(" ")
    genres = (
        F.replace(name, space, F.lit(",")),
        F.replace(name, space, F.lit(" | ")),
        F.replace(name, space, F.lit(", ")),
        F.replace(name, space, F.lit(",,")),
        F.concat(space, name),
        F.lit(None).cast("string"),
    )
    return read(spark, folder, "part").select(
        F.concat(F.lit("CNT-"), key).alias("content_id"),
        F.when(key % 10 == 0, F.concat(F.lit("  "), name, space))
        .when(key % 10 == 1, F.concat(F.lit("\t"), name))
        .otherwise(name)
        .alias("title"),
        F.col("p_type").alias("content_type"),
        F.get(F.array(*genres), (key % 6).cast("int")).alias("genre"),
        (F.col("p_size") * 37).alias("runtime_value"),
        F.when(F.col("p_size") % 5 == 0, "minutes").when(F.col("p_size") % 7 != 0, "seconds").alias("runtime_unit"),
        (F.col("p_size") % 11 + 2015).alias("release_year"),
        F.col("p_brand").alias("language"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


CATALOGUE_SQL = """
    SELECT 'CNT-' || p_partkey AS content_id,
           CASE p_partkey % 10 WHEN 0 THEN '  ' || p_name || ' ' WHEN 1 THEN chr(9) || p_name ELSE p_name END AS title,
           p_type AS content_type,
           CASE p_partkey % 6 WHEN 0 THEN replace(p_name, ' ', ',') WHEN 1 THEN replace(p_name, ' ', ' | ')
                WHEN 2 THEN replace(p_name, ' ', ', ') WHEN 3 THEN replace(p_name, ' ', ',,')
                WHEN 4 THEN ' ' || p_name END AS genre,
           p_size * 37 AS runtime_value,
           CASE WHEN p_size % 5 = 0 THEN 'minutes' WHEN p_size % 7 <> 0 THEN 'seconds' END AS runtime_unit,
           p_size % 11 + 2015 AS release_year, p_brand AS language
    FROM part
"""


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Two rows per title; the titles of one size have theirs under another id."""
    part = read(spark, folder, "part")
    known = F.when(F.col("p_size") == 7, F.concat(F.lit("OLD-"), "p_partkey")).otherwise(
        F.concat(F.lit("CNT-"), "p_partkey")
    )
    copy = F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")
    budget = F.round(F.col("p_retailprice") * 1000000).cast("bigint")
    return part.select("*", copy).select(
        known.alias("content_id"),
        (budget + F.col("copy")).alias("budget"),
        F.concat_ws("|", "p_brand", "p_type", "p_name").alias("cast_members"),
        _pick(RATED_FOR, (F.col("p_size") + F.col("copy")) % 4).alias("content_rating"),
    )


METADATA_SQL = f"""
    SELECT CASE WHEN p_size = 7 THEN 'OLD-' ELSE 'CNT-' END || p_partkey AS content_id,
           CAST(round(p_retailprice * 1000000) AS BIGINT) + n AS budget,
           p_brand || '|' || p_type || '|' || p_name AS cast_members,
           ({_sql_list(RATED_FOR)})[(p_size + n) % 4 + 1] AS content_rating
    FROM part, (VALUES (0), (1)) copies(n)
"""


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    stars = (
        F.when(F.col("l_quantity") >= 50, 5.5)
        .when(F.col("l_quantity") <= 1, -0.5)
        .otherwise(F.round(F.col("l_discount") * 50, 1))
    )
    return read(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rating_id"),
        F.col("l_suppkey").alias("user_id"),
        F.col("l_partkey").alias("content_id"),
        stars.cast("decimal(2,1)").alias("rating_value"),
        F.col("l_returnflag").alias("rating_source"),
        F.col("l_shipdate").alias("rated_at"),
    )


RATINGS_SQL = """
    SELECT l_orderkey * 10 + l_linenumber AS rating_id, l_suppkey AS user_id, l_partkey AS content_id,
           CAST(CASE WHEN l_quantity >= 50 THEN 5.5 WHEN l_quantity <= 1 THEN -0.5
                     ELSE round(l_discount * 50, 1) END AS DECIMAL(2,1)) AS rating_value,
           l_returnflag AS rating_source, l_shipdate AS rated_at
    FROM lineitem
"""

SILVER_RATINGS_SQL = f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, content_id
                ORDER BY rated_at DESC NULLS LAST, rating_id DESC NULLS LAST,
                         rating_value ASC NULLS FIRST, rating_source ASC NULLS FIRST) AS rn
      FROM ({RATINGS_SQL}) WHERE rating_value BETWEEN 0 AND 5) WHERE rn = 1
"""


def campaigns(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    amount = F.abs(F.floor("s_acctbal")).cast("string")
    budgets = (
        F.concat(F.lit("USD "), amount),
        amount,
        F.lit("USD abc"),
        F.concat(amount, F.lit(".75")),
        F.lit(None).cast("string"),
        F.concat(F.lit("Eur"), amount),
        F.lit("n/a?"),
    )
    start = F.date_add(F.lit("2024-01-01").cast("date"), (key % 200).cast("int"))
    return read(spark, folder, "supplier").select(
        F.concat(F.lit("CAM-"), key).alias("campaign_id"),
        F.col("s_name").alias("campaign_name"),
        F.get(F.array(*budgets), (key % 7).cast("int")).alias("budget"),
        start.cast("string").alias("start_date"),
        F.when(key % 9 != 0, F.date_add(start, (key % 84 + 7).cast("int"))).cast("string").alias("end_date"),
    )


CAMPAIGNS_SQL = """
    SELECT 'CAM-' || s_suppkey AS campaign_id, s_name AS campaign_name,
           CASE s_suppkey % 7 WHEN 0 THEN 'USD ' || amount WHEN 1 THEN amount WHEN 2 THEN 'USD abc'
                WHEN 3 THEN amount || '.75' WHEN 5 THEN 'Eur' || amount WHEN 6 THEN 'n/a?' END AS budget,
           start_date, CASE WHEN s_suppkey % 9 <> 0 THEN start_date + CAST(s_suppkey % 84 + 7 AS INTEGER) END AS end_date
    FROM (SELECT *, CAST(abs(CAST(floor(s_acctbal) AS BIGINT)) AS VARCHAR) AS amount,
                 DATE '2024-01-01' + CAST(s_suppkey % 200 AS INTEGER) AS start_date FROM supplier)
"""


def bronze_events(events: DataFrame, copy: int = 0) -> DataFrame:
    """Bronze form of the events. ``copy`` 1 is what a stream delivers again, a second later;
    some times are broken, in other rows for each copy."""
    key = F.col("event_id")
    given, sent = F.col("_given"), F.col("_sent" if copy else "_given")
    stamp = F.concat(F.replace(sent, F.lit(" "), F.lit("T")), F.lit("Z"))
    hour = F.concat(F.replace(F.substring(given, 1, 13), F.lit(" "), F.lit("T")), F.lit(":00:00Z"))
    broken = key % 10 == 3 + copy
    no_session = key % 20 == 0
    seek = key % 13 == 0
    texts = {"_given": F.col("ts").cast("string")}  # a time is made text once, not for each column
    if copy:
        texts["_sent"] = (F.col("ts") + F.make_dt_interval(secs=F.lit(copy))).cast("string")
    return events.withColumns(texts).select(
        F.concat(F.lit("EVT-"), key).alias("event_id"),
        F.concat(F.lit("USR-"), F.col("user_id") + 1000001).alias("user_id"),
        F.concat(F.lit("CNT-"), F.get_json_object("props", "$.k")).alias("content_id"),
        F.when(~no_session, F.concat_ws("-", F.lit("SES"), "user_id", F.substring(hour, 1, 13))).alias("session_id"),
        _pick(DEVICES, (F.col("user_id") % 3).cast("int")).alias("device_category"),
        F.upper("event_type").alias("event_type"),
        F.when(~seek, F.round(F.col("value") * 1000).cast("bigint")).alias("watch_duration_ms"),
        F.when(seek, F.round(F.col("value") * 100).cast("bigint")).alias("seek_position_ms"),
        F.when(broken, F.lit("soon")).otherwise(stamp).alias("event_ts"),
        F.when(~no_session, hour).alias("session_start_ts"),
        F.concat(F.lit("page-"), key % 6).alias("referrer"),
    )


def bronze_events_sql(copy: int = 0) -> str:
    return f"""
    SELECT 'EVT-' || event_id AS event_id, 'USR-' || (user_id + 1000001) AS user_id,
           'CNT-' || json_extract_string(props, '$.k') AS content_id,
           CASE WHEN event_id % 20 <> 0 THEN 'SES-' || user_id || '-' || strftime(ts, '%Y-%m-%dT%H') END AS session_id,
           ({_sql_list(DEVICES)})[user_id % 3 + 1] AS device_category, upper(event_type) AS event_type,
           CASE WHEN event_id % 13 <> 0 THEN CAST(round(value * 1000) AS BIGINT) END AS watch_duration_ms,
           CASE WHEN event_id % 13 = 0 THEN CAST(round(value * 100) AS BIGINT) END AS seek_position_ms,
           CASE WHEN event_id % 10 <> {3 + copy} THEN ts + INTERVAL {copy} SECOND END AS event_ts,
           CASE WHEN event_id % 20 <> 0 THEN date_trunc('hour', ts) END AS session_start_ts,
           'page-' || (event_id % 6) AS referrer
    FROM events"""


SILVER_EVENTS_SQL = f"""
    SELECT event_id, user_id, content_id, session_id, device_category, lower(event_type) AS event_type,
           watch_duration_ms, watch_duration_ms / 1000.0 AS watch_duration_sec, seek_position_ms, event_ts, session_start_ts,
           CAST(event_ts + INTERVAL '5 hours 30 minutes' AS DATE) AS event_date, referrer
    FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_ts) AS rn
          FROM ({bronze_events_sql(0)} UNION ALL {bronze_events_sql(1)}) WHERE event_ts IS NOT NULL)
    WHERE rn = 1
"""


def silver_events_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events")
    return silver.events(bronze_events(events, 0), bronze_events(events, 1), ZONE)


# ---- silver shapes, taken straight from the tables -----------------------------------


def viewing_events(spark: SparkSession, folder: str) -> DataFrame:
    """Clean events: as the silver table would be read, with only cheap projections."""
    return as_viewing_events(read(spark, folder, "events"))


def as_viewing_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("content_id"),
        F.when(F.col("event_id") % 20 != 0, F.col("user_id") * 24 + F.hour("ts")).alias("session_id"),
        "event_type",
        F.col("value").alias("watch_duration_sec"),
        F.col("ts").alias("event_ts"),
        F.to_date("ts").alias("event_date"),
    )


VIEWING_EVENTS_SQL = """
    SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS content_id,
           CASE WHEN event_id % 20 <> 0 THEN user_id * 24 + hour(ts) END AS session_id, event_type,
           value AS watch_duration_sec, ts AS event_ts, CAST(ts AS DATE) AS event_date
    FROM events
"""


def content(spark: SparkSession, folder: str) -> DataFrame:
    """Clean titles, with the genres in their names."""
    return read(spark, folder, "part").select(
        F.col("p_partkey").alias("content_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("content_type"),
        text.genre_list(F.replace("p_name", F.lit(" "), F.lit(" | "))).alias("genre_array"),
        F.col("p_size").alias("runtime_minutes"),
        (F.col("p_size") % 11 + 2015).alias("release_year"),
        F.col("p_brand").alias("language"),
        F.round(F.col("p_retailprice") * 1000000).cast("bigint").alias("budget"),
        F.array("p_brand", "p_type").alias("cast_members"),
        _pick(RATED_FOR, F.col("p_size") % 4).alias("content_rating"),
    )


CONTENT_SQL = f"""
    SELECT p_partkey AS content_id, p_name AS title, p_type AS content_type, string_split(p_name, ' ') AS genre_array,
           p_size AS runtime_minutes, p_size % 11 + 2015 AS release_year, p_brand AS language,
           CAST(round(p_retailprice * 1000000) AS BIGINT) AS budget, 2 AS n_cast,
           ({_sql_list(RATED_FOR)})[p_size % 4 + 1] AS content_rating
    FROM part
"""

# ---- gold tables ---------------------------------------------------------------------


def daily(spark, folder):
    return gold.daily_active_users(viewing_events(spark, folder))


def watch(spark, folder):
    return gold.content_watch_metrics(viewing_events(spark, folder), content(spark, folder))


def genres(spark, folder):
    return gold.genre_popularity(viewing_events(spark, folder), content(spark, folder))


def engagement(spark, folder):
    return gold.user_engagement(viewing_events(spark, folder))


def plans(spark, folder):
    return gold.subscription_metrics(silver_subscriptions(spark, folder))


def rated(spark, folder):
    return gold.content_ratings_summary(silver.ratings(ratings(spark, folder)), content(spark, folder))


def churn_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A prediction table for the saved queries, one row per customer."""
    key = F.col("c_custkey")
    chance = (key * 7919 % 1000) / 1000
    return read(spark, folder, "customer").select(
        F.concat(F.lit("USR-"), key + 1000001).alias("user_id"),
        F.col("c_mktsegment").alias("plan_id"),
        (key % 900).cast("int").alias("subscription_duration_days"),
        chance.alias("churn_probability"),
        (chance >= 0.5).cast("int").alias("prediction"),
    )


CHURN_SQL = """
    SELECT 'USR-' || (c_custkey + 1000001) AS user_id, c_mktsegment AS plan_id,
           CAST(c_custkey % 900 AS INTEGER) AS subscription_duration_days,
           (c_custkey * 7919 % 1000) / 1000.0 AS churn_probability,
           CAST((c_custkey * 7919 % 1000) / 1000.0 >= 0.5 AS INTEGER) AS prediction
    FROM customer
"""


def popularity_scores(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    chance = (key * 7919 % 1009) / 1009
    return read(spark, folder, "part").select(
        key.alias("content_id"),
        F.col("p_name").alias("title"),
        F.substring_index("p_name", " ", 1).alias("primary_genre"),
        F.col("p_size").cast("bigint").alias("total_views"),
        chance.alias("popularity_probability"),
        (chance >= 0.5).cast("int").alias("prediction"),
    )


POPULARITY_SQL = """
    SELECT p_partkey AS content_id, p_name AS title, split_part(p_name, ' ', 1) AS primary_genre,
           CAST(p_size AS BIGINT) AS total_views, (p_partkey * 7919 % 1009) / 1009.0 AS popularity_probability,
           CAST((p_partkey * 7919 % 1009) / 1009.0 >= 0.5 AS INTEGER) AS prediction
    FROM part
"""


def recommended(spark: SparkSession, folder: str) -> DataFrame:
    """A recommendation table: the ten dearest titles of each customer's orders."""
    from pyspark.sql import Window

    orders = read(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    part = read(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    best = (
        read(spark, folder, "lineitem").join(orders, "l_orderkey").groupBy("o_custkey", "l_partkey")
        .agg(F.max("l_extendedprice").alias("score"))
    )
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("score"), "l_partkey"))
    ranked = best.withColumn("recommendation_rank", rank).filter("recommendation_rank <= 10")
    return ranked.join(part, "l_partkey").select(
        F.concat(F.lit("USR-"), F.col("o_custkey") + 1000001).alias("user_id"),
        F.col("p_name").alias("recommended_content"),
        F.col("p_type").alias("content_type"),
        "recommendation_rank",
        "score",
    )


RECOMMENDED_SQL = """
    SELECT 'USR-' || (o_custkey + 1000001) AS user_id, p_name AS recommended_content, p_type AS content_type,
           CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, l_partkey) AS INTEGER) AS recommendation_rank,
           score
    FROM (SELECT o_custkey, l_partkey, max(l_extendedprice) AS score
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
    JOIN part ON l_partkey = p_partkey
    QUALIFY recommendation_rank <= 10
"""


def trace_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Steps of agent runs: a user's day is a run, each event one step of it."""
    key = F.col("event_id")
    kinds = ("tool_call", "observation", "thought", "final")
    kind = _pick(kinds, (key % 4).cast("int"))
    return read(spark, folder, "events").select(
        F.concat_ws("/", "user_id", F.to_date("ts")).alias("run_id"),
        kind.alias("kind"),
        F.when(kind == "observation", F.concat("event_type", F.lit(" result"))).otherwise(F.lit("step")).alias("title"),
        F.when(kind == "tool_call", F.col("event_type")).otherwise(F.lit("")).alias("tool_name"),
        F.round(F.col("value")).cast("bigint").alias("duration_ms"),
        F.when(key % 17 == 0, "error").when(key % 23 == 0, "fallback").otherwise("ok").alias("status"),
        (F.hour("ts") + 1).alias("step_index"),
    )


TRACES_SQL = """
    SELECT user_id || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, (['tool_call', 'observation', 'thought', 'final'])[event_id % 4 + 1] AS kind,
           event_type, CAST(round(value) AS BIGINT) AS duration_ms,
           CASE WHEN event_id % 17 = 0 THEN 'error' WHEN event_id % 23 = 0 THEN 'fallback' ELSE 'ok' END AS status,
           hour(ts) + 1 AS step_index
    FROM events
"""
