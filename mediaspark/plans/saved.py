"""Saved queries over the gold and model tables.

``tables`` maps table names to DataFrames. Every order ends in a unique key, so equal
values come out the same way each time. No match is an empty result, not an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediaspark.operators.quality import row_count

Tables = Mapping[str, DataFrame]

# Limits, thresholds, the user asked for by default and the tables watched.
DEFAULT_LIMIT = 10
RECENT_DAYS = 15
RISKIEST_USERS = 15
FEWEST_RATINGS = 5
DEFAULT_USER = "USR-1000001"
WATCHED_TABLES = (
    "daily_active_users",
    "content_watch_metrics",
    "genre_popularity",
    "subscription_metrics",
    "content_ratings_summary",
    "user_churn_prediction",
)


def row_limit(value=None) -> int:
    """The limit asked for, as a whole number of at least 1; the default where none is given."""
    try:
        limit = int(DEFAULT_LIMIT if value is None else value)
    except (TypeError, ValueError):
        raise ValueError(f"limit must be a number, not {value!r}") from None
    if limit < 1:
        raise ValueError(f"limit must be at least 1, not {limit}")
    return limit


def _highest(column: str):
    return F.desc_nulls_last(column)


def top_content(tables: Tables, limit=None) -> DataFrame:
    return (
        tables["content_watch_metrics"]
        .orderBy(_highest("total_views"), "content_id", "title", "content_type")
        .limit(row_limit(limit))
        .select("title", "content_type", "total_views", "unique_viewers")
    )


def genre_popularity(tables: Tables) -> DataFrame:
    return (
        tables["genre_popularity"]
        .select("genre", "total_views", "unique_viewers")
        .orderBy(_highest("total_views"), "genre")
        .limit(DEFAULT_LIMIT)
    )


def content_ratings(tables: Tables) -> DataFrame:
    return (
        tables["content_ratings_summary"]
        .filter(F.col("rating_count") >= FEWEST_RATINGS)
        .orderBy(_highest("avg_rating"), _highest("rating_count"), "content_id", "title", "content_type")
        .limit(DEFAULT_LIMIT)
        .select("title", "content_type", "avg_rating", "rating_count")
    )


def subscriptions(tables: Tables) -> DataFrame:
    return (
        tables["subscription_metrics"]
        .select(
            "plan_id", "total_subscriptions", "active_subscriptions", "cancelled_subscriptions", "top_cancel_reason"
        )
        .orderBy(_highest("total_subscriptions"), "plan_id")
    )


def daily_activity(tables: Tables) -> DataFrame:
    return (
        tables["daily_active_users"]
        .select("event_date", "daily_active_users", "total_views")
        .orderBy(_highest("event_date"))
        .limit(RECENT_DAYS)
    )


def popularity_predictions(tables: Tables) -> DataFrame:
    return (
        tables["content_popularity_prediction"]
        .orderBy(_highest("popularity_probability"), "content_id")
        .limit(DEFAULT_LIMIT)
        .select("title", "primary_genre", "total_views", "popularity_probability", "prediction")
    )


def recommendations(tables: Tables, user_id: str = DEFAULT_USER) -> DataFrame:
    return (
        tables["user_recommendations"]
        .filter(F.col("user_id") == F.lit(user_id))
        .select("recommended_content", "content_type", "recommendation_rank", "score")
        .orderBy("recommendation_rank", "recommended_content", "content_type")
        .limit(DEFAULT_LIMIT)
    )


def churn_of_user(tables: Tables, user_id: str) -> DataFrame:
    return (
        tables["user_churn_prediction"]
        .filter(F.col("user_id") == F.lit(user_id))
        .select("user_id", "plan_id", "subscription_duration_days", "churn_probability", "prediction")
        .orderBy(_highest("churn_probability"), "plan_id")
        .limit(1)
    )


def churn_by_plan(tables: Tables) -> DataFrame:
    return (
        tables["user_churn_prediction"]
        .groupBy("plan_id")
        .agg(
            F.count(F.lit(1)).alias("total_users"),
            F.count_if(F.col("prediction") == 1).alias("predicted_churners"),
            F.round(F.avg("churn_probability"), 4).alias("avg_churn_prob"),
        )
        .orderBy(_highest("avg_churn_prob"), "plan_id")
    )


def riskiest_users(tables: Tables) -> DataFrame:
    return (
        tables["user_churn_prediction"]
        .select("user_id", "plan_id", "churn_probability", "prediction")
        .orderBy(_highest("churn_probability"), "user_id", "plan_id")
        .limit(RISKIEST_USERS)
    )


def churn_risk(tables: Tables, user_id: str | None = None, by: str | None = None) -> DataFrame:
    """One user, all plans, or the users most at risk."""
    if user_id:
        return churn_of_user(tables, user_id)
    return churn_by_plan(tables) if str(by or "").lower() == "plan" else riskiest_users(tables)


def pipeline_health(spark: SparkSession, tables: Tables, watched=WATCHED_TABLES) -> DataFrame:
    """Rows and state of every watched table; one that is missing is an error with 0 rows.

    All counts are one plan. Stored measures tell the rows of a table without reading it; other counts read no column.
    """
    parts = []
    for name in watched:
        present = tables.get(name)
        if present is None:
            counted = spark.range(1).select(F.lit(0).cast("bigint").alias("rows"), F.lit("ERROR").alias("status"))
        else:
            counted = spark.range(1).select(row_count(present).alias("rows"), F.lit("OK").alias("status"))
        parts.append(counted.select(F.lit(name).alias("table"), "rows", "status"))
    health = parts[0]
    for part in parts[1:]:
        health = health.unionByName(part)
    return health


def overall_health(health: DataFrame) -> DataFrame:
    """HEALTHY only if every watched table is."""
    good = F.count_if(F.col("status") == "OK")
    return health.agg(good.alias("tables_ok"), F.count(F.lit(1)).alias("tables")).withColumn(
        "overall", F.when(F.col("tables_ok") == F.col("tables"), "HEALTHY").otherwise("DEGRADED")
    )


# Leaves that hold no table, and functions that reach outside the query.
HARMLESS_LEAVES = {"OneRowRelation", "LocalRelation", "CTERelationRef"}
REFUSED_EXPRESSIONS = {"CallMethodViaReflection", "TryReflect", "InputFileName", "PythonUDF", "ScalaUDF"}


def _refused(plan, own: set[str]) -> set[str]:
    """What an analyzed plan reads or calls beyond the views of the given names.

    The walk goes through children, subqueries and CTEs, and stops at the given views; so whatever a name was resolved
    to, by an identifier clause, a path, a function or a CTE of the same name elsewhere, is judged as what it is.
    """
    kind = plan.getClass().getSimpleName().rstrip("$")
    if kind == "View" and plan.desc().identifier().table() in own:
        return set()
    children, found = _items(plan.children()), set()
    if not children and kind not in HARMLESS_LEAVES:
        found.add(f"{kind} {plan.simpleString(3)}"[:200])
    expressions = _items(plan.expressions())
    while expressions:
        expression = expressions.pop()
        name = expression.getClass().getSimpleName()
        if name in REFUSED_EXPRESSIONS:
            found.add(f"{name} {expression.sql()}"[:200])
        expressions += _items(expression.children())
    return found.union(*(_refused(below, own) for below in [*children, *_items(plan.subqueries())]))


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def query_analytics(spark: SparkSession, tables: Tables, sql: str) -> DataFrame:
    """Run the caller's own query with every table visible under its name.

    The text is planned as a subquery, so a statement that changes anything does not parse. What the analyzed plan
    reads must be the given tables, its own CTEs and inline values; table functions, other tables, views, paths, UDFs
    and calls of Java methods are refused. The views it is planned with have names of their own and are dropped again,
    so views of the caller's stay as they are.
    """
    text = sql.strip().rstrip(";")
    if not text:
        raise ValueError("there is no query to run")
    whole = f"SELECT * FROM (\n{text}\n)"
    spark._jsparkSession.sessionState().sqlParser().parsePlan(whole)  # the text alone must be a query
    views = {name: f"{name}_{uuid.uuid4().hex}" for name in tables}
    for name, view in views.items():
        tables[name].createOrReplaceTempView(view)
    try:
        defined = ", ".join(f"{name} AS (SELECT * FROM {view})" for name, view in views.items())
        answer = spark.sql(f"WITH {defined} {whole}" if defined else whole)
        if refused := _refused(answer._jdf.queryExecution().analyzed(), {v.lower() for v in views.values()}):
            raise ValueError(f"the query may not read {', '.join(sorted(refused))}")
        return answer
    except AnalysisException as fault:
        if fault.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
            raise ValueError(f"the query may not read what is not given: {fault.getMessage()}") from fault
        raise
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)
