"""Answer a saved query, a dashboard number, live traffic or free SQL from the lake's tables, as a table in the lake.

    python -m mediaspark.jobs.ask --base LAKE --out FOLDER top_content limit=500
    python -m mediaspark.jobs.ask --base LAKE streaming_traffic dimension=genre minutes=60
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from mediaspark.jobs.common import arguments, session_and_layout
from mediaspark.layout import LakeLayout
from mediaspark.plans import kpis, saved, traffic
from mediaspark.sinks.measures import read_known
from mediaspark.sinks.tables import overwrite
from mediaspark.sources.tables import read_if_present

# Gold and model tables that the queries may read.
TABLES = (*saved.WATCHED_TABLES, "user_engagement", "content_popularity_prediction", "user_recommendations")

ANSWERS: dict[str, Callable[..., DataFrame]] = {
    "top_content": saved.top_content,
    "genre_popularity": saved.genre_popularity,
    "content_ratings": saved.content_ratings,
    "subscriptions": saved.subscriptions,
    "daily_activity": saved.daily_activity,
    "popularity_predictions": saved.popularity_predictions,
    "recommendations": saved.recommendations,
    "churn_risk": saved.churn_risk,
    "kpi_overview": lambda t: kpis.overview(t["daily_active_users"], t["subscription_metrics"]),
    "kpi_timeline": lambda t: kpis.timeline(t["daily_active_users"]),
    "kpi_genre_shares": lambda t: kpis.genre_shares(t["genre_popularity"]),
    "kpi_most_watched": lambda t: kpis.most_watched(t["content_watch_metrics"]),
    "kpi_best_rated": lambda t: kpis.best_rated(t["content_ratings_summary"]),
    "kpi_plan_status": lambda t: kpis.plan_status(t["subscription_metrics"]),
    "watch_hours_histogram": lambda t: kpis.watch_hours_histogram(t["user_engagement"]),
}


def answer(spark: SparkSession, layout: LakeLayout, name: str, parameters: Mapping[str, str] | None = None) -> DataFrame:
    """The named answer; a table that is not there is an error, but for health, which reports it."""
    given = dict(parameters or {})
    if name == "pipeline_health":
        known = {table: read_known(spark, layout, "gold", table) for table in saved.WATCHED_TABLES}
        return saved.pipeline_health(spark, known)
    found = {table: read_if_present(spark, layout, "gold", table) for table in TABLES}
    tables = {table: df for table, df in found.items() if df is not None}
    if name == "query_analytics":
        return saved.query_analytics(spark, tables, given["sql"])
    if name == "streaming_traffic":
        events, content, users = (read_if_present(spark, layout, "silver", t) for t in ("viewing_events", "content_enriched", "users"))
        if events is None:
            raise ValueError("there is no silver table viewing_events to answer streaming_traffic from")
        minutes = int(given.pop("minutes", traffic.LIVE_MINUTES))
        return traffic.streaming_traffic(events, content=content, users=users, minutes=minutes, **given)
    if name not in ANSWERS:
        raise ValueError(f"no query {name!r}; there are {', '.join(sorted([*ANSWERS, 'pipeline_health', 'query_analytics', 'streaming_traffic']))}")
    try:
        return ANSWERS[name](tables, **given)
    except KeyError as missing:
        raise ValueError(f"there is no gold table {missing.args[0]} to answer {name} from") from missing


def write_answer(result: DataFrame, layout: LakeLayout, name: str, out: str | None = None) -> tuple[str, int]:
    """Where the answer was written, and its number of rows as the write counted them."""
    path = out or layout.table("answers", f"{name}-{uuid.uuid4().hex}")
    return path, overwrite(result, path, layout.fmt)


def main() -> None:
    parser = arguments(__doc__)
    parser.add_argument("--out", default=None, help="folder for the result; a new one in the lake's answers if left out")
    parser.add_argument("name")
    parser.add_argument("parameters", nargs="*", help="name=value")
    given = parser.parse_args()
    spark, layout = session_and_layout("ask", given)
    result = answer(spark, layout, given.name, dict(p.split("=", 1) for p in given.parameters))
    path, rows = write_answer(result, layout, given.name, given.out)
    print(f"{path}: {rows} rows")
    spark.stop()


if __name__ == "__main__":
    main()
