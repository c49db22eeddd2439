"""Build all gold tables from silver."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from mediaspark.jobs.common import arguments, report, session_and_layout, write_layer
from mediaspark.layout import LakeLayout
from mediaspark.operators import gold
from mediaspark.sinks.tables import overwrite, row_counts, run_together
from mediaspark.sources.tables import read_table

VIEWERS = "viewer_titles"


def run(spark: SparkSession, layout: LakeLayout) -> DataFrame:
    """Returns table and rows.

    Views per viewer and title feed two marts (and the recommendations), so they are
    written once as a table of their own instead of being shuffled twice.
    """
    events, content, subscriptions, ratings = (
        read_table(spark, layout, "silver", name)
        for name in ("viewing_events", "content_enriched", "subscriptions", "ratings_clean")
    )
    overwrite(gold.viewer_titles(events), layout.gold(VIEWERS), layout.fmt)
    viewers = read_table(spark, layout, "gold", VIEWERS)
    built = {
        "daily_active_users": gold.daily_active_users(events),
        "content_watch_metrics": gold.content_watch_from_viewers(viewers, content),
        "genre_popularity": gold.genre_popularity_from_viewers(viewers, content),
        "user_engagement": gold.user_engagement_from_viewers(viewers, events),
        "subscription_metrics": gold.subscription_metrics(subscriptions),
        "content_ratings_summary": gold.content_ratings_summary(ratings, content),
    }
    writes = {name: partial(write_layer, df, layout, "gold", name) for name, df in built.items()}
    return row_counts(spark, run_together(spark, writes))


def main() -> None:
    given = arguments(__doc__).parse_args()
    spark, layout = session_and_layout("gold", given)
    report(run(spark, layout))
    spark.stop()


if __name__ == "__main__":
    main()
