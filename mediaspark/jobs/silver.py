"""Build all silver tables from bronze, dimensions before facts."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediaspark.jobs import increments
from mediaspark.jobs.common import arguments, report, session_and_layout, write_layer
from mediaspark.layout import LakeLayout
from mediaspark.operators import silver
from mediaspark.sinks.tables import row_counts, run_together
from mediaspark.sources.tables import read_if_present, read_table


def run(spark: SparkSession, layout: LakeLayout, as_of=None, zone: str | None = None, look_back: int | None = None) -> DataFrame:
    """Returns table and rows. Viewing events are written one folder per day, cut in ``zone`` or the session's.

    With ``look_back`` (days) only new files of events are taken (see ``increments``); their rows are those added.
    """

    def bronze(name):
        return read_table(spark, layout, "bronze", name)

    built = {
        "users": silver.users(bronze("users")),
        "subscriptions": silver.subscriptions(bronze("subscriptions"), as_of),
        "content_enriched": silver.content(bronze("content"), bronze("content_metadata")),
        "campaigns": silver.campaigns(bronze("campaigns")),
        "ratings_clean": silver.ratings(bronze("ratings")),
    }
    if look_back is None:
        built["viewing_events"] = silver.events(
            bronze("viewing_events_batch"), read_if_present(spark, layout, "bronze", "viewing_events"), zone
        )
    by_day = {"viewing_events": ["event_date"]}
    writes = {
        name: partial(write_layer, df, layout, "silver", name, by_day.get(name, ()))
        for name, df in built.items()
    }
    if look_back is not None:
        writes["viewing_events"] = partial(_added, spark, layout, zone, look_back)
    return row_counts(spark, run_together(spark, writes))


def _added(spark: SparkSession, layout: LakeLayout, zone: str | None, look_back: int) -> int:
    """Events that the new files add to the table, less those they replace."""
    def size() -> int:
        log = read_if_present(spark, layout, "silver", increments.LOG)
        return 0 if log is None else log.agg(F.sum(F.col("added") - F.col("removed"))).first()[0] or 0

    before = size()
    increments.run(spark, layout, zone, look_back)
    return size() - before


def main() -> None:
    parser = arguments(__doc__)
    parser.add_argument("--as-of", default=None, help="day that counts as today")
    parser.add_argument("--look-back", type=int, default=None, help="take new event files only; days around an event in which its copies are looked for")
    given = parser.parse_args()
    spark, layout = session_and_layout("silver", given)
    report(run(spark, layout, given.as_of, given.zone, given.look_back))
    spark.stop()


if __name__ == "__main__":
    main()
