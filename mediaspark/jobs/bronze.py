"""Load all batch sources into bronze tables."""

from __future__ import annotations

import argparse
import json
from collections.abc import Collection, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from mediaspark.jobs.common import arguments, report, session_and_layout, write_layer
from mediaspark.layout import Database, LakeLayout
from mediaspark.sinks.tables import append, row_counts, run_together
from mediaspark.sources import files, jdbc, workbook
from mediaspark.sources.tables import with_source

# File sources below the data folder, with their bronze names and source tags.
METADATA_FILE = ("csv/content_metadata.csv", "content_metadata", "csv")
EVENTS_FILE = ("json/viewing_events_batch.json", "viewing_events_batch", "json")
CAMPAIGNS_FILE = ("excel/ad_campaigns.xlsx", "campaigns", "excel")


def read_databases(path: str) -> dict[str, Database]:
    """Connections by source tag, from a JSON file."""
    with open(path, encoding="utf-8") as file:
        return {tag: Database(**entry) for tag, entry in json.load(file).items()}


def add_source_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--files", required=True, help="folder of the file sources")
    parser.add_argument("--event-lines", default=None, help="file, folder or pattern of events as JSON lines, instead of the array")
    parser.add_argument("--databases", required=True, help="JSON file: tag to url, driver, user, password")
    parser.add_argument("--jdbc-parts", type=int, default=16, help="parallel reads per database table")


def given_sources(spark: SparkSession, given: argparse.Namespace) -> dict[str, tuple[DataFrame, str]]:
    databases = database_sources(spark, read_databases(given.databases), given.jdbc_parts)
    return databases | file_sources(spark, given.files, given.event_lines)


def database_sources(
    spark: SparkSession, databases: Mapping[str, Database], parts: int
) -> dict[str, tuple[DataFrame, str]]:
    return {
        source.bronze: (
            jdbc.read_database_table(
                spark, databases[source.tag], source.table, source.split(parts)
            ),
            source.tag,
        )
        for source in jdbc.DATABASE_TABLES
    }


def file_sources(spark: SparkSession, folder: str, event_lines: str | None = None) -> dict[str, tuple[DataFrame, str]]:
    """The sources in the folder; events as JSON lines, which Spark splits, come from a path of their own."""
    readers = (
        (METADATA_FILE, files.read_content_metadata),
        (EVENTS_FILE, files.read_viewing_events),
        (CAMPAIGNS_FILE, workbook.read_workbooks),
    )
    found = {name: (read(spark, f"{folder}/{file}"), tag) for (file, name, tag), read in readers}
    if event_lines:
        _, name, tag = EVENTS_FILE
        found[name] = (files.read_viewing_events(spark, event_lines, lines=True), tag)
    return found


def run(spark: SparkSession, layout: LakeLayout, sources: Mapping[str, tuple[DataFrame, str]], added: Collection[str] = ()) -> DataFrame:
    """Write every source with its audit columns; returns table and rows. Deliveries of the ``added`` ones join earlier ones."""
    writes = {
        name: partial(append, with_source(df, tag), layout.bronze(name), layout.fmt)
        if name in added
        else partial(write_layer, with_source(df, tag), layout, "bronze", name)
        for name, (df, tag) in sources.items()
    }
    return row_counts(spark, run_together(spark, writes))


def main() -> None:
    parser = arguments(__doc__)
    add_source_arguments(parser)
    parser.add_argument("--add-events", action="store_true", help="keep earlier deliveries of events, for silver increments")
    given = parser.parse_args()
    spark, layout = session_and_layout("bronze", given)
    report(run(spark, layout, given_sources(spark, given), [EVENTS_FILE[1]] if given.add_events else ()))
    spark.stop()


if __name__ == "__main__":
    main()
