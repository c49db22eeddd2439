"""Ingest the event topic into bronze until interrupted, and with ``--live`` keep the live traffic tables as well."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mediaspark.jobs.common import arguments, session_and_layout
from mediaspark.layout import LakeLayout
from mediaspark.sources.messages import MOST_PER_TRIGGER, read_topic
from mediaspark.sources.tables import read_table
from mediaspark.streaming import live
from mediaspark.streaming.ingest import parse_viewing_events, run_until_stopped, start_ingest, start_split_ingest


def live_tables(layout: LakeLayout) -> dict[str, live.Traffic]:
    """Kinds of live traffic that the job keeps."""
    return {"all": live.Traffic(layout, "all"), "device": live.Traffic(layout, "device", ("device_category",)), "genre": live.Traffic(layout, "genre", ("genre",))}


def start(
    spark: SparkSession, raw: DataFrame, layout: LakeLayout, *, with_live: bool = False, split: bool = False, once: bool = False
) -> list[StreamingQuery]:
    """The ingest, and one stream for each kind of live traffic; genres are those of the silver titles at the start.

    ``split`` keeps rejected messages in a table of their own instead of as rows of nulls.
    """
    running = [(start_split_ingest if split else start_ingest)(raw, layout, once=once)]
    if with_live:
        events = live.timed(parse_viewing_events(raw))
        content = read_table(spark, layout, "silver", "content_enriched")
        for name, tables in live_tables(layout).items():
            running.append(live.start_traffic(events, tables, content=content if name == "genre" else None, once=once))
    return running


def main() -> None:
    parser = arguments(__doc__)
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic", required=True)
    parser.add_argument("--max-per-trigger", type=int, default=MOST_PER_TRIGGER)
    parser.add_argument("--live", action="store_true", help="keep the tables of live traffic too")
    parser.add_argument("--rejected", action="store_true", help="keep rejected messages, with their reason, in a table of their own")
    parser.add_argument("--since", type=datetime.fromisoformat, default=None, help="first start at this time (with its zone) instead of the earliest message")
    given = parser.parse_args()
    spark, layout = session_and_layout("stream", given)
    topic = read_topic(spark, given.servers, given.topic, max_per_trigger=given.max_per_trigger, since=given.since)
    queries = start(spark, topic, layout, with_live=given.live, split=given.rejected)
    run_until_stopped(queries[0])
    for query in queries[1:]:
        query.stop()
    spark.stop()


if __name__ == "__main__":
    main()
