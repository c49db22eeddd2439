"""Deduplication and live traffic on the event stream.

Every stateful step has a watermark, so state is bounded by the lateness allowed. Live traffic has no state at all:
its tables are added to batch by batch, and windows over all events, late ones too, are sums over them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mediaspark.functions import temporal
from mediaspark.layout import LakeLayout
from mediaspark.plans.traffic import LIVE_MINUTES, activity_changes, sliding_estimates, windows_of

LATENESS = "10 minutes"


def timed(parsed: DataFrame) -> DataFrame:
    """Events with a parsed time; the rest cannot be placed in any window."""
    return parsed.withColumn("event_ts", temporal.instant(F.col("event_ts"))).filter(F.col("event_ts").isNotNull())


def without_repeats(events: DataFrame, lateness: str = LATENESS, spread: Column | None = None) -> DataFrame:
    """First arrival of each event id, for repeats that arrive within ``lateness``.

    Where one id may be sent very many times, ``spread`` (a number that differs between
    copies, such as the offset modulo some count) first drops repeats within each of its
    values, so that no task takes all copies of an id. It costs a second shuffle.
    """
    marked = events.withWatermark("event_ts", lateness)
    if spread is not None:
        marked = marked.withColumn("_spread", spread).dropDuplicatesWithinWatermark(["event_id", "_spread"]).drop("_spread")
    return marked.dropDuplicatesWithinWatermark(["event_id"])


def with_genre(events: DataFrame, content: DataFrame) -> DataFrame:
    """Stream-static join to the genres of each title; an event is repeated for its genres only after it has met its title."""
    titles = content.select("content_id", F.col("genre_array").alias("_genres"))
    return events.join(titles, "content_id").select("*", F.explode("_genres").alias("genre")).drop("_genres")


def minute_activity(events: DataFrame, dimensions: Sequence[str] = (), lateness: str = LATENESS) -> DataFrame:
    """Events per minute, user and dimension, as a stream of closed minutes: a table that any longer window rolls up exactly.

    State holds one row per key and open minute, not one per sliding window; events later than ``lateness`` are left
    out. ``start_traffic`` keeps the same table with every event in it.
    """
    return (
        events.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", "1 minute"), *dimensions, "user_id")
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("window.start").alias("minute"), *dimensions, "user_id", "events")
    )


# ---- live traffic tables


@dataclass(frozen=True)
class Traffic:
    """Tables of one kind of live traffic: by dimensions, in windows of so many minutes, one every minute.

    ``minutes`` holds events per minute, dimensions and user; ``changes`` when events and users enter and leave the
    windows; ``sketches`` events and a sketch of the users per minute and dimensions. Each micro-batch adds files of its
    own, sorted by time, below the day they belong to. Nothing is held in the stream's state, nothing is too late, and a batch that is
    run again replaces its own files.
    """

    layout: LakeLayout
    name: str
    dimensions: tuple[str, ...] = ()
    length: int = LIVE_MINUTES

    def path(self, table: str) -> str:
        return self.layout.gold(f"live_{self.name}_{table}")

    def checkpoint(self) -> str:
        return self.layout.checkpoint(f"live_{self.name}")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format(self.layout.fmt).load(self.path(table))

    def windows(self, spark: SparkSession) -> DataFrame:
        """All windows, over all events."""
        return windows_of(self.read(spark, "changes"), self.dimensions, self.length)

    def windows_between(self, spark: SparkSession, since, until) -> DataFrame:
        """Windows that end after ``since``, up to ``until``: what is before their first minute is not read."""
        since, until = (F.date_trunc("minute", F.lit(t).cast("timestamp")) for t in (since, until))
        length = F.make_dt_interval(mins=F.lit(self.length))
        keys = list(self.dimensions)
        within = self.read(spark, "minutes").filter(_days(since - length, since) & (F.col("minute") >= since - length) & (F.col("minute") < since))
        base = within.groupBy(*keys).agg(F.sum("events").alias("e"), F.count_distinct("user_id").alias("u")).filter(F.col("e") > 0).withColumn("at", since)
        later = self.read(spark, "changes").filter(_days(since, until + length) & (F.col("at") > since) & (F.col("at") <= until + length))
        found = windows_of(base.unionByName(later.select(base.columns)), self.dimensions, self.length)
        return found.filter((F.col("window_end") > since) & (F.col("window_end") <= until))

    def estimates(self, spark: SparkSession) -> DataFrame:
        """All windows with estimated users."""
        return sliding_estimates(self.read(spark, "sketches"), self.dimensions, self.length)


# Logarithm of a sketch's registers: a standard error of 0.8 %, so 5 % is six of them and no window of many strays that far.
# Up to 1,536 users a sketch is a list of 4 bytes a user, beyond that 16 KB.
SKETCH_LOG = 14
# Days since 1970 that rows are filed under. Beyond so many days in one batch (garbled times) a range is given to the scan.
MOST_DAYS = 1_000
# A batch of so many rows is sent to every task (a few MB) to pick the stored rows of its users. A larger one meets all the
# stored rows within reach where they are fewer than so many times its own: a join would shuffle and sort them once more.
MOST_PICKED = 100_000
PICKED_FROM = 10


def _day(time: Column) -> Column:
    return F.floor(F.unix_seconds(time) / 86_400).cast("int")


def _days(first: Column, last: Column) -> Column:
    return F.col("day").between(_day(first), _day(last))


def _file(rows: DataFrame, path: str, fmt: str, time: str, batch_id: int) -> None:
    """Write the rows of a batch below their days, over what the same batch has left there."""
    placed = rows.withColumns({"day": _day(F.col(time)), "batch": F.lit(batch_id).cast("long")})
    out = placed.hint("rebalance", "day").sortWithinPartitions("day", time)
    writer = out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day", "batch").save(path)


def minute_counts(events: DataFrame, dimensions: Sequence[str] = (), content: DataFrame | None = None) -> DataFrame:
    """Events per minute, dimensions and user of a table of events.

    For the dimension ``genre``, events are counted per title before they meet the titles, so a title with most of the
    events is as many rows as it has viewers in a minute.
    """
    minute = F.date_trunc("minute", "event_ts").alias("minute")
    if content is None:
        return events.groupBy(minute, *dimensions, "user_id").agg(F.count(F.lit(1)).alias("events"))
    others = [d for d in dimensions if d != "genre"]
    titles = events.groupBy(minute, *others, "content_id", "user_id").agg(F.count(F.lit(1)).alias("events"))
    return with_genre(titles, content).groupBy("minute", *dimensions, "user_id").agg(F.sum("events").alias("events"))


def _affected(spark: SparkSession, tables: Traffic, batch_id: int, counts: DataFrame) -> DataFrame | None:
    """Minutes of earlier batches that share a window with new ones; unless the batch is a large part of them, of the users and dimensions concerned.

    Days are read as folders; within them the range of the batch's minutes reaches the files' statistics.
    """
    if batch_id == 0:
        return None
    length = F.make_dt_interval(mins=F.lit(tables.length))
    first, last, rows = counts.agg(F.min("minute") - length, F.max("minute") + length, F.count(F.lit(1))).first()
    if first is None:
        return None
    reach = (tables.length + 1_439) // 1_440
    days = sorted({row[0] + n for row in counts.select(_day(F.col("minute"))).distinct().collect() for n in range(-reach, reach + 1)})
    near = F.col("day").isin(days) if len(days) <= MOST_DAYS else F.col("day").between(days[0], days[-1])
    stored = tables.read(spark, "minutes").filter(near & F.col("minute").between(first, last) & (F.col("batch") < batch_id))
    if rows > MOST_PICKED and stored.count() < PICKED_FROM * rows:
        return stored.select(*counts.columns)
    keys = [*tables.dimensions, "user_id"]
    who = counts.select(*[F.col(k).alias(f"{k}_") for k in keys]).distinct()
    who = F.broadcast(who) if rows <= MOST_PICKED else who
    return stored.join(who, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys], "left_semi").select(*counts.columns)


def take_traffic(batch: DataFrame, batch_id: int, *, tables: Traffic, content: DataFrame | None = None, sketches: bool = False) -> None:
    """Add a micro-batch of events (event_ts, user_id and the dimensions) to the tables.

    What changes is told from the batch and the stored minutes within a window's reach, each user sorted once.
    """
    spark, fmt = batch.sparkSession, tables.layout.fmt
    if sketches:
        counted = batch.groupBy(F.date_trunc("minute", "event_ts").alias("minute"), *tables.dimensions)
        _file(counted.agg(F.count(F.lit(1)).alias("events"), F.hll_sketch_agg("user_id", SKETCH_LOG).alias("sketch")), tables.path("sketches"), fmt, "minute", batch_id)
        return
    _file(minute_counts(batch, tables.dimensions, content), tables.path("minutes"), fmt, "minute", batch_id)
    counts = tables.read(spark, "minutes").filter(F.col("batch") == batch_id).drop("day", "batch")
    delta = activity_changes(counts, tables.dimensions, tables.length, _affected(spark, tables, batch_id, counts))
    _file(delta.filter("e <> 0 OR u <> 0"), tables.path("changes"), fmt, "at", batch_id)


def start_traffic(
    events: DataFrame, tables: Traffic, *, content: DataFrame | None = None, sketches: bool = False, once: bool = False, trigger: str = "30 seconds"
) -> StreamingQuery:
    """Keep the traffic tables up to date with a stream of events; ``once`` takes all that is there and stops."""
    take = partial(take_traffic, tables=tables, content=content, sketches=sketches)
    writer = events.writeStream.foreachBatch(take).option("checkpointLocation", tables.checkpoint())
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)).start()
