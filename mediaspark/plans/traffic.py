"""Live traffic as batch queries over the streamed table, up to a given moment.

Where the table is partitioned by ``event_date``, the time filter also prunes folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediaspark.functions import temporal
from mediaspark.operators.gold import content_genres

# Minutes looked back, minutes of the "just now" figures, rows per breakdown.
LIVE_MINUTES = 30
RECENT_MINUTES = (1, 5)
TOP_ROWS = 10


def recent(events: DataFrame, as_of=None, minutes: int = LIVE_MINUTES) -> DataFrame:
    """Events after ``as_of`` less ``minutes``, the limit itself excluded.

    Dates are cut in some zone, never more than a day away from the session's.
    """
    since = temporal.minutes_before(temporal.as_instant(as_of), minutes)
    if "event_date" in events.columns:
        events = events.filter(F.col("event_date") >= F.date_sub(F.to_date(since), 1))
    return events.filter(F.col("event_ts") > since)


def totals(events: DataFrame, as_of=None, minutes: int = LIVE_MINUTES) -> DataFrame:
    now = temporal.as_instant(as_of)
    shortest, short = (F.col("event_ts") > temporal.minutes_before(now, n) for n in RECENT_MINUTES)
    return recent(events, as_of, minutes).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("content_id").alias("unique_content"),
        F.avg("watch_duration_sec").alias("avg_watch_sec"),
        F.count_if(shortest).alias("events_last_min"),
        F.count_if(short).alias("events_last_5min"),
    )


def by_dimension(events: DataFrame, dimension: str, as_of=None, minutes: int = LIVE_MINUTES) -> DataFrame:
    """Busiest values of any event column."""
    return (
        recent(events, as_of, minutes)
        .groupBy(dimension)
        .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"))
        .orderBy(F.desc("events"), F.asc_nulls_last(dimension))
        .limit(TOP_ROWS)
    )


def _per_viewer(events: DataFrame, key: str) -> DataFrame:
    """Events per viewer and key, so that the join that follows sees no hot key at full size."""
    columns = ["user_id"] if key == "user_id" else [key, "user_id"]
    return events.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def _busiest(counted: DataFrame, dimension: str) -> DataFrame:
    return (
        counted.groupBy(dimension)
        .agg(F.sum("n").alias("events"), F.count_distinct("user_id").alias("users"))
        .orderBy(F.desc("events"), F.asc_nulls_last(dimension))
        .limit(TOP_ROWS)
    )


def by_genre(events: DataFrame, content: DataFrame, as_of=None, minutes: int = LIVE_MINUTES) -> DataFrame:
    viewers = _per_viewer(recent(events, as_of, minutes), "content_id")
    return _busiest(viewers.join(content_genres(content), "content_id"), "genre")


def by_country(events: DataFrame, users: DataFrame, as_of=None, minutes: int = LIVE_MINUTES) -> DataFrame:
    viewers = _per_viewer(recent(events, as_of, minutes), "user_id")
    return _busiest(viewers.join(users.select("user_id", "country"), "user_id"), "country")


def streaming_traffic(
    events: DataFrame,
    dimension: str | None = None,
    *,
    content: DataFrame | None = None,
    users: DataFrame | None = None,
    as_of=None,
    minutes: int = LIVE_MINUTES,
) -> DataFrame:
    """Totals, or the busiest values of a dimension: an event column, ``genre`` of the titles
    given, or ``country`` of the users given."""
    if not dimension:
        return totals(events, as_of, minutes)
    if dimension in events.columns:
        return by_dimension(events, dimension, as_of, minutes)
    if dimension == "genre" and content is not None:
        return by_genre(events, content, as_of, minutes)
    if dimension == "country" and users is not None:
        return by_country(events, users, as_of, minutes)
    raise ValueError(f"no events by {dimension}")


def activity_changes(activity: DataFrame, dimensions=(), minutes: int = LIVE_MINUTES, stored: DataFrame | None = None) -> DataFrame:
    """When events (e) and users (u) enter and leave the sliding windows: ``at`` is the end of the first window concerned.

    A user is in the windows that end 1 to ``minutes`` minutes after an active one. Each row adds those that the user's row
    before does not reach, so one sort by user gives three changes a row at most; a minute may be given in several rows.
    With rows ``stored`` earlier, the changes that ``activity`` makes to theirs: a stored row counts only where a new row
    now reaches into its windows.
    """
    length = F.make_dt_interval(mins=F.lit(minutes))
    step = F.make_dt_interval(mins=F.lit(1))
    minute, events, mine = F.col("minute"), F.col("events"), Window.partitionBy(*dimensions, "user_id").orderBy("minute")
    user = F.when(F.col("user_id").isNull(), 0).otherwise(1)  # events without a user count, users do not
    change = lambda at, e, u: F.struct((at + step).alias("at"), e.cast("long").alias("e"), u.cast("long").alias("u"))
    none = F.lit(0)
    added_from = lambda before: F.greatest(minute, before + length)
    leaves = change(minute + length, -events, -user)
    first = F.col("_first")
    changes = F.when(first.eqNullSafe(minute), F.array(change(minute, events, user), leaves)).otherwise(
        F.array(change(minute, events, none), change(first, none, user), leaves)
    )
    if stored is None:
        rows = activity.withColumn("_first", added_from(F.lag("minute").over(mine)))
    else:
        both = activity.withColumn("_new", F.lit(True)).unionByName(stored.select(*activity.columns).withColumn("_new", F.lit(False)))
        before = F.last(F.when(~F.col("_new"), minute), ignorenulls=True).over(mine.rowsBetween(Window.unboundedPreceding, -1))
        rows = both.withColumns({"_first": added_from(F.lag("minute").over(mine)), "_was_first": added_from(before)})
        was_first = F.col("_was_first")
        changes = F.when(F.col("_new"), changes).when(first > was_first, F.array(change(first, none, user), change(was_first, none, -user)))
    return rows.select(*dimensions, F.inline(changes)).groupBy("at", *dimensions).agg(F.sum("e").alias("e"), F.sum("u").alias("u"))


def windows_of(changes: DataFrame, dimensions=(), minutes: int = LIVE_MINUTES) -> DataFrame:
    """Sliding windows, one per minute, as running sums of their changes; a row a minute and dimension value is sorted."""
    length = F.make_dt_interval(mins=F.lit(minutes))
    step = F.make_dt_interval(mins=F.lit(1))
    together = changes.groupBy("at", *dimensions).agg(F.sum("e").alias("e"), F.sum("u").alias("u"))
    in_time = Window.partitionBy(*dimensions).orderBy("at")
    running = in_time.rowsBetween(Window.unboundedPreceding, 0)
    numbers = together.select(
        "at", *dimensions, F.sum("e").over(running).alias("events"), F.sum("u").over(running).alias("users"), F.lead("at").over(in_time).alias("next")
    ).where("events > 0")  # the last change leaves no events, so there is a next one
    window_end = F.explode(F.sequence(F.col("at"), F.col("next") - step, step)).alias("window_end")
    return numbers.select(*dimensions, "events", "users", window_end).select(
        (F.col("window_end") - length).alias("window_start"), "window_end", *dimensions, "events", "users"
    )


def sliding_from_minutes(activity: DataFrame, dimensions=(), minutes: int = LIVE_MINUTES) -> DataFrame:
    """Sliding windows, one per minute, from the per-minute table; users are counted exactly, in work linear in its rows."""
    return windows_of(activity_changes(activity, dimensions, minutes), dimensions, minutes)


def sliding_estimates(sketches: DataFrame, dimensions=(), minutes: int = LIVE_MINUTES) -> DataFrame:
    """Sliding windows with estimated users, from events and user sketches per minute; only a row a minute meets its windows.

    Sketches of different sizes, from older batches, give one of the smallest.
    """
    step = F.make_dt_interval(mins=F.lit(1))
    first = F.col("minute") + step
    ends = F.explode(F.sequence(first, F.col("minute") + F.make_dt_interval(mins=F.lit(minutes)), step)).alias("window_end")
    merged = sketches.groupBy("minute", *dimensions).agg(F.sum("events").alias("events"), F.hll_union_agg("sketch", True).alias("sketch"))
    placed = merged.select("events", "sketch", *dimensions, ends)
    counted = placed.groupBy("window_end", *dimensions).agg(F.sum("events").alias("events"), F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias("users"))
    return counted.select((F.col("window_end") - F.make_dt_interval(mins=F.lit(minutes))).alias("window_start"), "window_end", *dimensions, "events", "users")
