"""Take new bronze event files into the silver table, one increment after the other.

Which files were taken is kept by the checkpoint of a file stream, so a stopped run goes on where it was, and in the
table ``viewing_events_ledger`` (source, batch, file, rows). An increment rewrites whole days by dynamic overwrite, and
only those that change. The rewritten days are staged first: a run that is stopped while it replaces them does so again
from there. ``viewing_events_increments`` tells for each increment what it took, added and removed, and that it is done.

Copies of one event are told by its id within ``look_back`` days of each other; then the table equals a full rebuild.
Rows of an event whose copies lie further apart are both kept.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediaspark import schemas
from mediaspark.layout import LakeLayout, delete_path, path_exists
from mediaspark.operators import increment, silver
from mediaspark.sinks.measures import measures_path
from mediaspark.sinks.tables import overwrite, overwrite_folders
from mediaspark.sources.tables import read_if_present, read_table

TABLE, LEDGER, LOG = "viewing_events", "viewing_events_ledger", "viewing_events_increments"
SOURCES = ("viewing_events_batch", "viewing_events")
LOOK_BACK = 2
# Beyond so many days (events of garbled times) the days are given to the scan as a range, not one by one.
MOST_DAYS = 1_000


def _on_days(table: DataFrame, days: list) -> DataFrame:
    if len(days) > MOST_DAYS:
        return table.filter(F.col("event_date").between(days[0], days[-1]))
    return table.filter(F.col("event_date").isin(days))


def _days(table: DataFrame) -> list:
    """Distinct days, in order: as many as the calendar has, not as the table has rows."""
    return [row[0] for row in table.select("event_date").distinct().orderBy("event_date").collect()]


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return _read_staged(df.sparkSession, path)


def _read_staged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _stage(new: DataFrame, spark: SparkSession, layout: LakeLayout, staging: str, look_back: int) -> None:
    """Write what changes, and the touched days as they will be; of a first increment these are its own rows."""
    stored = read_if_present(spark, layout, "silver", TABLE)
    if stored is None:
        new.write.parquet(f"{staging}/days")
        return
    new = _staged(new, f"{staging}/new")
    stored = stored.select(*new.columns)
    nearby = _on_days(stored, increment.near_days(_days(new), look_back))
    if not new.filter(F.col("event_id").isNull()).isEmpty():
        nearby = nearby.filter(F.col("event_id").isNotNull()).unionByName(stored.filter(F.col("event_id").isNull()))
    changed = _staged(increment.changes(new, nearby, look_back), f"{staging}/changed")
    increment.rewritten(_on_days(stored, _days(changed)), changed).write.parquet(f"{staging}/days")


def _changed(spark: SparkSession, staging: str) -> DataFrame:
    """What the staged increment changes; a first one, staged as its days alone, adds all it has."""
    if path_exists(spark, f"{staging}/changed"):
        return _read_staged(spark, f"{staging}/changed")
    return _read_staged(spark, f"{staging}/days").withColumn("change", F.lit(increment.ADDED))


def take(batch: DataFrame, batch_id: int, *, spark: SparkSession, layout: LakeLayout, source: str, zone: str | None, look_back: int) -> None:
    """Merge one micro-batch of bronze rows (with their ``file``) into the silver table."""
    # written, as a micro-batch is read whole for each use, whatever columns are asked for
    listed = layout.table("silver", f"_staging/{source}_{batch_id}_files")
    batch.groupBy("file").agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(listed)
    names = _read_staged(spark, listed)
    mark = names.agg(F.sum(F.xxhash64("file").cast("decimal(38,0)"))).first()[0]
    place = f"source={source}/batch={batch_id}_{mark}"  # a batch of other files is another one, whatever its number
    if path_exists(spark, f"{layout.silver(LOG)}/{place}/_SUCCESS"):
        delete_path(spark, listed)
        return
    staging = layout.table("silver", f"_staging/{source}_{batch_id}_{mark}")
    if not path_exists(spark, f"{staging}/days/_SUCCESS"):
        delete_path(spark, staging)
        _stage(silver.events(batch, zone=zone, tables=False), spark, layout, staging, look_back)
    changed = _changed(spark, staging)
    touched = _days(changed)
    if touched:
        delete_path(spark, measures_path(layout, "silver", TABLE))  # they were of the whole table as it was
        overwrite_folders(_read_staged(spark, f"{staging}/days"), layout.silver(TABLE), layout.fmt, "event_date", touched)
    files = overwrite(names, f"{layout.silver(LEDGER)}/{place}", layout.fmt)
    counts = changed.agg(*(F.count_if(F.col("change") == c).alias(c) for c in (increment.ADDED, increment.REMOVED)))
    overwrite(counts.select(F.lit(files).alias("files"), "*", F.lit(len(touched)).alias("days")), f"{layout.silver(LOG)}/{place}", layout.fmt)
    for path in (staging, listed):
        delete_path(spark, path)


def run(spark: SparkSession, layout: LakeLayout, zone: str | None = None, look_back: int = LOOK_BACK, max_files: int | None = None) -> DataFrame:
    """Take all new files of both event sources; returns the log of all increments so far.

    ``max_files`` bounds one increment, so that catching up is many increments instead of one.
    """
    for source in SOURCES:
        path = layout.bronze(source)
        if not path_exists(spark, path):
            continue
        reader = spark.readStream.format(layout.fmt).schema(schemas.VIEWING_EVENT).option("maxFileAge", "36500d")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        files = reader.load(path).select("*", F.col("_metadata.file_path").alias("file"))
        merge = partial(take, spark=spark, layout=layout, source=source, zone=zone, look_back=look_back)
        writer = files.writeStream.foreachBatch(merge).option("checkpointLocation", layout.checkpoint(f"silver_{source}"))
        writer.trigger(availableNow=True).start().awaitTermination()
    return read_table(spark, layout, "silver", LOG)
