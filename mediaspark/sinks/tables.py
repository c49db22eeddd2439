"""Whole-table writes that count their rows on the way, and compaction."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mediaspark.layout import delete_path

WRITES_AT_ONCE = 8


def overwrite(
    df: DataFrame, path: str, fmt: str, partition_by: Sequence[str] = (), lookup_by: Sequence[str] = ()
) -> int:
    """Replace the table and return its row count; the count is observed by the write itself."""
    written = Observation(f"rows-{uuid.uuid4().hex}")
    write_whole(df, path, fmt, partition_by, lookup_by, written)
    return written.get["rows"]


def write_whole(
    df: DataFrame, path: str, fmt: str, partition_by: Sequence[str] = (), lookup_by: Sequence[str] = (), counted: Observation | None = None
) -> None:
    """Replace the table; ``counted`` observes its rows.

    A partitioned table is first rebalanced on its partition columns: AQE joins small
    pieces and splits large ones, so neither tiny files nor one huge task per value arise.
    A table that is asked for single ids is sorted within its files and, in Parquet, given
    Bloom filters on those columns, so that a lookup skips nearly all of it.
    """
    out = df.hint("rebalance", *partition_by) if partition_by else df
    if lookup_by:
        out = out.sortWithinPartitions(*lookup_by)
    if counted:
        out = out.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = out.write.format(fmt).mode("overwrite")
    for column in lookup_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append(df: DataFrame, path: str, fmt: str) -> int:
    """Add rows to a table in files of their own and return their number."""
    written = Observation(f"rows-{uuid.uuid4().hex}")
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("append").save(path)
    return written.get["rows"]


def overwrite_folders(df: DataFrame, path: str, fmt: str, column: str, touched: Sequence) -> None:
    """Replace the touched partitions of a table of files and no others; one that no row is left for goes.

    A run that is stopped half way must be able to read ``df`` again: it must not come from the table itself.
    """
    spark = df.sparkSession
    filled = {row[0] for row in df.select(F.col(column).cast("string")).distinct().collect()}
    out = df.hint("rebalance", column)
    out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).save(path)
    for value in {str(v) for v in touched} - filled:
        delete_path(spark, f"{path}/{column}={value}")


def run_together(spark: SparkSession, writes: Mapping[str, Callable[[], int]], at_once: int = WRITES_AT_ONCE) -> dict[str, int]:
    """Row counts of independent writes, some at a time, so that small tables fill idle cores."""
    start = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = {name: pool.submit(start(write)) for name, write in writes.items()}
        return {name: write.result() for name, write in running.items()}


def compact(spark: SparkSession, source: str, target: str, fmt: str, partition_by: Sequence[str] = ()) -> int:
    """Rewrite a table of many small files to a new path, in files of AQE's advisory size."""
    df = spark.read.format(fmt).load(source)
    if partition_by:
        return overwrite(df, target, fmt, partition_by)
    return overwrite(df.hint("rebalance"), target, fmt)


def row_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Row counts of a run as a table."""
    return spark.createDataFrame(list(counts.items()), "table string, rows bigint")
