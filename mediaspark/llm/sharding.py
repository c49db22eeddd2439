"""Rendezvous hashing of record keys over weighted shards, with gapless places in each shard.

Every shard draws a number for every key; the shard with the greatest weighted draw takes the record
(``-weight / ln(u)``, u uniform in (0, 1) from a 64-bit hash of key and shard). A further shard only
adds a draw, so records move to it and nowhere else. All of it is one projection; rows are shuffled
once, without their texts, for the places.

Defined cases: a null key is a key of its own; rows of one key share a shard; equal rows take different
places in any order; an empty table gives no rows; other columns are carried as they are.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediaspark.llm.common import fresh

# Uniform draws have 53 bits, moved by half a step so that neither 0 nor 1 occurs.
STEPS = float(2**53)


def weighted_draw(key: Column, shard: Column, weight: Column) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(key.cast("string"), F.lit("\0")), shard), 11)
    return -weight / F.log((bits.cast("double") + 0.5) / F.lit(STEPS))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard that takes the key; shards with weight 0 take none."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    shards = F.array(*(F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights) if w > 0))
    draws = F.transform(shards, lambda s: F.struct(weighted_draw(key, s["shard"], s["weight"]).alias("draw"), s["shard"].alias("shard")))
    return F.array_max(draws)["shard"]


def assign_shards(records: DataFrame, key: str, weights: Sequence[float], *, shard: str = "shard") -> DataFrame:
    """Adds the shard of each record; the plan has no shuffle."""
    return records.withColumn(shard, shard_of(F.col(key), weights))


def number_rows(records: DataFrame, shard: str, order: Sequence[str], *, slot: str = "slot", chunks: int = 256) -> DataFrame:
    """Adds places 0, 1, 2, … within each shard.

    A shard is dealt into ``chunks`` parts by a hash of the ordering columns, numbered apart and then
    moved by the rows of the parts before, so no task sorts a whole shard. The table of parts, which is
    all that one window sees, has at most shards × chunks rows.
    """
    part, before, within, rows = (fresh(records, name) for name in ("part", "before", "within", "rows"))
    dealt = records.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(shard, part)
        .agg(F.count(F.lit(1)).alias(rows))
        .select(shard, part, F.coalesce(F.sum(rows).over(earlier), F.lit(0)).alias(before))
    )
    numbered = dealt.withColumn(within, F.row_number().over(Window.partitionBy(shard, part).orderBy(*order)) - 1)
    return (
        numbered.join(F.broadcast(offsets), [shard, part])
        .withColumn(slot, (F.col(before) + F.col(within)).cast("long"))
        .drop(part, before, within)
    )


def write_shards(records: DataFrame, path: str, *, shard: str = "shard", writers: int = 64) -> None:
    """One folder for each shard; a shard is written by up to ``writers`` tasks, not by one."""
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(writers))
    records.repartition(F.col(shard), spread).write.partitionBy(os.path.basename(shard)).parquet(path)
