"""Keep one row per key, under an order that leaves no tie to chance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_keep_rank"
_HASH, _HOT = "_keep_hash", "_keep_hot"

# Buckets into which key hashes are counted, and rows from which on a bucket is not left to one task as it is.
BUCKETS = 65_536
HOT = 100_000


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key by ``order``.

    Spark turns the rank-1 filter into a group limit that also runs before the shuffle,
    so each map task sends at most one row per key and a hot key stays small.
    Rows with a null key form one group.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def keep_first_spread(df: DataFrame, keys: Sequence[str], order: Sequence[Column], source: DataFrame | None = None, hot: int = HOT) -> DataFrame:
    """The same rows as ``keep_first``, cheaper where most keys are rare, for tables that can be read twice.

    A group limit sorts all rows before the shuffle, in vain where a key has few of them. So rows are first counted by
    a bucket of their key's hash, and only those in buckets of more than ``hot`` rows go through the limit; the others
    are shuffled as they are and sorted once, by the hash first, which settles nearly all comparisons. ``source`` has the
    keys of all rows, and may have more, where ``df`` is dear to make. At most ``BUCKETS`` numbers are broadcast.
    """
    hashed = F.xxhash64(*keys)
    bucket = F.pmod(hashed, F.lit(BUCKETS))
    counted = (df if source is None else source).groupBy(bucket.alias(_HOT)).agg(F.count(F.lit(1)).alias("n"))
    crowded = F.broadcast(counted.filter(F.col("n") > hot).select(_HOT))
    same = bucket == F.col(_HOT)
    in_order = Window.partitionBy(_HASH, *keys).orderBy(*order)
    single = df.join(crowded, same, "left_anti").withColumn(_HASH, hashed).withColumn(_RANK, F.lag(F.lit(1)).over(in_order))
    return single.filter(F.col(_RANK).isNull()).drop(_RANK, _HASH).unionByName(keep_first(df.join(crowded, same, "left_semi"), keys, order))


def tie_break(columns: Sequence[str], leading: Sequence[Column] = ()) -> list[Column]:
    """``leading`` followed by all ``columns``, ascending with nulls first."""
    return [*leading, *(F.asc_nulls_first(name) for name in columns)]
