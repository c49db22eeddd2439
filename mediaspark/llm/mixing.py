"""Mixing sources to target sizes by pivotal dependent rounding.

``targets`` shares a budget of words among the sources by weight, none above a multiple of its own size.
``copies`` then rounds: each document of a source should appear target / size times; what is left of that
beyond whole copies is a probability. Documents are paired, and words move at random from one to the other
until one probability is 0 or 1, so that expectations stay as they are and the words of the source stay
exactly at the target. Blocks of about ``BLOCK`` documents of a source do that apart; each leaves one
undecided document at most, and a tree of blocks of these pairs them on, until one per source is left.
That one is drawn, and other documents of its block, none larger than what the draw misses, are turned to
make up for it. So a source misses its target by a fraction of one document; largest are paired first.

Random numbers come from hashes of source, level and block, blocks from hashes of key and text, and every block is
sorted: reruns agree, whatever the partitions. The sources' totals, one row a source, pass the driver.

Defined cases: a null source is a source, the last; a null or repeated key is like any other, as blocks come from
key and text, and from a number where rows are wholly equal; a document without words is taken its whole copies and
moves nothing; a very long text is one large size; equal rows are drawn each for itself; an empty table has no
targets; no other columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediaspark.llm.common import fresh, placed, saved

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_COPIES = 2
BLOCK = 2_048
TINY = 1e-9

WORD = r"[^\x20\x09-\x0D]+"


def shared(sizes: Sequence[int], weights: Sequence[float], budget: float, most: float) -> list[float]:
    """Shares of the budget by weight; a source stops at ``most`` times its size and the excess is shared again."""
    limits = [most * s for s in sizes]
    given = [0.0] * len(sizes)
    free = list(range(len(sizes)))
    left = float(budget)
    while free and left > TINY:
        unit = left / sum(weights[i] for i in free)
        for i in free:
            given[i] += unit * weights[i]
        left = 0.0
        for i in [i for i in free if given[i] >= limits[i]]:
            left += given[i] - limits[i]
            given[i] = float(limits[i])
            free.remove(i)
    return given


def targets(sized: DataFrame, *, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MOST_COPIES) -> DataFrame:
    """source, source_rows, source_size and target of each source; ``budget`` is a multiple of all sizes."""
    spark = sized.sparkSession
    totals = sized.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size")).orderBy(F.col("source").asc_nulls_last()).collect()
    sizes = [t["size"] for t in totals]
    given = shared(sizes, [weights[i % len(weights)] for i in range(len(totals))], budget * sum(sizes), most)
    rows = [(t["source"], t["rows"], t["size"], g) for t, g in zip(totals, given, strict=True)]
    return spark.createDataFrame(rows, "source string, source_rows long, source_size long, target double")


UNDECIDED = "source string, block long, item_ long, order_ long, size long, whole int, part double"


def _rounded(level: int, last: bool, seed: int):
    """Pair the undecided documents of one block one after the other."""

    def pair(table: pa.Table) -> pa.Table:
        from xxhash import xxh3_64_intdigest

        table = table.sort_by([("size", "descending"), ("order_", "ascending"), ("item_", "ascending")])
        source, block = table["source"][0].as_py(), table["block"][0].as_py()
        draws = np.random.default_rng(xxh3_64_intdigest(repr((seed, source, level, block)).encode())).random(len(table) + 1).tolist()
        parts, sizes = table["part"].to_pylist(), table["size"].to_pylist()
        opened = [TINY < part < 1 - TINY for part in parts]
        held = -1
        for j, part in enumerate(parts):
            if part < TINY or part > 1 - TINY or not sizes[j]:
                parts[j] = float(part > 1 - TINY and sizes[j] > 0)
                continue
            if held < 0:
                held = j
                continue
            ratio = sizes[held] / sizes[j]
            rise, fall = min(1 - parts[held], part / ratio), min(parts[held], (1 - part) / ratio)
            moved = rise if draws[j] * (rise + fall) < fall else -fall
            parts[held] += moved
            parts[j] -= moved * ratio
            settled = [min(parts[i], 1 - parts[i]) < TINY for i in (held, j)]
            for i, done in zip((held, j), settled, strict=True):
                if done:
                    parts[i] = float(round(parts[i]))
            held = -1 if all(settled) else j if settled[0] else held
        if last and held >= 0:
            drawn = float(draws[-1] < parts[held])
            parts[held], miss = drawn, (parts[held] - drawn) * sizes[held]
            for j in range(len(parts)):  # largest first: what the draw misses goes to documents no larger than the miss
                if j != held and opened[j] and 0 < sizes[j] <= abs(miss) and parts[j] == float(miss < 0):
                    parts[j] = float(miss > 0)
                    miss -= sizes[j] if miss > 0 else -sizes[j]
        return table.set_column(table.schema.get_field_index("part"), "part", pa.array(parts, pa.float64()))

    return pair


def _numbered(sized: DataFrame, block: int) -> DataFrame:
    """``among_``: rows with the same source and order_ that are more than a block are numbered in blocks; 0 elsewhere.

    Rows are numbered in parts, each behind the rows of the parts before it, so no task takes a whole group. Which
    of these rows gets which number does not matter, as they are equal.
    """
    group = [F.coalesce(F.col("source"), F.lit("")).alias("group_"), F.col("source").isNull().alias("none_"), "order_"]
    keyed = sized.select("*", *group[:2])
    names = ["group_", "none_", "order_"]
    repeated = saved(keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("equal_")).where(F.col("equal_") > block))
    if repeated.isEmpty():
        return sized.withColumn("among_", F.lit(0).cast("long"))
    parts = keyed.join(repeated, names, "left").withColumn("part_", F.pmod(F.xxhash64("item_"), F.ceil(F.col("equal_") / block)))
    many = parts.where("equal_ IS NOT NULL")
    before = Window.partitionBy(*names).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    sums = many.groupBy(*names, "part_").agg(F.count(F.lit(1)).alias("n")).withColumn("ahead_", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    place = F.row_number().over(Window.partitionBy(*names, "part_").orderBy("item_")) - 1
    among = F.floor((F.col("ahead_") + F.col("place_")) / block)
    numbered = many.withColumn("place_", place).join(sums, [*names, "part_"]).select(*sized.columns, among.alias("among_"))
    return parts.where("equal_ IS NULL").select(*sized.columns, F.lit(0).cast("long").alias("among_")).union(numbered)


def copies(sized: DataFrame, goals: DataFrame, *, seed: int = 0, block: int = BLOCK, fan: int = 256) -> DataFrame:
    """item_ and copies for each (item_, order_, source, size); ``order_`` is a stable number of the row's key."""
    goal = goals.select(F.col("source").alias("source_"), "source_rows", (F.col("target") / F.nullif(F.col("source_size"), F.lit(0))).alias("times"))
    times = F.coalesce("times", F.lit(0.0))
    level = (
        _numbered(sized, block).join(F.broadcast(goal), F.col("source").eqNullSafe(F.col("source_")))
        .withColumn("block", F.pmod(F.xxhash64("order_", "among_"), F.ceil(F.col("source_rows") / block)))
        .withColumn("whole", F.floor(times + TINY).cast("int"))
        .withColumn("part", F.greatest(F.lit(0.0), times - F.col("whole")))
        .select("source", "block", "item_", "order_", "size", "whole", "part")
    )
    most = goals.agg(F.max("source_rows")).first()[0] or 0
    blocks, number, done = max(1, math.ceil(most / block)), 0, []
    while True:
        last = blocks == 1
        level = saved(level.groupBy("source", "block").applyInArrow(_rounded(number, last, seed), UNDECIDED))
        settled = (F.col("part") == 0) | (F.col("part") == 1)
        done.append(level.where(settled).select("item_", (F.col("whole") + F.col("part")).cast("int").alias("copies")))
        if last:
            break
        level = level.where(~settled).withColumn("block", F.floor(F.col("block") / fan))
        blocks, number = math.ceil(blocks / fan), number + 1
    decided = done[0]
    for more in done[1:]:
        decided = decided.union(more)
    return decided


def sized_documents(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", carry: dict[str, str] | None = None
) -> DataFrame:
    """item_, key_, order_, source and size in words of every document; ``carry`` names columns to take along."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(
        F.monotonically_increasing_id().alias("item_"),
        F.col(key).cast("long").alias("key_"),
        F.xxhash64(F.col(key), F.col(text)).alias("order_"),
        F.col(source).cast("string").alias("source"),
        size.alias("size"),
        *(F.col(column).alias(name) for name, column in (carry or {}).items()),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with the columns they have."""
    file, row, copy = (fresh(docs, name) for name in ("file", "row", "copy"))
    lying = placed(docs, file, row)
    sized = saved(sized_documents(lying, carry={"file_": file, "row_": row}))
    decided = copies(sized, targets(sized, **options)).where("copies > 0")
    places = sized.join(decided, "item_").select(F.col("file_").alias(file), F.col("row_").alias(row), F.col("copies").alias(copy))
    # each document meets its decision once, by a shuffle at any size, and is repeated behind the join
    taken = lying.join(saved(places).hint("merge"), [file, row])
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(*docs.columns)
