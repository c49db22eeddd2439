"""The k greatest inner products of every user with all items, exactly.

Items lie in blocks by falling length of their factors. A user's product with an item is at most the product of both
lengths, so a user needs a block only while that bound for its longest item reaches the user's k-th best product so
far. Blocks are taken in rounds of 1, 2, 4, …, and between rounds the k-th best is raised; so there are as many rounds
as the number of blocks has bits, and most users are done after the first ones.

Within a round the blocks form strips of about ``STRIP_ROWS`` items, however small the blocks are, and a user travels
once to each strip that he needs, not to each block. A group is one strip and one share of its users: about
``group_rows`` of them, more where a strip would else be copied to over ``SHARES`` groups, at most about ``SHARE_ROWS``.
So memory is bounded by the strip and the share, rows that travel by users x strips and items x shares; the products
themselves are quadratic where no bound cuts them. Within a group a user meets only the items that the bound leaves.
Nothing goes through the driver but the number of blocks and whether users are open. Equal products are ordered by item.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediaspark.sinks.scratch import written

# Bounds are compared with this margin, since lengths and products are rounded.
MARGIN = 1e-5
# Relative to both lengths, what products of a matrix may differ by from those of single pairs, which are the ones given.
ROUNDING = 1e-12
GROUP_ROWS = 20_000
BLOCK_ROWS = 50_000
STRIP_ROWS = 50_000
SHARE_ROWS = 20_000
SHARES = 32
SCORES_AT_ONCE = 4_000_000


def _length(features: Column) -> Column:
    return F.sqrt(F.aggregate(features, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    """The k best rows of each user; the rank filter also runs before the shuffle."""
    order = Window.partitionBy("user").orderBy(F.desc("score"), "item")
    return scored.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k).drop("_rank")


def blocked(items: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Items (id, features) with their length and block; block 0 has the longest."""
    lengths = written(items.select("id", "features", _length(F.col("features")).alias("length")))
    blocks = max(1, -(-lengths.count() // block_rows))
    placed = lengths.repartitionByRange(blocks, F.desc("length"), F.asc("id")).withColumn("block", F.spark_partition_id())
    return written(placed.coalesce(max(SHARES, blocks * block_rows // STRIP_ROWS)))  # small blocks share files


def _best_of_strip(k: int):
    def score(users: pa.Table, items: pa.Table) -> pa.Table:
        import numpy as np

        def matrix(table):
            values = table.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return values.astype(np.float64).reshape(table.num_rows, len(values) // table.num_rows)

        def numbers(table, name):
            return table.column(name).to_numpy().astype(np.float64)

        kind = pa.schema([("user", users.schema.field("id").type), ("item", items.schema.field("id").type), ("score", pa.float64())])
        if not users.num_rows or not items.num_rows:
            return kind.empty_table()
        items = items.sort_by("id")
        falling = np.argsort(-numbers(items, "length"), kind="stable")  # places among the ids, longest first
        ids, lengths, factors = items.column("id").to_numpy(), numbers(items, "length")[falling], matrix(items)[falling]
        size, least = numbers(users, "size"), numbers(users, "least")
        least[np.isnan(least)] = -np.inf
        with np.errstate(divide="ignore", invalid="ignore"):
            shortest = np.where(size > 0, (least - MARGIN) / (size * (1 + MARGIN)), np.where(least <= MARGIN, -np.inf, np.inf))
        need = np.searchsorted(-lengths, -shortest, side="right")  # the bound leaves so many of the longest items
        turn = np.argsort(-need, kind="stable")
        turn = turn[need[turn] > 0]
        names, wanted = users.column("id").to_numpy(), matrix(users)
        found, at = [], 0
        while at < len(turn):
            n = int(need[turn[at]])
            part = turn[at : at + max(1, SCORES_AT_ONCE // n)]
            at, kept = at + len(part), min(k, n)
            mine, slack = wanted[part], ROUNDING * lengths[0] * size[part]
            scores = mine @ factors[:n].T
            hits = scores >= (least[part] - slack)[:, None]
            for row in np.flatnonzero(hits.sum(axis=1) > 16 * kept):
                kth = np.partition(scores[row], n - kept)[n - kept]
                hits[row] &= scores[row] >= kth - 2 * slack[row]
                if (close := np.flatnonzero(hits[row])).size > 16 * kept:  # very many equal products
                    exact = np.einsum("ij,ij->i", np.broadcast_to(mine[row], (len(close), mine.shape[1])), factors[close])
                    hits[row] = False
                    hits[row, close[np.lexsort((falling[close], -exact))[:kept]]] = True
            rows, columns = np.nonzero(hits)
            exact = np.einsum("ij,ij->i", mine[rows], factors[columns])  # the same for equal rows, whatever stands beside them
            best = np.lexsort((falling[columns], -exact, rows))
            place = np.arange(len(best)) - np.searchsorted(rows, rows[best])
            best = best[place < kept]
            found.append((names[part[rows[best]]], ids[falling[columns[best]]], exact[best]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], schema=kind) if found else kind.empty_table()

    return score


def best_products(users: DataFrame, items: DataFrame, k: int, *, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """user, item and score of the k best items of each user, from factors (id, features) of both."""
    schema = T.StructType([
        T.StructField("user", users.schema["id"].dataType), T.StructField("item", items.schema["id"].dataType), T.StructField("score", T.DoubleType()),
    ])
    people = written(users.select("id", "features", _length(F.col("features")).alias("size")))
    catalogue = blocked(items, block_rows)
    reach = written(catalogue.groupBy("block").agg(F.max("length").alias("longest")))  # a row a block
    last = reach.agg(F.max("block")).first()[0]
    best = written(users.sparkSession.createDataFrame([], schema))
    per_strip = max(1, STRIP_ROWS // block_rows)
    start, width = 0, 1
    while last is not None and start <= last:
        within = F.col("block").between(start, start + width - 1)
        strip = F.floor((F.col("block") - start) / per_strip).cast("int")
        done = best.groupBy("user").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
        bounded = people.join(done, F.col("id") == F.col("user"), "left").select("id", "features", "size", "least")
        strips = reach.filter(within).groupBy(strip.alias("strip")).agg(F.max("longest").alias("longest"))
        longest = strips.agg(F.collect_list(F.struct("strip", "longest")))  # an entry a strip
        bound = F.col("size") * F.col("s")["longest"] * (1 + MARGIN) + MARGIN
        needed = (
            bounded.withColumn("reach", longest.scalar())
            .select("id", "features", "size", "least", F.explode("reach").alias("s"))
            .filter(F.col("least").isNull() | (bound >= F.col("least")))
            .select("id", "features", "size", "least", F.col("s")["strip"].alias("strip"))
        )
        share_rows = F.greatest(F.lit(group_rows), F.least(F.lit(SHARE_ROWS), F.count(F.lit(1)) / SHARES))
        shares = written(needed.groupBy("strip").agg(F.ceil(F.count(F.lit(1)) / share_rows).cast("int").alias("shares")))
        if shares.isEmpty():
            break
        left = needed.join(shares, "strip").withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int"))
        right = catalogue.filter(within).withColumn("strip", strip).join(shares, "strip").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        users_of = left.select("id", "features", "size", "least", "strip", "share").groupBy("strip", "share")
        grouped = users_of.cogroup(right.select("id", "features", "length", "strip", "share").groupBy("strip", "share"))
        best = written(_ranked(best.unionByName(grouped.applyInArrow(_best_of_strip(k), schema)), k))
        start, width = start + width, width * 2
    return best
