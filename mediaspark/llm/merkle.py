"""Merkle manifest of a table: a content-addressed graph of digests, and proofs by descent from its root.

Leaves of a tree, in order of rank, are hashed two by two until one digest is left; subroots of all trees form the top
tree. The graph is stored in records of up to 4,096 children: the digest of a subtree, twelve binary levels high,
points to the digests below it. So a billion leaves are three rounds of records, and no task holds more than one
record at once. A proof descends: from the root's record, the digits of a rank (base 4,096) choose the child at
each round, and the children not chosen are collected. What a record gives is a segment of the path, turned round to
run upwards; segments of lower records come first. A record is opened once for all requests that pass through it, and
its digest must be the one its parent names.

Ranks come from one range partitioning; no task sorts a whole tree. Rows of one key are dealt by a row number too, so a
key with most of the rows spreads over tasks and records like any other. Graph and paths shuffle digests, never texts.

Defined cases: null trees come first and are a tree of their own; null keys come first in their tree; rows of equal keys
take their order from their digests, and equal rows take different places in any order, which changes no digest; an
empty table has no root and gives no proofs; texts of any length are hashed whole, by Spark's own functions; other
columns are ignored. A null value is hashed as ``-``, which no other value is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediaspark.llm.common import saved

# Binary levels of a record, which hence has up to 4,096 children.
HEIGHT = 12
# Offsets of range partitions are broadcast up to so many rows (a row each, or a tree's share of one); beyond, joined.
FEW_OFFSETS = 100_000

# A step of a path: no sibling, a sibling to the left or to the right, then its digest.
ALONE, LEFT, RIGHT = b"\0", b"\1", b"\2"


def hashed(*parts: Column) -> Column:
    """Digest of the parts, one behind the other."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def field(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    shown = value.cast("string")
    return F.when(shown.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown))


def _joined(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def levels_of(digests: list[str], whole: bool, height: int = HEIGHT) -> list[list[str]]:
    """Binary levels from the children up to one digest; a part of a larger tree has ``height`` steps, however few its children."""
    levels = [digests]
    while len(levels[-1]) > 1 if whole else len(levels) <= height:
        below = levels[-1]
        levels.append([_joined(below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def segments_of(levels: list[list[str]]) -> list[bytes]:
    """For each child the steps from it up to the digest of all."""
    paths = [b""] * len(levels[0])
    for height, nodes in enumerate(levels[:-1]):
        raw = [bytes.fromhex(n) for n in nodes]
        steps = [LEFT + raw[i ^ 1] if i & 1 else RIGHT + raw[i ^ 1] if i ^ 1 < len(raw) else ALONE for i in range(len(raw))]
        paths = [path + steps[i >> height] for i, path in enumerate(paths)]
    return paths


def folded(leaf: str, path: bytes) -> tuple[str, str]:
    """The root that leaf and path give, and the digest of all siblings on the path."""
    siblings, at = [], 0
    while at < len(path):
        side = path[at : at + 1]
        at += 1
        if side == ALONE:
            leaf = _joined([leaf])
            continue
        sibling = path[at : at + 32].hex()
        at += 32
        siblings.append(sibling)
        leaf = _joined([sibling, leaf] if side == LEFT else [leaf, sibling])
    return leaf, _joined(siblings)


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Rows with ``rank_`` from 0 within ``tree_`` and the tree's size ``rows_``, by the ordering columns, nulls first."""
    numbered = saved(nodes.withColumn("row_", F.monotonically_increasing_id()))
    keys = ["tree_", *order, "row_"]
    sorted_ = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = saved(sorted_.drop("row_").withColumn("place_", F.monotonically_increasing_id()))
    part = F.shiftright("place_", 33)
    within = Window.partitionBy("tree_")
    offsets = saved(
        placed.groupBy("tree_", part.alias("part_"))
        .agg(F.count(F.lit(1)).alias("n_"), F.min("place_").alias("first_"))
        .select(
            "tree_",
            "part_",
            (F.coalesce(F.sum("n_").over(within.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("first_")).alias("shift_"),
            F.sum("n_").over(within).alias("rows_"),
        )
    )
    small = F.broadcast(offsets) if offsets.count() <= FEW_OFFSETS else offsets
    rank = (F.col("place_") + F.col("shift_")).alias("rank_")
    return placed.withColumn("part_", part).join(small, ["tree_", "part_"]).select(*nodes.columns, rank, "rows_")


@dataclass
class Graph:
    """Records of each round, lowest first, a row for each child: tree_, block_, digest of the record, rank_, node, whole.

    ``whole`` says that no larger tree lies above; then the record has as many levels as its children need.
    """

    rounds: list[DataFrame]
    roots: DataFrame
    height: int = HEIGHT


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One batch for each record: consecutive rows of equal tree_ and block_."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = list(zip(batch.column("tree_").to_pylist(), batch.column("block_").to_pylist(), strict=True))
        start = 0
        for i, key in enumerate(keys):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.concat_batches(held)
                held, start, last = [], i, key
        if len(keys) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.concat_batches(held)


def _levels(record: pa.RecordBatch, height: int) -> list[list[str]]:
    return levels_of([n.hex() for n in record.column("node").to_pylist()], record.column("whole")[0].as_py(), height)


def _record_by_record(rows: DataFrame, name: str, values: Callable[[pa.RecordBatch], list[bytes]]) -> DataFrame:
    """Adds a binary column that ``values`` gives for the children of each record."""

    def read(batches):
        for record in _runs(batches):
            yield pa.RecordBatch.from_arrays([*record.columns, pa.array(values(record), pa.binary())], [*record.schema.names, name])

    dealt = rows.repartition("tree_", "block_").sortWithinPartitions("tree_", "block_", "rank_")
    return dealt.mapInArrow(read, rows.withColumn(name, F.lit(b"")).schema)


def _records(nodes: DataFrame, payload: list[str], height: int) -> DataFrame:
    """A record for each run of nodes (tree_, rank_, rows_, node, payload)."""
    whole = (F.col("rows_") <= 1 << height).alias("whole")
    rows = nodes.select("tree_", F.shiftright("rank_", height).alias("block_"), "rank_", "rows_", whole, "node", *payload)
    return saved(_record_by_record(rows, "digest", lambda r: [bytes.fromhex(_levels(r, height)[-1][0])] * r.num_rows))


def build(nodes: DataFrame, payload: list[str], height: int = HEIGHT) -> Graph:
    """Records over ranked nodes, round by round until every tree has one digest."""
    rounds = [_records(nodes, payload, height)]
    first = F.col("rank_") == F.shiftleft("block_", height)
    while (rounds[-1].agg(F.max("rows_")).first()[0] or 0) > 1 << height:
        size = F.ceil(F.col("rows_") / (1 << height)).cast("long").alias("rows_")
        above = rounds[-1].where(first).select("tree_", F.col("block_").alias("rank_"), size, F.col("digest").alias("node"))
        rounds.append(_records(above, [], height))
    return Graph(rounds, rounds[-1].where(first).select("tree_", "digest"), height)


def _opened(records: DataFrame, frontier: DataFrame, height: int) -> DataFrame:
    """Children of the records that the frontier (tree_, block_, named, path, further columns) asks for, with their paths.

    A record whose children do not give its digest is refused, and so is one that its parent names otherwise.
    """

    def segments(record: pa.RecordBatch) -> list[bytes]:
        levels = _levels(record, height)
        digest, named = record.column("digest")[0].as_py(), record.column("named")[0].as_py()
        if not levels[-1] == [digest.hex()] == [named.hex()]:
            raise ValueError(f"record {digest.hex()} does not hold what {named.hex()} stands for")
        return segments_of(levels)

    found = _record_by_record(records.join(frontier, ["tree_", "block_"]), "segment", segments)
    return found.drop("block_", "digest", "named", "whole", "rows_").withColumn("path", F.concat("segment", "path")).drop("segment")


def descend(graph: Graph, frontier: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Leaves with their paths, from the roots given as tree_, node, path and further columns.

    ``requests`` (tree_, rank_) opens only the records on the way to these leaves; without it all leaves are asked for.
    """
    at = frontier.withColumn("rank_", F.lit(0).cast("long"))
    for i in range(len(graph.rounds) - 1, -1, -1):
        at = _opened(graph.rounds[i], at.withColumnsRenamed({"rank_": "block_", "node": "named"}), graph.height)
        if requests is not None:
            digits = requests.select("tree_", F.shiftright("rank_", graph.height * i).alias("rank_")).distinct()
            at = at.join(digits, ["tree_", "rank_"], "left_semi")
    return at


@dataclass
class Manifest:
    """Graph of each tree's leaves and graph of the subroots; the name of a tree is kept beside its subroot."""

    trees: Graph
    top: Graph


def tree_name(tree: Column) -> Column:
    """A key that is never null; the null tree's sorts before all others."""
    return F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit(""))


def manifest(leaves: DataFrame, *, tree: str, order: list[str], leaf: str, payload: list[str], height: int = HEIGHT) -> Manifest:
    """The graph over leaves (digests as bytes) in trees; ``payload`` columns are kept with the leaves."""
    kept = list(dict.fromkeys([*order, *payload]))
    nodes = leaves.select(tree_name(F.col(tree)).alias("tree_"), *kept, F.col(leaf).alias("node"))
    trees = build(ranked(nodes, [*order, "node"]), payload, height)
    subroots = trees.roots.select(F.lit("").alias("tree_"), F.col("tree_").alias("name"), F.col("digest").alias("node"))
    return Manifest(trees, build(ranked(subroots, ["name"]), ["name"], height))


def proofs(made: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """node, rank_, payload, subroot, root and path of the leaves (all, or the requested tree_ and rank_)."""
    root = made.top.roots.select("tree_", F.col("digest").alias("node"), F.lit(b"").alias("path"), F.col("digest").alias("root"))
    trees = descend(made.top, root).select(F.col("name").alias("tree_"), "node", "path", "root", F.col("node").alias("subroot"))
    return descend(made.trees, saved(trees), requests)
