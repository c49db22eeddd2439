"""Best-fit packing of token sequences, hierarchically.

``token_pieces`` turns texts into pieces of at most ``capacity`` tokens. ``pack`` then packs items into
bins: items are dealt by a hash of their number, so that no order of the files matters; every task best-fits
its own, longest first, in blocks of bounded size, and emits bins that are nearly full. All underfull ones,
now items themselves, are merged by a tree: dealt anew into as many blocks as they need, each best-fitted
again, round after round until they are one block, or until a round takes less than ``LEAST_GAIN`` of
them away. Bins left then stay as they are: no item is ever dropped, no number of bins is capped.

Defined cases: a null or empty text is one piece with the closing id only; a very long text is many pieces,
written in batches of 256 texts; equal rows are packed each for itself; a null key is carried; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediaspark.llm.common import saved

CAPACITY = 1024
BLOCK = 65_536
NEARLY_FULL = 0.99
LEAST_GAIN = 0.02
END_ID = 2

PIECES = "key_ long, piece int, start long, length int, ids_crc32 long"


class Encoder:
    """Ids of the tokenizer file; its twin as ranks is faster and stands in for ordinary Latin text.

    Both give the same ids there; texts with other scripts or the special token go to the file itself.
    """

    OTHER = re.compile("[^\t\n\r -~¡-ɏ–-…]")

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or self.OTHER.search(text) or any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    ranks: str | None = None,
    pattern: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of each text's ids and the closing id; a first piece takes what whole ones leave over.

    The tokenizer's files lie on every worker. ``with_ids`` adds the ids themselves. Each piece has an
    ``item_`` number of its own, written with it.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # bounded output batches, also for long texts
                rows, kept = [], []
                part = batch.slice(at, 256)
                for key_, text_ in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.append(encoder.ids(text_ or ""), np.uint32(end_id)).astype("<u4")
                    first = len(ids) % capacity or capacity
                    starts = [0, *range(first, len(ids), capacity)]
                    for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                        raw = ids[a:b].tobytes()
                        rows.append((key_, piece, a, b - a, zlib.crc32(raw)))
                        kept.append(raw)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["key_", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    chosen = docs.select(F.col(key).cast("long").alias("key_"), F.col(text).alias("text_"))
    pieces = chosen.mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))
    return saved(pieces.withColumn("item_", F.monotonically_increasing_id()))


BINS = "bin long, fill int, items array<long>, offsets array<int>, open boolean"


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Items by bin, longest first, each into the fullest bin that has room; one bit for each gap that some bin has."""
    bins: list[list[int]] = []
    with_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        room = gaps >> size
        if room:
            gap = size + (room & -room).bit_length() - 1
            into = with_gap[gap].pop()
            if not with_gap[gap]:
                gaps &= ~(1 << gap)
            bins[into].append(item)
        else:
            gap, into = capacity, len(bins)
            bins.append([item])
        left = gap - size
        if left:
            with_gap[left].append(into)
            gaps |= 1 << left
    return bins


def _packed(ids: list[int], fills: np.ndarray, members: list, capacity: int, last: bool) -> pa.RecordBatch:
    """Best-fit one block; ``members`` has items and offsets of each entry."""
    rows = []
    for entries in best_fit(fills, capacity):
        items: list[int] = []
        offsets: list[int] = []
        at = 0
        for e in entries:
            items += members[e][0]
            offsets += [at + o for o in members[e][1]]
            at += int(fills[e])
        rows.append((ids[entries[0]], at, items, offsets))
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()))
    arrays = [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([not last and r[1] < NEARLY_FULL * capacity for r in rows], pa.bool_())], ["bin", "fill", "items", "offsets", "open"])


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """item_, sequence_id and offset for each (item_, length); lengths lie in 1 … capacity."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        sizes: list[int] = []
        for batch in batches:
            ids += batch.column("item_").to_pylist()
            sizes += batch.column("length").to_pylist()
            while len(ids) >= block:
                yield _packed(ids[:block], np.array(sizes[:block]), [([i], [0]) for i in ids[:block]], capacity, False)
                ids, sizes = ids[block:], sizes[block:]
        if ids:
            yield _packed(ids, np.array(sizes), [([i], [0]) for i in ids], capacity, False)

    def merged(last: bool):
        def merge(table: pa.Table) -> pa.Table:
            table = table.sort_by("bin")
            members = list(zip(table["items"].to_pylist(), table["offsets"].to_pylist(), strict=True))
            return pa.Table.from_batches([_packed(table["bin"].to_pylist(), table["fill"].to_numpy(), members, capacity, last)])

        return merge

    whole = items.where(F.col("length") >= capacity).select("item_", F.col("item_").alias("sequence_id"), F.lit(0).alias("offset"))
    dealt = items.where(F.col("length") < capacity).select("item_", "length").repartition("item_").sortWithinPartitions(F.xxhash64("item_"), "item_")
    level = saved(dealt.mapInArrow(local, BINS))
    done, number = [level.where("NOT open")], 0
    left = level.where("open").count()
    while left:
        blocks = -(-left * 2 // block)  # half full on average, so that chance does not overfill one
        group = F.pmod(F.xxhash64("bin", F.lit(number)), F.lit(blocks))
        level = saved(level.where("open").groupBy(group.alias("block")).applyInArrow(merged(blocks == 1), BINS))
        done.append(level.where("NOT open"))
        before, left, number = left, level.where("open").count(), number + 1
        if left > (1 - LEAST_GAIN) * before:
            done.append(level.where("open"))
            break
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    pairs = F.inline(F.arrays_zip("items", "offsets"))
    return whole.union(placed.select(pairs, "bin").select("items", "bin", "offsets"))
