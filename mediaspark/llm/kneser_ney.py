"""An interpolated modified Kneser-Ney model of order 2 or 3, counted in Spark, kept as sorted hash arrays, mapped by workers.

Words are 64-bit hashes. Tasks count blocks of text and pass on packed arrays: sorted, as differences, byte by
byte, so that the shuffle compresses them. Word counts come first. Pairs of words are then dealt by their first
word, those of a first word with more than a shard's share of all tokens by both words, so no shard grows with a
hot word. Each shard is merged into one sorted array of pair hashes with their counts; what it says about single
words (how many words precede it, how often pairs that start with it occur) goes on to the shards of words. The
arrays lie in the shared folder, which must be mounted as a path on all workers; scoring tasks map them, look up the
distinct pairs of a block of texts at a time, and touch only the pages they need. The driver sees sums only.

P(w | v) = max(c(v, w) - D, 0) / c(v) + g(v) P(w), with P(w) the same of the numbers of different words before w,
interpolated with 1 / (V + 1). D has three values each, from counts of counts. A text starts with a mark and ends with
one; only the end is a token.

Order 3 counts triples of words in the same way, dealt by their middle word, those of a hot one by the two words of
history, and if both are hot by all three. What they say about pairs (how many words precede a pair, how often it goes
on, and into how many triples) goes on to the shards of pairs, and what pairs say to the shards of words. Then
P(w | u, v) = max(c(u, v, w) - D, 0) / c(u, v) + g(u, v) P(w | v), and P(w | v) is made of the numbers of different words
before the pair v, w; pairs with the start, which nothing precedes, keep their counts. The first token has one word of
history, the start; after a pair that training does not have, P(w | v) counts alone.

Defined cases: a null or empty text is its end alone; equal texts get equal scores; a word that training does not
have gets the share of unknown words; after such a word P(w) counts alone; without training texts every token has
probability 1; an empty table gives no rows; only key and text are read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediaspark.llm.common import discard, removed_at_exit, saved, scratch, text_bytes

BLOCK_TOKENS = 2_000_000
SHARD_TOKENS = 1_500_000
WORD_SHARD_TOKENS = 8_000_000
GROUP_BYTES = 64_000_000
START, END = np.uint64(1), np.uint64(2)
FEW = 255  # counts from here on lie in an array of their own

_MIX = np.uint64(0x9E3779B97F4A7C15)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first ^ (first >> np.uint64(29))) * _MIX + second
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Bytes of the numbers, plane by plane; of their differences if they rise."""
    if rising:
        values = np.diff(values, prepend=values.dtype.type(0))
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def unpack(raw: bytes, kind, rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    values = np.ascontiguousarray(planes.T).view(kind).reshape(-1)
    return np.cumsum(values, dtype=kind) if rising else values


class Hashes(dict):
    """Hash of each word, kept as words come up."""

    ROOM = 400_000

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= self.ROOM:
            self.clear()
        self[word] = found = max(3, xxh3_64_intdigest(word))
        return found


def blocks(batches: Iterator[pa.RecordBatch], column: int, tokens: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token hashes of many texts in a row, each text with its end, and how many tokens each text has."""
    hashes = Hashes()
    found, sizes, total = [], [], 0
    for batch in batches:
        for text in text_bytes(batch.column(column)):
            words = text.lower().split()
            own = np.empty(len(words) + 1, np.uint64)
            own[:-1] = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
            own[-1] = END
            found.append(own)
            sizes.append(len(own))
            total += len(own)
            if total >= tokens:
                yield np.concatenate(found), np.array(sizes)
                found, sizes, total = [], [], 0
    if sizes:
        yield np.concatenate(found), np.array(sizes)


def before(tokens: np.ndarray) -> np.ndarray:
    """The token before each, or the start."""
    first = np.empty_like(tokens)
    first[0] = START
    first[1:] = np.where(tokens[:-1] == END, START, tokens[:-1])
    return first


def summed(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, the place of one of each, and its sums of the columns."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], order[starts], [np.add.reduceat(c[order], starts) if len(starts) else c for c in columns]


def by_shard(shards: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs with the places of its entries, in their order."""
    order = np.argsort(shards, kind="stable")
    cuts = np.flatnonzero(np.diff(shards[order])) + 1
    for places in np.split(order, cuts):
        if len(places):
            yield int(shards[places[0]]), places


WORDS = "shard int, word binary, n binary, before binary, once binary, twice binary, more binary, total binary"
_WORD_COLUMNS = ("n", "before", "once", "twice", "more", "total")
PAIRS = "shard int, first binary, second binary, before binary, total binary, once binary, twice binary, more binary"
_PAIR_COLUMNS = ("before", "total", "once", "twice", "more")


def _word_rows(words: np.ndarray, columns: dict[str, np.ndarray], shards: int) -> pa.RecordBatch:
    rows = []
    for shard, places in by_shard((words % np.uint64(shards)).astype(np.int64)):
        values = [pack(columns[c][places].astype(np.int64)) if c in columns else None for c in _WORD_COLUMNS]
        rows.append((shard, pack(words[places], rising=True), *values))
    kinds = [pa.int32(), *[pa.binary()] * 7]
    arrays = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
    return pa.RecordBatch.from_arrays(arrays, ["shard", "word", *_WORD_COLUMNS])


def _merged_words(table: pa.Table) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    raws = [unpack(x, np.uint64, rising=True) for x in table["word"].to_pylist()]
    columns = []
    for c in _WORD_COLUMNS:
        values = table[c].to_pylist()
        columns.append(np.concatenate([np.zeros(len(r), np.int64) if v is None else unpack(v, np.int64) for r, v in zip(raws, values, strict=True)]))
    words, _, sums = summed(np.concatenate(raws), columns)
    return words, dict(zip(_WORD_COLUMNS, sums, strict=True))


def _pair_rows(first: np.ndarray, second: np.ndarray, columns: dict[str, np.ndarray], hot: np.ndarray, shards: int) -> pa.RecordBatch:
    rows = []
    order = np.argsort(first, kind="stable")
    for shard, at in by_shard(pair_shard(first[order], second[order], hot, shards)):
        places = order[at]
        values = [pack(columns[c][places].astype(np.int64)) if c in columns else None for c in _PAIR_COLUMNS]
        rows.append((shard, pack(first[places], rising=True), pack(second[places]), *values))
    kinds = [pa.int32(), *[pa.binary()] * 7]
    arrays = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
    return pa.RecordBatch.from_arrays(arrays, ["shard", "first", "second", *_PAIR_COLUMNS])


def _small(columns: dict[str, np.ndarray], keys: np.ndarray) -> dict[str, np.ndarray]:
    """Columns as bytes; keys that have a large number in any lie apart with all of theirs."""
    many = np.flatnonzero(np.any([c >= FEW for c in columns.values()], axis=0))
    found = {name: np.minimum(c, FEW).astype(np.uint8) for name, c in columns.items()}
    return found | {"many": keys[many]} | {f"many_{name}": c[many] for name, c in columns.items()}


def _local(path: str) -> str:
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the model's arrays need a folder that workers can map, not {path}")
    return parts.path


def _write(path: str, **arrays: np.ndarray) -> None:
    """Whole files or none, also when a task runs twice."""
    for name, values in arrays.items():
        whole = f"{path}.{name}.npy"
        part = f"{whole}.{os.getpid()}.{np.random.default_rng().integers(1 << 60)}"
        with open(part, "wb") as out:
            np.save(out, values)
        os.replace(part, whole)


def _of_counts(values: np.ndarray) -> list[int]:
    return [int((values == k).sum()) for k in (1, 2, 3, 4)]


def discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """Three discounts from counts of counts; a half of the count where those do not say."""
    y = ones / (ones + 2 * twos) if ones else 0.0
    found = []
    for k, (n, after) in enumerate(((ones, twos), (twos, threes), (threes, fours)), start=1):
        d = k - (k + 1) * y * after / n if n else k / 2
        found.append(d if 0 < d < k else k / 2)
    return tuple(found)


def by_kind(counts: np.ndarray) -> list[np.ndarray]:
    return [(counts == 1).astype(np.int64), (counts == 2).astype(np.int64), (counts > 2).astype(np.int64)]


@dataclass(frozen=True)
class Model:
    folder: str
    pair_shards: int
    word_shards: int
    hot: np.ndarray
    tokens: int
    words: int
    pairs: int
    texts: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_rest: float
    order: int = 2
    triple_discounts: tuple[float, float, float] | None = None


def pair_shard(first: np.ndarray, second: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    dealt = np.where(np.isin(first, hot), pair_keys(first, second), first)
    return ((dealt >> np.uint64(7)) % np.uint64(shards)).astype(np.int64)


def triple_shard(first: np.ndarray, second: np.ndarray, third: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    history = pair_keys(first, second)
    split = np.where(np.isin(first, hot), pair_keys(history, third), history)
    dealt = np.where(np.isin(second, hot), split, second)
    return ((dealt >> np.uint64(7)) % np.uint64(shards)).astype(np.int64)


def before_that(first: np.ndarray) -> np.ndarray:
    """The token before the token before each, given the latter; the start also where that is the start."""
    found = np.concatenate(([START], first[:-1]))
    return np.where(first == START, START, found)


def word_groups(chosen: DataFrame) -> tuple[int, int]:
    """Number of texts, and of groups for the first count of words: by bytes, as few texts may be long."""
    sums = chosen.agg(F.count(F.lit(1)).alias("texts"), F.sum(F.octet_length("text_")).alias("bytes")).first()
    return sums.texts, max(1, -(-(sums.bytes or 0) // GROUP_BYTES))


def train(docs: DataFrame, text: str = "text", *, order: int = 2) -> Model:
    """Count all texts and write the arrays."""
    if order not in (2, 3):
        raise ValueError(f"order is 2 or 3, not {order}")
    spark = docs.sparkSession
    chosen = docs.select(F.col(text).alias("text_"))
    texts, early = word_groups(chosen)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _ in blocks(batches, 0, BLOCK_TOKENS):
            words, counts = np.unique(tokens, return_counts=True)
            yield _word_rows(words, {"n": counts}, early)

    def merge_words(table: pa.Table) -> pa.Table:
        words, found = _merged_words(table)
        rows = [(words[i : i + 500_000], found["n"][i : i + 500_000]) for i in range(0, len(words), 500_000)]
        return pa.Table.from_pydict({
            "word": pa.array([pack(w, rising=True) for w, _ in rows], pa.binary()),
            "n": pa.array([pack(n) for _, n in rows], pa.binary()),
            "words": pa.array([len(w) for w, _ in rows], pa.int64()),
            "tokens": pa.array([int(n.sum()) for _, n in rows], pa.int64()),
        })

    counted = saved(chosen.mapInArrow(count_words, WORDS).groupBy("shard").applyInArrow(merge_words, "word binary, n binary, words long, tokens long"))
    sums = counted.agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).first()
    tokens, words = sums.tokens or 0, sums.words or 0
    pair_shards, word_shards = max(1, -(-tokens // SHARD_TOKENS)), max(1, -(-tokens // WORD_SHARD_TOKENS))
    share = tokens / pair_shards / 2

    def hot_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                chosen_words = unpack(word, np.uint64, rising=True)[unpack(n, np.int64) > share]
                yield pa.RecordBatch.from_arrays([pa.array(chosen_words.view(np.int64))], ["word"])

    # each has more than half a shard's share of the tokens, so there are fewer than twice the shards
    hot = counted.select("word", "n").mapInArrow(hot_words, "word long").toPandas()["word"].to_numpy(np.int64).view(np.uint64)
    hot = np.sort(np.append(hot, START))
    folder = _local(removed_at_exit(spark, scratch(spark)))

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for second, _ in blocks(batches, 0, BLOCK_TOKENS):
            first = before(second)
            keys, place, (counts,) = summed(pair_keys(first, second), [np.ones(len(second), np.int64)])
            first, second = first[place], second[place]
            by_first = np.argsort(first, kind="stable")
            first, second, counts = first[by_first], second[by_first], counts[by_first].astype(np.uint32)
            rows = []
            for shard, at in by_shard(pair_shard(first, second, hot, pair_shards)):
                rows.append((shard, pack(first[at], rising=True), pack(second[at]), pack(counts[at])))
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "first", "second", "n"])

    def merge_pairs(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        first = np.concatenate([unpack(x, np.uint64, rising=True) for x in table["first"].to_pylist()])
        second = np.concatenate([unpack(x, np.uint64) for x in table["second"].to_pylist()])
        n = np.concatenate([unpack(x, np.uint32) for x in table["n"].to_pylist()]).astype(np.int64)
        keys, place, (n,) = summed(pair_keys(first, second), [n])
        first, second = first[place], second[place]
        many = np.flatnonzero(n >= FEW)
        os.makedirs(folder, exist_ok=True)
        _write(f"{folder}/pairs-{shard}", keys=keys, counts=np.minimum(n, FEW).astype(np.uint8), many=keys[many], many_counts=n[many])
        return of_pairs(first, second, n)

    def of_pairs(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> pa.Table:
        """What a shard's pairs say about words, and counts of their counts."""
        starts, _, (*kinds, total) = summed(first, [*by_kind(n), n])
        ends, ahead = np.unique(second, return_counts=True)
        parts = [
            _word_rows(starts, dict(zip(("once", "twice", "more"), kinds, strict=True)) | ({"total": total} if order == 3 else {}), word_shards),
            _word_rows(ends, {"before": ahead}, word_shards),
        ]
        found = pa.Table.from_batches(parts)
        counts = pa.array([_of_counts(n) + [len(n)]] + [None] * (found.num_rows - 1), pa.list_(pa.int64()))
        return found.append_column("counts", counts)

    def count_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for third, _ in blocks(batches, 0, BLOCK_TOKENS):
            second = before(third)
            first = before_that(second)
            _, place, (counts,) = summed(pair_keys(pair_keys(first, second), third), [np.ones(len(third), np.int64)])
            by_second = np.argsort(second[place], kind="stable")
            place, counts = place[by_second], counts[by_second].astype(np.uint32)
            first, second, third = first[place], second[place], third[place]
            rows = []
            for shard, at in by_shard(triple_shard(first, second, third, hot, pair_shards)):
                rows.append((shard, pack(first[at]), pack(second[at], rising=True), pack(third[at]), pack(counts[at])))
            kinds = (pa.int32(), *[pa.binary()] * 4)
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "first", "second", "third", "n"])

    def merge_triples(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        first, third = (np.concatenate([unpack(x, np.uint64) for x in table[c].to_pylist()]) for c in ("first", "third"))
        second = np.concatenate([unpack(x, np.uint64, rising=True) for x in table["second"].to_pylist()])
        n = np.concatenate([unpack(x, np.uint32) for x in table["n"].to_pylist()]).astype(np.int64)
        keys, place, (n,) = summed(pair_keys(pair_keys(first, second), third), [n])
        first, second, third = first[place], second[place], third[place]
        # a first token has no triple; its count goes on to the pair of the start and the token
        inside = second != START
        _, ends, (ahead,) = summed(pair_keys(second, third), [np.where(inside, 1, n)])
        parts = [_pair_rows(second[ends], third[ends], {"before": ahead}, hot, pair_shards)]
        keys, first, second, n = keys[inside], first[inside], second[inside], n[inside]
        os.makedirs(folder, exist_ok=True)
        _write(f"{folder}/triples-{shard}", keys=keys, **_small({"counts": n}, keys))
        _, starts, sums = summed(pair_keys(first, second), [n, *by_kind(n)])
        parts.append(_pair_rows(first[starts], second[starts], dict(zip(_PAIR_COLUMNS[1:], sums, strict=True)), hot, pair_shards))
        found = pa.Table.from_batches(parts)
        return found.append_column("counts", pa.array([_of_counts(n) + [len(n)]] + [None] * (found.num_rows - 1), pa.list_(pa.int64())))

    def merge_pairs_of_triples(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        firsts = [unpack(x, np.uint64, rising=True) for x in table["first"].to_pylist()]
        second = np.concatenate([unpack(x, np.uint64) for x in table["second"].to_pylist()])
        columns = []
        for c in _PAIR_COLUMNS:
            values = table[c].to_pylist()
            columns.append(np.concatenate([np.zeros(len(f), np.int64) if v is None else unpack(v, np.int64) for f, v in zip(firsts, values, strict=True)]))
        first = np.concatenate(firsts)
        keys, place, sums = summed(pair_keys(first, second), columns)
        os.makedirs(folder, exist_ok=True)
        _write(f"{folder}/pairs-{shard}", keys=keys, **_small(dict(zip(_PAIR_COLUMNS, sums, strict=True)), keys))
        return of_pairs(first[place], second[place], sums[0])

    triple_discounts = None
    if order == 3:
        triple_rows = chosen.mapInArrow(count_triples, "shard int, first binary, second binary, third binary, n binary")
        of_triples = saved(triple_rows.groupBy("shard").applyInArrow(merge_triples, PAIRS + ", counts array<long>"))
        triple_counts = [int(x or 0) for x in of_triples.agg(*(F.sum(F.get("counts", F.lit(i))) for i in range(4))).first()]
        triple_discounts = discounts(*triple_counts)
        pair_rows, merged = of_triples.drop("counts"), merge_pairs_of_triples
    else:
        pair_rows, merged = chosen.mapInArrow(count_pairs, "shard int, first binary, second binary, n binary"), merge_pairs
    partial = saved(pair_rows.groupBy("shard").applyInArrow(merged, WORDS + ", counts array<long>"))
    if order == 3:
        discard(of_triples)
    pair_counts = [int(x or 0) for x in partial.agg(*(F.sum(F.get("counts", F.lit(i))) for i in range(5))).first()]

    def deal_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                yield _word_rows(unpack(word, np.uint64, rising=True), {"n": unpack(n, np.int64)}, word_shards)

    def write_words(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        found_words, found = _merged_words(table)
        if order == 2:
            found.pop("total")
        os.makedirs(folder, exist_ok=True)
        _write(f"{folder}/words-{shard}", keys=found_words, **found)
        return pa.Table.from_pydict({"counts": [_of_counts(found["before"]) + [int((found["before"] > 0).sum())]]})

    dealt = counted.select("word", "n").mapInArrow(deal_words, WORDS).union(partial.drop("counts"))
    written = dealt.groupBy("shard").applyInArrow(write_words, "counts array<long>")
    word_counts = [int(x or 0) for x in written.agg(*(F.sum(F.get("counts", F.lit(i))) for i in range(5))).first()]
    d = discounts(*word_counts[:4])
    more = word_counts[4] - word_counts[0] - word_counts[1]
    rest = (d[0] * word_counts[0] + d[1] * word_counts[1] + d[2] * more) / max(1, pair_counts[4])
    return Model(folder, pair_shards, word_shards, hot, tokens, words, pair_counts[4], texts, discounts(*pair_counts[:4]), d, rest, order, triple_discounts)


class Arrays:
    """The model's arrays, mapped as they are needed."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.open: dict[str, np.ndarray | None] = {}

    def array(self, name: str) -> np.ndarray | None:
        if name not in self.open:
            path = f"{self.model.folder}/{name}.npy"
            self.open[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self.open[name]

    def look_up(self, prefix: str, shard: np.ndarray, keys: np.ndarray, columns: tuple[str, ...], names: str = "keys") -> list[np.ndarray]:
        """Values of the keys, 0 where there are none; one search for each shard."""
        found = [np.zeros(len(keys), np.int64) for _ in columns]
        for number, at in by_shard(shard):
            there = self.array(f"{prefix}-{number}.{names}")
            if there is None or not len(there):
                continue
            asked = keys[at]
            order = np.argsort(asked)
            place = np.minimum(np.searchsorted(there, asked[order]), len(there) - 1)
            hit = there[place] == asked[order]
            for values, name in zip(found, columns, strict=True):
                values[at[order[hit]]] = self.array(f"{prefix}-{number}.{name}")[place[hit]]
        return found


    def look_up_small(self, prefix: str, shard: np.ndarray, keys: np.ndarray, columns: tuple[str, ...]) -> list[np.ndarray]:
        """As look_up, for columns that ``_small`` has written."""
        found = self.look_up(prefix, shard, keys, columns)
        large = np.flatnonzero(np.any([c == FEW for c in found], axis=0))
        if len(large):
            for values, whole in zip(found, self.look_up(prefix, shard[large], keys[large], tuple(f"many_{c}" for c in columns), "many"), strict=True):
                values[large] = whole
        return found


def _taken(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def scored(tokens: np.ndarray, arrays: Arrays) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training count, logarithm of the base and of the model's probability for each token."""
    m = arrays.model
    if not m.tokens:
        return np.zeros(len(tokens), np.int64), np.full(len(tokens), -np.log10(m.words + 1)), np.zeros(len(tokens))
    if m.order == 3:
        return _scored_by_triples(tokens, arrays)
    first = before(tokens)
    distinct, place, back = np.unique(pair_keys(first, tokens), return_index=True, return_inverse=True)
    one, two = first[place], tokens[place]
    shard = pair_shard(one, two, m.hot, m.pair_shards)
    (pair,) = arrays.look_up("pairs", shard, distinct, ("counts",))
    large = np.flatnonzero(pair == FEW)
    (pair[large],) = arrays.look_up("pairs", shard[large], distinct[large], ("many_counts",), "many")
    words, where = np.unique(np.concatenate((one, two)), return_inverse=True)
    n, ahead, once, twice, more = arrays.look_up("words", (words % np.uint64(m.word_shards)).astype(np.int64), words, _WORD_COLUMNS[:5])
    lower = (ahead - _taken(ahead, m.word_discounts)) / m.pairs + m.word_rest / (m.words + 1)
    a, b = where[: len(one)], where[len(one) :]
    total = np.where(one == START, m.texts, n[a]).astype(float)
    d = m.pair_discounts
    left = d[0] * once[a] + d[1] * twice[a] + d[2] * more[a]
    seen = total > 0
    p = np.where(seen, (pair - _taken(pair, d) + left * lower[b]) / np.where(seen, total, 1), lower[b])
    base = np.log10((n[b] + 1) / (m.tokens + m.words + 1))
    return n[b][back], base[back], np.log10(p)[back]


def _scored_by_triples(tokens: np.ndarray, arrays: Arrays) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    m = arrays.model
    second = before(tokens)
    first = before_that(second)
    distinct, place, back = np.unique(pair_keys(pair_keys(first, second), tokens), return_index=True, return_inverse=True)
    u, v, w = first[place], second[place], tokens[place]
    (triple,) = arrays.look_up_small("triples", triple_shard(u, v, w, m.hot, m.pair_shards), distinct, ("counts",))
    one, two = np.concatenate((u, v)), np.concatenate((v, w))
    pairs, at, where = np.unique(pair_keys(one, two), return_index=True, return_inverse=True)
    found = arrays.look_up_small("pairs", pair_shard(one[at], two[at], m.hot, m.pair_shards), pairs, _PAIR_COLUMNS)
    history, pair = where[: len(u)], found[0][where[len(u) :]]
    words, where = np.unique(two, return_inverse=True)
    n, ahead, once, twice, more, total = arrays.look_up("words", (words % np.uint64(m.word_shards)).astype(np.int64), words, _WORD_COLUMNS)
    lower = (ahead - _taken(ahead, m.word_discounts)) / m.pairs + m.word_rest / (m.words + 1)
    a, b = where[: len(u)], where[len(u) :]

    def mixed(count: np.ndarray, total: np.ndarray, kinds: list[np.ndarray], d: tuple[float, float, float], below: np.ndarray) -> np.ndarray:
        left = d[0] * kinds[0] + d[1] * kinds[1] + d[2] * kinds[2]
        return np.where(total > 0, (count - _taken(count, d) + left * below) / np.maximum(total, 1), below)

    p = mixed(pair, total[a], [once[a], twice[a], more[a]], m.pair_discounts, lower[b])
    total, *kinds = (c[history] for c in found[1:])
    p = mixed(triple, np.where(v == START, 0, total), kinds, m.triple_discounts, p)
    base = np.log10((n[b] + 1) / (m.tokens + m.words + 1))
    return n[b][back], base[back], np.log10(p)[back]


SCORES = "key_ long, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Numbers of tokens and known tokens, the base's and the model's log10 probability, of every text."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(model)
        for batch in batches:
            at = 0
            for tokens, sizes in blocks(iter([batch]), 1, BLOCK_TOKENS // 2):
                n, base, own = scored(tokens, arrays)
                starts = np.cumsum(sizes) - sizes
                columns = [np.add.reduceat(x, starts) for x in ((n > 0).astype(np.int64), base, own)]
                keys = batch.column(0).slice(at, len(sizes))
                at += len(sizes)
                yield pa.RecordBatch.from_arrays([keys, pa.array(sizes), *map(pa.array, columns)], ["key_", "n_tokens", "n_known", "base_score", "score"])

    return docs.select(F.col(key).cast("long").alias("key_"), F.col(text).alias("text_")).mapInArrow(look, SCORES)
