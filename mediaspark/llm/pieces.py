"""SentencePiece encoding that keeps offsets: every piece is projected to a span of the original bytes.

The model file names its normaliser: a compiled character map (a double array of units over byte strings, and the
replacements they point to) and the rules for white space. A text is normalised here: at each character the longest
key of the map that fits is replaced, and each normalised byte records the original byte at which its character, or
the key replaced, starts. The normalised text is then cut into pieces by the library, whose own normalising is
switched off in the model it gets. Lengths of pieces, added up, are places in the normalised text; the record there
gives the original spans. Decoding is the library's own, of the ids.

Work is one pass in ``mapInArrow``, without a shuffle; a task holds one slice of texts of about ``SLICE`` bytes, or
one longer text.

Defined cases: a null or empty text has no pieces and decodes to the empty text; very long texts are encoded whole
(what a text needs is proportional to its length); null, equal or repeated keys give a row each; an empty table gives
no rows; further columns are ignored, whatever their names. Bytes that are no UTF-8 are read as U+FFFD, and spans
then count in the text so read. Strings like ``</s>`` in a text are ordinary text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediaspark.llm.common import text_bytes

SLICE = 1 << 20
SPACE = "▁".encode()

# Fixed values of the model file's format: field numbers, kinds of pieces and the normaliser's fields.
PIECES, NORMALISER = 1, 3
UNKNOWN_PIECE, USER_PIECE, BYTE_PIECE = 2, 4, 6
MAP, ADD_PREFIX, ONE_SPACE, MARK_SPACE = 2, 3, 4, 5


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
            continue
        size = varint() if wire == 2 else 4 if wire == 5 else 8
        yield key >> 3, message[at : at + size]
        at += size


class CharacterMap:
    """A compiled map from byte strings to replacements; an empty one replaces nothing."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.replacements = compiled[4 + size :]

    def step(self, node: int, byte: int) -> tuple[int, bool] | None:
        """The node that the byte leads to, and whether a key ends there."""
        place = node ^ byte
        unit = self.units[place] if place < len(self.units) else 0
        if unit & 0x800000FF != byte:
            return None
        return place ^ self._offset(unit), bool(unit >> 8 & 1)

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def root(self) -> int:
        return self._offset(self.units[0])

    def longest(self, text: bytes, start: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest key at this place."""
        node, found = self.root(), None
        for i in range(start, len(text)):
            moved = self.step(node, text[i])
            if moved is None:
                break
            node, ends = moved
            if ends:
                found = self.units[node] & 0x7FFFFFFF, i + 1 - start
        if found is None:
            return None
        first, length = found
        return self.replacements[first : self.replacements.index(b"\0", first)], length

    def beginnings(self) -> re.Pattern[bytes] | None:
        """Where a key can start, judged by its first two bytes; all other text needs no look at the map."""
        if not self.units:
            return None
        parts = []
        for first in range(1, 256):
            moved = self.step(self.root(), first)
            if moved is None:
                continue
            node, ends = moved
            seconds = [s for s in range(1, 256) if self.step(node, s)]
            if ends:
                parts.append(re.escape(bytes([first])))
            elif seconds:
                parts.append(re.escape(bytes([first])) + b"[" + b"".join(b"\\x%02x" % s for s in seconds) + b"]")
        return re.compile(b"(?s:" + b"|".join(parts) + b")") if parts else None


class Model:
    """A model file: its normaliser, and the library's encoder and decoder."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as file:
            message = file.read()
        self.lengths, own, users, rules = [], [], [], {}
        for number, value in fields(message):
            if number == PIECES:
                piece = dict(fields(value))
                kind = piece.get(3, 1)
                self.lengths.append(1 if kind == BYTE_PIECE else len(piece[1]))
                if kind == UNKNOWN_PIECE:
                    own.append(len(self.lengths) - 1)
                if kind == USER_PIECE:
                    users.append(piece[1])
            elif number == NORMALISER:
                rules.update(fields(value))
        self.lengths = np.array(self.lengths, np.int64)
        self.unknown = own[0] if own else -1
        self.map = CharacterMap(rules.get(MAP, b""))
        self.beginnings = self.map.beginnings()
        self.users = re.compile(b"|".join(map(re.escape, sorted(users, key=len, reverse=True)))) if users else None
        self.add_prefix, self.one_space, self.mark_space = (bool(rules.get(f, 1)) for f in (ADD_PREFIX, ONE_SPACE, MARK_SPACE))
        self.decoder = SentencePieceProcessor(model_proto=message)
        plain = bytes([MAP << 3 | 2, 0, ADD_PREFIX << 3, 0, ONE_SPACE << 3, 0, MARK_SPACE << 3, 0])
        self.encoder = SentencePieceProcessor(model_proto=message + bytes([NORMALISER << 3 | 2, len(plain)]) + plain)

    def _replaced(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The text after the character map, and for each byte the original start of its character or key."""
        raw = np.frombuffer(text, np.uint8)
        starts = np.maximum.accumulate(np.where(raw & 0xC0 != 0x80, np.arange(len(raw)), 0)) if len(raw) else np.zeros(0, np.int64)
        if self.beginnings is None and self.users is None:
            return raw, starts
        parts, origins, at, kept = [], [], 0, 0
        while at < len(text):
            found = [m for m in (p.search(text, at) for p in (self.users, self.beginnings) if p is not None) if m]
            if not found:
                break
            at = min(m.start() for m in found)
            symbol = self.users.match(text, at) if self.users is not None else None
            change = (symbol[0], len(symbol[0])) if symbol else self.map.longest(text, at)
            if change is None:
                at += 1
                continue
            new, length = change
            parts += [raw[kept:at], np.frombuffer(new, np.uint8)]
            origins += [starts[kept:at], np.full(len(new), at)]
            at += length
            kept = at
        return np.concatenate([*parts, raw[kept:]]), np.concatenate([*origins, starts[kept:]])

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the original place."""
        new, origin = self._replaced(text)
        if self.one_space and len(new):
            space = new == 32
            kept = ~(space & np.concatenate([[True], space[:-1]]))
            new, origin = new[kept], origin[kept]
        if not len(new):
            return b"", np.zeros(1, np.int64)
        if self.add_prefix:
            new, origin = np.concatenate([np.array([32], np.uint8), new]), np.concatenate([origin[:1], origin])
        origin = np.append(origin, len(text))
        normal, mark = new.tobytes(), b" "
        if self.mark_space:
            origin = np.repeat(origin, np.append(np.where(new == 32, len(SPACE), 1), 1))
            normal, mark = normal.replace(b" ", SPACE), SPACE
        end = len(normal)
        while self.one_space and normal.endswith(mark, 0, end):  # here the mark itself counts as a space
            end -= len(mark)
        return normal[:end], origin[: end + 1]

    def encode(self, texts: list[bytes]) -> tuple[list[list[int]], list[np.ndarray], list[np.ndarray]]:
        """Ids of each text, and where in its bytes each piece begins and ends."""
        normal, origins = zip(*map(self.normalise, texts), strict=True) if texts else ((), ())
        named = [n.decode() for n in normal]
        ids = self.encoder.encode(named, num_threads=1)
        begins, ends = [], []
        for text, own, origin in zip(named, ids, origins, strict=True):
            lengths = self.lengths[own] if own else np.zeros(0, np.int64)
            if self.unknown in own:  # an unknown piece is as long as what it stands for
                lengths = np.array([len(p.encode()) if i == self.unknown else n
                                    for p, i, n in zip(self.encoder.encode(text, out_type=str), own, lengths, strict=True)])
            places = np.concatenate([[0], np.cumsum(lengths)])
            if places[-1] != len(origin) - 1:
                raise ValueError("pieces do not add up to the normalised text")
            begins.append(origin[places[:-1]])
            ends.append(origin[places[1:]])
        return ids, begins, ends

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.decoder.decode(ids) if ids else []


@lru_cache(maxsize=2)
def loaded(path: str) -> Model:
    """The model, read once in each worker process."""
    return Model(path)


def _slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes together."""
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def encoded(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key_, ids, begins, ends (one of each for every piece) and decoded of every text.

    ``path`` is the model file, which must lie there on every worker.
    """
    whole = T.ArrayType(T.IntegerType(), False)
    places = T.ArrayType(T.LongType(), False)
    schema = T.StructType([
        T.StructField("key_", docs.schema[key].dataType),
        T.StructField("ids", whole, False),
        T.StructField("begins", places, False),
        T.StructField("ends", places, False),
        T.StructField("decoded", T.StringType(), False),
    ])

    def read(batches):
        model = loaded(path)
        for batch in batches:
            texts = [_valid(t) for t in text_bytes(batch.column(1))]
            for i, j in _slices([len(t) for t in texts], SLICE):
                ids, begins, ends = model.encode(texts[i:j])
                lists = [_listed(ids, pa.int32()), _listed(begins, pa.int64()), _listed(ends, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *lists, pa.array(model.decode(ids), pa.string())], ["key_", "ids", "begins", "ends", "decoded"]
                )

    return docs.select(F.col(key).alias("key_"), F.col(text).alias("text_")).mapInArrow(read, schema)


def _listed(rows: list, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


def _valid(text: bytes) -> bytes:
    try:
        text.decode()
    except UnicodeDecodeError:
        return text.decode(errors="replace").encode()
    return text
