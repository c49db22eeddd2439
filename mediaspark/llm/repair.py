"""Repair of conversation structure by depth-first branch and bound.

Every row of a conversation is kept (0), given the role user or assistant (1) or deleted (2); empty rows of either role
may be inserted anywhere (5). Blank rows and repeats must be deleted; a row that ends within a sentence and is not
deleted costs 5 more. What is left must read as an optional system row and any number of user and assistant rows in
turn. Of the cheapest edits, those whose initials (D, I, K, R) come first as text are taken.

The search is depth first with a stack of its own. A node is (rows done, role last written). Suffix bounds give each
node the least cost of the rows still to come; a prefix is left when its cost and that bound exceed the incumbent's, when
they equal it and its initials are already the greater, or when the node's dominance table holds a better prefix.
Two prefixes of one cost at a node never begin one another (each further insertion costs), so the better stays so.
The bounds are exact on cost, so the first dive meets them and the rest of the stack only proves it: work is linear in rows.

A conversation of any length is cut into segments of at most ``SEGMENT`` rows, each searched in its own place of a
range partitioning; where a segment is not a conversation's first or last, for each role it may begin and end with.
What one segment gives for each pair is joined to the next by the same order. Texts travel once, for the hash of the
repaired rows; that hash is a chain over one conversation, so its rows stream through one task, a row at a time, which
holds initials only (a byte a row). Repeats are found by the least place of each (conversation, role, digest of the
text), added up before the shuffle; AQE splits the join where one of them is hot.

Defined cases: rows are ordered by turn, nulls first, those of one turn by role and by the SHA-256 of their text; a
null conversation is a conversation; a null role or text counts as one space; a role's initial is its first character
as it is, an empty role has none; equal rows of one turn are repeats; very long texts are read whole; conversations
without live rows have zeros and an empty repair; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediaspark.llm.common import saved

SEGMENT = 4_096

# Costs, the faults of a row, and the roles that may be written.
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
ROLES = {"u": "user", "a": "assistant"}

# Roles last written: nothing, system, user, assistant; what may follow; where a conversation may end.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
WRITES = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LETTER = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
ENDS = (NOTHING, ASSISTANT)
EVERY = tuple(range(4))
NEVER = 1 << 60
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class Way(NamedTuple):
    cost: int
    audit: str


def _moves(state: int, initial: str, fault: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a row, by initial: letter, cost and role then last written."""
    yield "D", DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    more = CUT_SHORT if fault == TRUNCATED else 0
    if state == NOTHING and initial == "s":
        yield "K", KEEP + more, SYSTEM
    if initial == LETTER[WRITES[state]]:
        yield "K", KEEP + more, WRITES[state]
    yield "R", REROLE + more, WRITES[state]


def suffix_bounds(rows: list[tuple[str, int]], ends: Iterable[int]) -> list[list[int]]:
    """For each number of rows done and role last written, a cost that what follows cannot go below."""

    def with_insertions(costs: list[int]) -> list[int]:
        for _ in range(2):  # a third insertion in one place comes back to a role that one insertion gives
            costs = [min(costs[s], INSERT + costs[WRITES[s]]) for s in EVERY]
        return costs

    bounds = [with_insertions([0 if s in ends else NEVER for s in EVERY])]
    for initial, fault in reversed(rows):
        below = bounds[-1]
        bounds.append(with_insertions([min(cost + below[to] for _, cost, to in _moves(s, initial, fault)) for s in EVERY]))
    return bounds[::-1]


def cheapest(rows: list[tuple[str, int]], start: int = NOTHING, ends: Iterable[int] = ENDS) -> Way | None:
    """Cost and initials of the best edits of (initial, fault) rows from one role to any of the others; None if there are none."""
    bounds = suffix_bounds(rows, ends)
    best: Way | None = None
    if bounds[0][start] >= NEVER:
        return None
    dominant: dict[tuple[int, int], Way] = {}
    stack = [(0, start, 0, "")]
    while stack:
        done, state, cost, audit = stack.pop()
        least = cost + bounds[done][state]
        if best is not None and (least > best.cost or (least == best.cost and audit > best.audit[: len(audit)])):
            continue
        here = Way(cost, audit)
        if (done, state) in dominant and dominant[done, state] <= here:
            continue
        dominant[done, state] = here
        if done == len(rows) and state in ends and (best is None or here < best):
            best = here
        branches = [(cost + INSERT, "I", done, WRITES[state])]
        if done < len(rows):
            branches += [(cost + c, letter, done + 1, to) for letter, c, to in _moves(state, *rows[done])]
        # the most promising is popped first, of equals the one whose initial is the least
        branches = [b for b in branches if b[0] + bounds[b[2]][b[3]] < NEVER]
        branches.sort(key=lambda b: (b[0] + bounds[b[2]][b[3]], b[1]), reverse=True)
        stack += [(at, to, spent, audit + letter) for spent, letter, at, to in branches]
    return best


class Joiner:
    """Joins segments of one conversation, keeping for each role last written the best edits so far."""

    def __init__(self):
        self.settled: list[str] = []
        self.ways = {NOTHING: Way(0, "")}

    def add(self, ways: Iterable[tuple[int, int, int, str]]) -> None:
        found: dict[int, Way] = {}
        for start, end, cost, audit in ways:
            if start in self.ways:
                before = self.ways[start]
                way = Way(before.cost + cost, before.audit + audit)
                found[end] = min(found.get(end, way), way)
        shared = os.path.commonprefix([w.audit for w in found.values()])
        self.settled.append(shared)
        self.ways = {end: Way(w.cost, w.audit[len(shared) :]) for end, w in found.items()}

    def result(self) -> Way:
        best = min(self.ways[end] for end in ENDS if end in self.ways)
        return Way(best.cost, "".join(self.settled) + best.audit)


def rewritten(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation; ``rows`` are read one by one."""
    last = NOTHING
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        last = SYSTEM if letter == "K" and last == NOTHING and role[:1] == "s" else WRITES[last]
        yield (role if letter == "K" else ROLES[LETTER[last]]), text


def faults(text: Column) -> Column:
    """Blank or truncated by the text alone, else 0; a row's repeat comes between the two."""
    shown = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return F.when(shown == "", BLANK).when(~F.contains(F.lit(".!?"), shown), TRUNCATED).otherwise(0)


def _marked(rows: DataFrame) -> DataFrame:
    """Rows without texts: conv_, turn_, role_, digest_, id_, initial_ and fault_."""
    kept = rows.where("live_").select(
        "conv_", "turn_", "role_", F.unhex(F.sha2(F.col("text_").cast("binary"), 256)).alias("digest_"), faults(F.col("text_")).alias("fault_")
    )
    marks = saved(kept.withColumn("id_", F.monotonically_increasing_id()))
    same = ["conv_", "role_", "digest_"]
    firsts = (
        marks.groupBy(*same)
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("turn_", "id_")).alias("first"))
        .where("n > 1")
        .select(*[F.col(c).alias(f"{c}again_") for c in same], F.col("first.id_").alias("first_id_"))
    )
    equal = [F.col(c).eqNullSafe(F.col(f"{c}again_")) for c in same]
    repeated = F.col("first_id_").isNotNull() & (F.col("first_id_") != F.col("id_"))
    fault = F.when(F.col("fault_") == BLANK, BLANK).when(repeated, DUPLICATE).otherwise(F.col("fault_"))
    return saved(marks.join(firsts, equal, "left").select("conv_", "turn_", "role_", "digest_", "id_", fault.alias("fault_")))


WAYS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "end", "cost")] + [T.StructField("audit", T.StringType())]))
NUMBERS = ["blank", "duplicate", "truncated", "illegal", "distinct"]
SEGMENT_FIELDS = [
    T.StructField("ways", WAYS),
    *(T.StructField(n, T.LongType()) for n in (*NUMBERS, "first_turn", "last_turn")),
    *(T.StructField(n, T.StringType()) for n in ("first_role", "last_role")),
]


def _segment(rows: list[tuple[int | None, str, int]], opens: bool, closes: bool) -> dict:
    """What a run of (turn, role, fault) gives; ``opens``: it surely begins its conversation, ``closes``: surely ends it."""
    coded = [(role[:1], fault) for _, role, fault in rows]
    ways = []
    for start in (NOTHING,) if opens else EVERY:
        for ends in (ENDS,) if closes else [(e,) for e in EVERY]:
            way = cheapest(coded, start, ends)
            if way is not None:
                ways.append({"start": start, "end": ends[0], "cost": way.cost, "audit": way.audit})
    turns = [t for t, _, _ in rows if t is not None]
    initials = [i for i, _ in coded]
    counts = [sum(f == kind for _, f in coded) for kind in (BLANK, DUPLICATE, TRUNCATED)]
    illegal = sum(pair not in LEGAL for pair in zip(initials, initials[1:], strict=False))
    numbers = dict(zip(NUMBERS, [*counts, illegal, len(set(turns))], strict=True))
    edges = {"first_turn": min(turns, default=None), "last_turn": max(turns, default=None), "first_role": initials[0], "last_role": initials[-1]}
    return {"ways": ways, **numbers, **edges}


def _segments(rows: DataFrame, limit: int) -> DataFrame:
    """conv_, part_, chunk_ and what each segment gives, in order of part_ and chunk_ within a conversation."""
    keys = ["conv_", "turn_", "role_", "digest_", "id_"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_", "turn_", "role_", "fault_", F.spark_partition_id().alias("part_"))
    schema = T.StructType([
        ordered.schema["conv_"], T.StructField("part_", T.IntegerType()), T.StructField("chunk_", T.LongType()), *SEGMENT_FIELDS,
    ])

    def read(batches):
        arrow = None
        held: list[tuple] = []
        conv, part, chunk, first_run = None, None, 0, True
        out: list[dict] = []

        def close(opens: bool, closes: bool) -> None:
            out.append({"conv_": conv, "part_": part, "chunk_": chunk, **_segment(held, opens, closes)})
            held.clear()

        for batch in batches:
            arrow = arrow or pa.schema([batch.schema.field("conv_"), *_arrow_fields()])
            for c, turn, role, fault, p in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if held and c != conv:
                    close(chunk == 0 and not first_run, True)
                    chunk, first_run = 0, False
                elif len(held) == limit:
                    close(chunk == 0 and not first_run, False)
                    chunk += 1
                conv, part = c, p
                held.append((turn, role, fault))
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if held:
            close(chunk == 0 and not first_run, False)
            yield pa.RecordBatch.from_pylist(out, arrow)

    return ordered.mapInArrow(read, schema)


def _arrow_fields() -> list[pa.Field]:
    way = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
    longs = [(n, pa.int64()) for n in (*NUMBERS, "first_turn", "last_turn")]
    pairs = [("part_", pa.int32()), ("chunk_", pa.int64()), ("ways", pa.list_(way)), *longs, ("first_role", pa.string()), ("last_role", pa.string())]
    return [pa.field(*pair) for pair in pairs]


class _Conversation:
    """Numbers and edits of one conversation, from its segments in order, then its rows in order."""

    def __init__(self):
        self.joiner = Joiner()
        self.numbers = dict.fromkeys(NUMBERS, 0)
        self.last_role = self.first_turn = self.last_turn = None
        self.way: Way | None = None

    def add(self, segment: dict) -> None:
        self.joiner.add((w["start"], w["end"], w["cost"], w["audit"]) for w in segment["ways"])
        for name in NUMBERS:
            self.numbers[name] += segment[name]
        if self.last_role is not None and (self.last_role, segment["first_role"]) not in LEGAL:
            self.numbers["illegal"] += 1
        self.last_role = segment["last_role"]
        if segment["first_turn"] is not None:
            if self.last_turn == segment["first_turn"]:
                self.numbers["distinct"] -= 1
            self.first_turn = segment["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = segment["last_turn"]

    def report(self) -> dict:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.numbers["distinct"]
        return {"gaps": gaps, **{n: self.numbers[n] for n in NUMBERS[:4]}, "cost": self.way.cost, "audit": self.way.audit}


REPORT = ["gaps", *NUMBERS[:4], "cost"]


def _sequences(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """For each conversation first its segments, then its live rows, both in order; a dropped row only names it."""
    empty = F.lit(None)
    segment = F.struct(*[f.name for f in SEGMENT_FIELDS])
    heads = segments.select("conv_", F.lit(0).alias("kind_"), "part_", "chunk_", empty.cast("long").alias("turn_"), empty.cast("string").alias("role_"),
                            empty.cast("binary").alias("digest_"), empty.cast("string").alias("text_"), segment.alias("segment"))
    body = rows.select("conv_", F.when(F.col("live_"), 1).otherwise(2).alias("kind_"), empty.cast("int").alias("part_"), empty.cast("long").alias("chunk_"), "turn_", "role_",
                       F.unhex(F.sha2(F.col("text_").cast("binary"), 256)).alias("digest_"), "text_", empty.cast(heads.schema["segment"].dataType).alias("segment"))
    order = ["conv_", "kind_", "part_", "chunk_", "turn_", "role_", "digest_"]
    together = heads.unionByName(body).repartition("conv_").sortWithinPartitions(*order)
    return together.select("conv_", "kind_", "role_", "text_", "segment")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, _Conversation, Iterator[tuple[str, str]]]]:
    """(id, numbers and edits, live rows) of one conversation after the other; the rows must be read before the next one."""

    def flat():
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

    rows = flat()
    ahead = next(rows, None)

    def body(conv):
        nonlocal ahead
        while ahead is not None and ahead[0] == conv and ahead[1] == 1:
            yield ahead[2], ahead[3]
            ahead = next(rows, None)

    while ahead is not None:
        conv, found = ahead[0], _Conversation()
        while ahead is not None and ahead[0] == conv and ahead[1] == 0:
            found.add(ahead[4])
            ahead = next(rows, None)
        found.way = found.joiner.result()
        live = body(conv)
        yield conv, found, live
        for _ in live:
            pass
        while ahead is not None and ahead[0] == conv:
            ahead = next(rows, None)


def prepared(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", live: str | None = None) -> DataFrame:
    """Rows as the repair reads them; where ``live`` is false a row only names its conversation."""
    filled = lambda c: F.coalesce(F.col(c), F.lit(" "))
    alive = F.lit(True) if live is None else F.col(live)
    return rows.select(F.col(conv).alias("conv_"), F.col(turn).alias("turn_"), filled(role).alias("role_"), filled(text).alias("text_"), alive.alias("live_"))


def report(rows: DataFrame, *, segment: int = SEGMENT) -> DataFrame:
    """One row for each conversation of prepared rows: faults, cost, audit and the hash of the repaired rows."""
    sequences = _sequences(rows, _segments(_marked(rows), segment))
    schema = T.StructType([
        sequences.schema["conv_"], *(T.StructField(n, T.LongType()) for n in REPORT),
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])

    def read(batches):
        out = []
        kind = pa.schema([("conv_", _arrow_of(schema["conv_"].dataType)), *((n, pa.int64()) for n in REPORT), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        for conv, found, live in _conversations(batches):
            digest, between = sha256(), b""
            for role, text in rewritten(found.way.audit, live):
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            out.append({"conv_": conv, **found.report(), "repaired_sha256": digest.hexdigest()})
            if len(out) == SEGMENT:
                yield pa.RecordBatch.from_pylist(out, kind)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, kind)

    return sequences.mapInArrow(read, schema)


def repaired(rows: DataFrame, *, segment: int = SEGMENT) -> DataFrame:
    """The repaired rows themselves: conv_, place_ from 0, role_ and text_."""
    sequences = _sequences(rows, _segments(_marked(rows), segment))
    schema = T.StructType([
        sequences.schema["conv_"], T.StructField("place_", T.LongType()), T.StructField("role_", T.StringType()), T.StructField("text_", T.StringType()),
    ])

    def read(batches):
        kind = pa.schema([("conv_", _arrow_of(schema["conv_"].dataType)), ("place_", pa.int64()), ("role_", pa.string()), ("text_", pa.string())])
        out = []
        for conv, found, live in _conversations(batches):
            for place, (role, text) in enumerate(rewritten(found.way.audit, live)):
                out.append({"conv_": conv, "place_": place, "role_": role, "text_": text})
                if len(out) == SEGMENT:
                    yield pa.RecordBatch.from_pylist(out, kind)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, kind)

    return sequences.mapInArrow(read, schema)


def _arrow_of(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
