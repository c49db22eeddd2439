"""I-Match fingerprints with randomised lexicons, in DataFrame functions only.

``lexicon`` keeps the terms whose document frequency lies in a band. Each of ``SUBSETS`` random lexicons holds
a term with chance ``KEPT`` / 256, told by two hex digits of the term's md5. A text's fingerprint has, for each
random lexicon, a hash of the text's distinct sorted terms in it. A small edit leaves the hashes of those
lexicons that hold none of the changed terms, so likeness is the share of equal hashes.

A term in the band is in at least ``LOW`` of all documents, so the lexicon has at most (mean distinct terms of a
document) / ``LOW`` terms however many documents there are; about a fifth of them are in some random lexicon.
These are sent to all tasks as one folded literal, dealt into slots by hash, so that looking a term up takes one
step and no term is ever shuffled with its document.

``with_parts`` instead deals the whole band into ``PARTS`` lexicons, each term into one, told by md5 too: every term
of the band takes part in the fingerprint, and each lexicon is as small as a random one. A text with fewer than
``FEW_HELD`` terms of the band has all its terms dealt, so that an edit changes some of its hashes only.

Defined cases: a null text is empty; a text without any term in a random lexicon is fingerprinted by all its
distinct sorted terms, and is like an equally fingerprinted text only; equal texts have equal fingerprints; an
empty table has an empty lexicon; input columns are carried, and the named outputs replace those of the same name.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOW, HIGH = (5, 1000), (100, 1000)  # of all documents: at least 0.5 %, at most 10 %
SUBSETS = 16
KEPT = 4
PARTS = 64  # divides 256
FEW_HELD = 8
SLOTS = 4_096

ENTRY = "array<array<struct<t:string,s:array<int>>>>"
PART_ENTRY = "array<array<struct<t:string,p:int>>>"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def subsets_of(term: Column) -> Column:
    """Numbers of the random lexicons that hold the term."""
    low = [f"{i:02x}" for i in range(KEPT)]
    return F.filter(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda j: F.substring(F.md5(term.cast("binary")), j * 2 + 1, F.lit(2)).isin(low))


def lexicon(docs: DataFrame, text: str = "text") -> Column:
    """The terms of the band that some random lexicon holds, in slots, as a literal."""
    total = docs.count()
    counted = docs.select(F.explode(F.array_distinct(terms(F.col(text)))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    band = counted.where((F.col("df") * LOW[1] >= LOW[0] * total) & (F.col("df") * HIGH[1] <= HIGH[0] * total))
    held = band.select("t", subsets_of(F.col("t")).alias("s"), F.pmod(F.xxhash64("t"), F.lit(SLOTS)).alias("slot"))
    slots: list[list] = [[] for _ in range(SLOTS)]
    for row in sorted(held.collect()):  # a filter on s would be pushed below the count, to every occurrence of a term
        if row.s:
            slots[row.slot].append({"t": row.t, "s": list(row.s)})
    return F.from_json(F.lit(json.dumps(slots)), ENTRY)


def part_of(term: Column) -> Column:
    """Number of the one lexicon of the whole band that holds the term."""
    return F.conv(F.substring(F.md5(term.cast("binary")), 1, 2), 16, 10).cast("int") % PARTS


def lexicon_parts(docs: DataFrame, text: str = "text") -> Column:
    """All terms of the band with their lexicons, in slots, as a literal."""
    total = docs.count()
    counted = docs.select(F.explode(F.array_distinct(terms(F.col(text)))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    band = counted.where((F.col("df") * LOW[1] >= LOW[0] * total) & (F.col("df") * HIGH[1] <= HIGH[0] * total))
    slots: list[list] = [[] for _ in range(SLOTS)]
    for row in sorted(band.select("t", part_of(F.col("t")).alias("p"), F.pmod(F.xxhash64("t"), F.lit(SLOTS)).alias("slot")).collect()):
        slots[row.slot].append({"t": row.t, "p": row.p})
    return F.from_json(F.lit(json.dumps(slots)), PART_ENTRY)


def with_parts(rows: DataFrame, text: str, slots: Column, name: str) -> DataFrame:
    """Adds the hashes by lexicon of the whole band, joined by dashes; one hash where the text has no terms at all."""
    distinct, held, found = F.col("terms_"), F.col("held_"), F.col("found_")
    looked_up = F.transform(distinct, lambda t: F.filter(F.get(slots, F.pmod(F.xxhash64(t), F.lit(SLOTS)).cast("int")), lambda e: e["t"] == t))
    every = F.transform(distinct, lambda t: F.struct(t.alias("t"), part_of(t).alias("p")))

    def one(j: Column) -> Column:
        joined = F.array_join(F.transform(F.filter(found, lambda e: e["p"] == j), lambda e: e["t"]), " ")
        return F.when(joined == "", F.lit("")).otherwise(F.substring(F.md5(joined.cast("binary")), 1, 8))

    several = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), one), "-")
    staged = rows.withColumn("terms_", F.array_distinct(terms(F.col(text)))).withColumn("held_", F.flatten(looked_up))
    dealt = staged.withColumn("found_", F.array_sort(F.when(F.size(held) < FEW_HELD, every).otherwise(held)))
    return dealt.withColumn(name, F.when(F.size(found) == 0, F.md5(F.lit("").cast("binary"))).otherwise(several)).drop("terms_", "held_", "found_")


def with_fingerprint(rows: DataFrame, text: str, slots: Column, name: str) -> DataFrame:
    """Adds the hashes by random lexicon, joined by dashes; of all terms where no lexicon has any of the text's."""
    distinct, found = F.col("terms_"), F.col("found_")
    held = F.transform(distinct, lambda t: F.filter(F.get(slots, F.pmod(F.xxhash64(t), F.lit(SLOTS)).cast("int")), lambda e: e["t"] == t))

    def one(j: Column) -> Column:
        own = F.filter(found, lambda e: F.array_contains(e["s"], j))
        joined = F.array_join(F.transform(own, lambda e: e["t"]), " ")
        return F.when(joined == "", F.lit("")).otherwise(F.substring(F.md5(joined.cast("binary")), 1, 8))

    several = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), one), "-")
    whole = F.md5(F.array_join(F.array_sort(distinct), " ").cast("binary"))
    # one step a column: each is used more than once
    staged = rows.withColumn("terms_", F.array_distinct(terms(F.col(text)))).withColumn("found_", F.array_sort(F.flatten(held)))
    return staged.withColumn(name, F.when(F.size(found) == 0, whole).otherwise(several)).drop("terms_", "found_")


def likeness(one: Column, other: Column) -> Column:
    """Share of equal hashes among the lexicons of which either text has terms."""
    pairs = F.arrays_zip(F.split(one, "-").alias("a"), F.split(other, "-").alias("b"))
    whole = F.contains(one, F.lit("-")) & F.contains(other, F.lit("-"))
    used = F.size(F.filter(pairs, lambda p: (p["a"] != "") | (p["b"] != "")))
    same = F.size(F.filter(pairs, lambda p: (p["a"] != "") & (p["a"] == p["b"])))
    return F.when(whole, same / used).otherwise((one == other).cast("double"))


ROWS_A_BUCKET = 2_000
MOST_BUCKETS = 4_096


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds lie below the key, found in two steps; nulls come lowest."""
    step = 64
    rows = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    if not rows:
        return F.when(key.isNull(), -1).otherwise(0)
    heads = F.from_json(F.lit(json.dumps([r[0] for r in rows])), "array<bigint>")
    groups = F.from_json(F.lit(json.dumps(rows)), "array<array<bigint>>")
    head = F.size(F.filter(heads, lambda b: b < key))
    inside = F.size(F.filter(F.get(groups, head - 1), lambda b: b < key))
    return F.when(key.isNull(), -1).when(head == 0, 0).otherwise((head - 1) * step + inside)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", *, rows_a_bucket: int = ROWS_A_BUCKET) -> tuple[DataFrame, Window]:
    """Rows in buckets by descending key, such that ``lead`` over the window gives the next row of all.

    Keys are cut at quantiles; each bucket also gets, as a ghost that sorts last, the first row of the bucket
    below it (the lowest gets the first of all). So one shuffle, split evenly, replaces a sort in one task.
    Of equal keys, texts come in their order. Drop the rows with ``ghost_`` after use.
    """
    total = docs.count()
    buckets = max(1, min(MOST_BUCKETS, total // rows_a_bucket))
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set((docs.agg(F.percentile_approx(key, cuts, 10 * max(1_000, buckets))).first()[0] or []) if cuts else []))
    placed = docs.withColumn("bucket_", _bucket(F.col(key), bounds))
    heads = placed.groupBy("bucket_").agg(F.max(key).alias("head_"))
    upwards = Window.orderBy("bucket_")
    above = F.coalesce(F.lead("bucket_").over(upwards), F.min("bucket_").over(upwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    ghosts = heads.select("head_", F.col("bucket_").alias("from_"), above.alias("to_"))  # at most MOST_BUCKETS + 2 rows
    joined = placed.join(F.broadcast(ghosts), (F.col("bucket_") == F.col("from_")) & F.col(key).eqNullSafe(F.col("head_")), "left")
    places = F.array_compact(F.array(F.struct(F.lit(False).alias("ghost_"), F.col("bucket_").alias("b_")),
                                     F.when(F.col("to_").isNotNull(), F.struct(F.lit(True).alias("ghost_"), F.col("to_").alias("b_")))))
    dealt = joined.select(*docs.columns, F.inline(places))
    return dealt, Window.partitionBy("b_").orderBy("ghost_", F.col(key).desc_nulls_last(), F.col(text).asc_nulls_last())
