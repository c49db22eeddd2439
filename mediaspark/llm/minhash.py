"""MinHash near-duplicates by a signature-coordinate inverted join, with links confirmed on full sets.

1. Each text becomes the set of its distinct word shingles, hashed to 64 bits, and a signature of ``COORDINATES``
   minima. Equal sets are one class from here on, so copies cost nothing more.
2. Classes are posted under their (coordinate, value) pairs. Two sets at the threshold agree in at least
   ``least_matches`` coordinates (but for a chance of one in a million), so they share a pair among the rarest
   coordinates − matches + 1 of either: only this prefix is posted, rarest first, and longer lists are skipped. Pairs
   that one class alone has are counted and dropped, which drops most classes altogether.
3. Within a list every class is compared with one centre only, the class that collides most. Comparing gives the
   exact symmetric difference, its edits of the centre.
4. Two classes of a list that are both linked to its centre are connected already. If one is not, they can only be
   linked if they share edits: more than num / (den + num) of those of any class whose partner is not linked, and at
   least (den + num) / 2 den of those by which an unlinked class exceeds what a link allows. So edits are posted in
   turn, each class under its rarest prefix only, and the shared ones give the exact similarity. No list is ever
   expanded into all its pairs, and no link between different texts is lost.
5. Components follow from the links by alternating stars.

Defined cases: a null text or one without words has an empty set and is linked with nothing; a text with fewer words
than a shingle is one shingle; very long texts are read whole, their signatures in parts; equal rows share a component; a null key never is a component's least key if
another is there, and rows whose component has no key have a null component and are kept; empty tables give no rows;
only key and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediaspark.llm.common import discard, fresh, hashes_of, placed, saved, shingles_of, text_bytes, words_of
from mediaspark.llm.components import components

COORDINATES = 64
MISSED = 1e-6  # chance that a pair right at the threshold agrees in fewer coordinates than asked for
BITMAP_BITS = 25  # 4 MB
MOST_BITS = 1 << 28  # 32 MB
MEMBERS = 256  # classes of one centre that one task takes

_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_MARKS = _RANDOM.integers(0, 2**63, COORDINATES, dtype=np.uint64)


@lru_cache
def least_matches(num: int, den: int) -> int:
    """Coordinates in which sets at similarity num / den agree, but for a chance of ``MISSED``."""
    p, below = num / den, 0.0
    for k in range(COORDINATES + 1):
        below += math.comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if below > MISSED:
            return k
    return COORDINATES


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the text's distinct shingles, A-Z in lower case."""
    return np.unique(hashes_of(shingles_of(words_of(text.lower()), size)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """A value for each coordinate, marked with the coordinate; long sets are walked in parts."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 4096):
        part = np.multiply.outer(_FACTORS, hashes[at : at + 4096]) + _SHIFTS[:, None]
        least = np.minimum(least, part.min(axis=1))
    return (least ^ _MARKS).view(np.int64)


def _described(size: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, tokens = [], [], []
            for text in text_bytes(batch.column(1)):
                hashes = shingle_hashes(text, size)
                counts.append(len(hashes))
                digests.append(blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                tokens.append(signature(hashes) if len(hashes) else None)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))]
            names = ["key_", "n_shingles", "digest", "tokens", *batch.schema.names[2:]]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[2:]], names)

    return describe


def _bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """Which numbers below ``bits`` the column ``at`` has: number n is bit n - 1, and 0 shares the bit of 1."""
    bucket, bit = F.bitmap_bucket_number("at").alias("b"), F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m")
    bitmap = np.zeros(bits // 8 + 8192, np.uint8)
    for row in places.groupBy(bucket).agg(bit).collect():
        start = (row.b - 1) * 4096 if row.b else 0
        bitmap[start : start + len(row.m)] |= np.frombuffer(bytes(row.m), np.uint8)
    return bitmap


def _likely_shared(signatures: DataFrame, common: DataFrame) -> DataFrame:
    """node and token of every token in ``common``, and some more: a bitmap passes over most others before they are shuffled.

    It has about 8 bits a common token, but ``MOST_BITS`` at most; beyond that more tokens pass, and the join decides.
    """
    bits = min(MOST_BITS, 1 << max(20, (8 * common.count()).bit_length()))
    shared = signatures.sparkSession.sparkContext.broadcast(_bitmap(common.select(F.pmod("token", F.lit(bits)).alias("at")), bits))

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = shared.value
        for batch in batches:
            tokens = batch.column(1).flatten().to_numpy()
            nodes = np.repeat(batch.column(0).to_numpy(), COORDINATES)
            at = np.maximum((tokens.view(np.uint64) & np.uint64(bits - 1)).astype(np.int64) - 1, 0)
            hit = ((chosen[at // 8] >> (at % 8).astype(np.uint8)) & 1).astype(bool)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[hit], pa.int64()), pa.array(tokens[hit], pa.int64())], ["node", "token"])

    return signatures.select("node", "tokens").mapInArrow(passed, "node long, token long")


def _rarest(posts: DataFrame, common: DataFrame, keep) -> DataFrame:
    """For each node the rarest of its tokens that others have too; ``keep`` says how many of n such tokens.

    The join with the counts is split where a token is frequent.
    """
    found = F.sort_array(F.collect_list(F.struct("df", "token"))).alias("found")
    gathered = posts.join(common, "token").groupBy("node").agg(found, F.sum("df").alias("central"))
    n = keep(F.size("found"))
    return gathered.where(n > 0).select("node", "central", F.explode(F.slice("found", F.lit(1), n)["token"]).alias("token"))


def _sets(docs: DataFrame, classes: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """Shingle hashes of the given classes, made again from their texts.

    A bitmap of key hashes, of a fixed size, lets most other texts be passed over unread; the join decides.
    """
    bits = 1 << BITMAP_BITS
    at = F.pmod(F.xxhash64("label"), F.lit(bits))
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(classes.select(at.alias("at")), bits))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = shared.value
        for batch in batches:
            bucket, place = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            wanted = (chosen[np.maximum(bucket - 1, 0) * 4096 + place // 8] >> (place % 8).astype(np.uint8)) & 1
            picked = batch.filter(pa.array(wanted.astype(bool)))
            hashes = [shingle_hashes(t, size) for t in text_bytes(picked.column(0))]
            hashes = [h for h in hashes if len(h)]
            for i in range(0, len(hashes), 512):
                part = hashes[i : i + 512]
                digests = [blake2b(h.tobytes(), digest_size=16).digest() for h in part]
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([h.view(np.int64) for h in part], pa.list_(pa.int64()))], ["digest", "items"])

    own = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(bits))
    read = docs.select(F.col(text).alias("t"), F.bitmap_bucket_number(own).alias("b"), F.bitmap_bit_position(own).alias("p"))
    found = read.mapInArrow(again, "digest binary, items array<long>").dropDuplicates(["digest"])
    return saved(found.join(classes.select("digest", "node"), "digest").select("node", "items"))


def near_duplicates(
    docs: DataFrame, *, size: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text", more: tuple[str, ...] = ()
) -> DataFrame:
    """key_, n_shingles and component of every row: the least key among all rows linked with it, directly or not.

    Rows are linked if den × intersection ≥ num × union of their sets of ``size``-word shingles. ``item_`` numbers
    the rows, ``root`` is the least such number of the component (null for empty sets); ``more`` names columns of
    longs that rows take along as more_0, more_1, ….
    """
    along = {f"more_{i}": F.col(c).cast("long") for i, c in enumerate(more)}
    chosen = docs.select(F.col(key).cast("long").alias("key_"), F.col(text).alias("text_"), *(c.alias(name) for name, c in along.items()))
    schema = "key_ long, n_shingles long, digest binary, tokens array<long>" + "".join(f", {name} long" for name in along)
    described = chosen.mapInArrow(_described(size), schema)
    whole = saved(described.withColumn("item_", F.monotonically_increasing_id()))
    rows = saved(whole.drop("tokens"))
    full = whole.where("digest IS NOT NULL")
    classes = saved(full.groupBy("digest").agg(F.min("key_").alias("label"), F.min("item_").alias("node"), F.min("n_shingles").alias("n")))

    # posting under coordinates: prefix of the rarest, one centre a list
    signatures = full.select(F.col("item_").alias("node"), "tokens").join(classes.select("node"), "node")
    matches = least_matches(num, den)
    common = saved(signatures.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    posts = saved(_rarest(_likely_shared(signatures, common), common, lambda n: n - matches + 1))
    discard(whole, common)
    centres = posts.groupBy("token").agg(F.max(F.struct("central", F.col("node").alias("id")))["id"].alias("centre"), F.count(F.lit(1)).alias("n"))
    met = saved(posts.join(centres.where("n > 1"), "token").where("node != centre").select("node", "centre").distinct())
    discard(posts)

    # exact comparison with the centre; a centre of many classes is dealt out in parts
    wide = saved(met.groupBy("centre").agg(F.count(F.lit(1)).alias("classes")).where(F.col("classes") > MEMBERS))
    part = F.when(F.col("classes").isNull(), 0).otherwise(F.pmod(F.xxhash64("node"), F.ceil(F.col("classes") / MEMBERS)))
    pairs = saved(met.join(wide, "centre", "left").select("node", "centre", part.cast("int").alias("part")))
    parts = saved(pairs.select("centre", "part").distinct())
    members = pairs.select("node").union(pairs.select(F.col("centre").alias("node"))).distinct()
    items = _sets(docs, classes.join(members, "node").select("digest", "node", "label"), size, key, text)
    theirs = parts.join(items.select(F.col("node").alias("centre"), F.col("items").alias("theirs")), "centre")
    edits = F.concat(F.array_except("items", "theirs"), F.array_except("theirs", "items"))
    compared = saved(
        pairs.join(items, "node").join(theirs, ["centre", "part"])
        .select("node", "centre", "part", F.size("items").alias("n"), (F.size("items") + F.size("theirs")).alias("both"), edits.alias("edits"))
        .withColumn("linked", (den - num) * F.col("both") >= (den + num) * F.size("edits"))
    )

    # posting under edits of the centre, where some class of it is not linked
    discard(items, met, wide)
    unlinked = saved(parts.join(compared.where("NOT linked").select("centre").distinct(), "centre", "left_semi"))
    open_rows = compared.join(unlinked, ["centre", "part"], "left_semi")
    rare = saved(_rarest_edits(open_rows, num, den))
    own = rare.where("NOT linked").select("centre", F.col("node").alias("a"), "token", "by_unlinked", F.col("rest").alias("ra"), F.col("need").alias("da"))
    partner = rare.select("centre", F.col("node").alias("b"), "token", F.col("by_unlinked").alias("other"), "linked", F.col("rest").alias("rb"), F.col("need").alias("db"))
    # of two unlinked classes both keep to the shorter prefix, and a pair is made once
    useful = F.col("linked") | (F.col("by_unlinked") & F.col("other") & (F.col("a") < F.col("b")))
    # at the first edit that two share, what is left of either's must be enough for a link
    enough = 2 * (den + num) * F.least("ra", "rb") >= F.col("da") + F.col("db")
    shared = own.join(partner.where("linked OR other"), ["centre", "token"]).where(useful & enough)
    candidates = shared.select("centre", "a", "b").distinct()
    one, other = (compared.select("centre", F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("edits").alias(f"e{x}")) for x in "ab")
    apart = F.size("ea") + F.size("eb") - 2 * F.size(F.array_intersect("ea", "eb"))
    confirmed = candidates.join(one, ["centre", "a"]).join(other, ["centre", "b"]).where((den - num) * (F.col("na") + F.col("nb")) >= (den + num) * apart)

    links = compared.where("linked").select(F.col("node").alias("u"), F.col("centre").alias("v")).union(confirmed.select("a", "b"))
    rooted = components(links)
    discard(pairs, parts, unlinked, compared, rare)
    labels = rooted.join(classes, "node").select("node", "root", "label")
    named = labels.groupBy("root").agg(F.min("label").alias("component"))
    of_node = labels.join(named, "root").select("node", "component", "root")
    of_class = classes.join(of_node, "node", "left").select("digest", F.coalesce("component", "label").alias("component"), F.coalesce("root", "node").alias("root"))
    component = F.when(F.col("digest").isNull(), F.col("key_")).otherwise(F.col("component"))
    return rows.join(of_class, "digest", "left").select("key_", "n_shingles", component.alias("component"), "digest", "item_", "root", *along)


def _rarest_edits(rows: DataFrame, num: int, den: int) -> DataFrame:
    """centre, node, linked, token: of each class's edits the prefix that any class sharing enough of them must meet.

    ``by_unlinked`` tells the shorter prefix, for partners that are not linked to the centre either. Edits that no
    other class of the centre has are counted, not posted. ``rest`` is how many edits that others have too are left
    from this one on, ``need`` this class's part of what a link asks for, 2 (den + num) times the edits shared.
    """
    size = F.size("edits")
    allowed = (den - num) * F.col("both")
    of_unlinked = F.floor(size * num / (den + num)) + 1
    of_any = F.ceil(((den + num) * size - allowed) / (2 * den))
    bare = rows.select(
        "centre", "node", "linked", F.explode("edits").alias("token"), ((den + num) * size - (den - num) * F.col("n")).alias("need"),
        F.when(F.col("linked"), of_unlinked).otherwise(of_any).alias("least"),
        F.when(F.col("linked"), of_unlinked).otherwise(F.greatest(of_unlinked, of_any)).alias("least_unlinked"),
    )
    common = bare.groupBy("centre", "token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    keys = ["centre", "node", "linked", "need", "least", "least_unlinked"]
    gathered = bare.join(common, ["centre", "token"]).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("found"))
    n, short = ((F.size("found") - F.col(c) + 1).cast("int") for c in ("least", "least_unlinked"))
    chosen = F.posexplode(F.slice("found", F.lit(1), n)["token"]).alias("place", "token")
    posted = gathered.where(n > 0).select(*keys[:4], short.alias("short"), F.size("found").alias("common"), chosen)
    return posted.select(*keys[:4], "token", (F.col("place") < F.col("short")).alias("by_unlinked"), (F.col("common") - F.col("place")).alias("rest"))


def one_of_each(docs: DataFrame, *, size: int = 5, num: int = 80, den: int = 100, text: str = "text") -> DataFrame:
    """One document of each component, with the columns they have: the first by number. Rows are told apart by where
    they lie, so repeated rows and missing keys do no harm; texts without words are no copies."""
    file, row = (fresh(docs, name) for name in ("file", "row"))
    lying = placed(docs, file, row)
    own = fresh(docs, "own")
    found = near_duplicates(lying.withColumn(own, F.xxhash64(file, row)), size=size, num=num, den=den, key=own, text=text, more=(file, row))
    others = saved(found.where("item_ != root").select(F.col("more_0").alias(file), F.col("more_1").alias(row)))
    return lying.join(others.hint("merge"), [file, row], "left_anti").select(*docs.columns)  # by a shuffle at any size
