"""Toxicity: boosted trees over dense features of each whole text, with isotonic calibration.

Features are densities of insulting words (a written list, plain and obfuscated, and a learnt lexicon),
their nearness to words that address somebody, capitals, punctuation and obfuscation rates. About
``bound`` labelled rows at most, chosen by a hash of the key, are dealt into three parts: ``learn_lexicon``
finds words and word beginnings that mark label 1 in the first, ``fit_model`` grows the trees on the
second and calibrates on the third, so no part is judged by what was learnt from it. ``features`` reads
every text once, with the lexicon (at most ``LEXICON`` entries) at hand; ``score`` calibrates every row.

Defined cases: a null or empty text has all features 0 and gets the score of such texts; equal texts get
equal scores; labels other than 0 and 1 are not used; without labels the score is 0; with one class it
is that class's share; an empty table gives no rows. Only key and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediaspark.llm import trees
from mediaspark.llm.common import saved, text_bytes

SAMPLE = 20_000
LEXICON = 2_000
NEAR = 5  # words between an insult and the word that addresses somebody
LEAST_TOXIC = 3  # texts with label 1 in which a term of the lexicon occurs
LEAST_ODDS = 1.5  # log-odds of label 1 given the term, against without it
BEGINNINGS = (4, 5, 6)  # code points of a word's beginnings that are terms too

# Insults and words of contempt, by language: English, German, French, Spanish.
INSULTS = frozenset(
    word.encode()
    for word in (
        "idiot idiots idiotic moron morons moronic stupid stupidity dumbass imbecile loser losers pathetic worthless "
        "disgusting trash garbage scum clown clowns fool fools filthy vermin parasite parasites degenerate subhuman "
        "coward cretin dimwit halfwit nitwit dunce bastard asshole fuck fucking repulsive "
        "dummkopf trottel arschloch abschaum versager wertlos widerlich ekelhaft blödmann drecksack "
        "imbécile crétin connard débile abruti minable pourriture salaud dégoûtant "
        "idiota imbécil estúpido estúpida basura escoria payaso perdedor asqueroso patético cretino"
    ).split()
)
# Words that address somebody.
ADDRESSES = frozenset(w.encode() for w in "you your yours yourself ur u dich dir dein deine ihr euch tu toi te vous votre tes tú ti tus usted ustedes".split())

_PUNCTUATION = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_TO_SPACE = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
_PLAIN = bytes.maketrans(b"013457@$!", b"oieastasi")
_MIXED = re.compile(rb"[a-z][a-z]*[0-9@$*!_.+-]+[a-z0-9@$*!_.+-]*[a-z]")
_SPACED = re.compile(rb"(?<![^\s])(?:[a-z][ .\-_*]){3,}[a-z](?![^\s.,!?])")
_JOINERS = b"*_.+- "

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 0xC0)
_MARK = np.isin(_BYTE, list(_PUNCTUATION))

FEATURES = (
    "log_words", "insults", "insults_a_word", "obfuscated_insults", "obfuscated_a_word", "near_address", "addresses_a_word",
    "capitals", "marks", "exclamations", "questions", "mixed_a_word", "learnt", "learnt_a_word", "learnt_most", "learnt_sum",
)
#: More insults never lower the score.
DIRECTIONS = (0, 1, 0, 1, 0, 1, 0, 0, 0, 0, 0, 0, 1, 0, 1, 1)


def terms_of(word: bytes) -> list[str]:
    """The word and its beginnings, which end in ``*``."""
    whole = word.decode("utf-8", "replace")
    return [whole, *(whole[:k] + "*" for k in BEGINNINGS if len(whole) > k)]


class Lexicon(dict):
    """Weight of each word: the greatest of its terms' log-odds, or 0. Weights are kept as words come up."""

    ROOM = 500_000

    def __init__(self, terms: dict[str, float]) -> None:
        super().__init__()
        self.terms = terms

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.ROOM:
            self.clear()
        self[word] = found = max(self.terms.get(t, 0.0) for t in terms_of(word))
        return found


def describe(text: bytes, lexicon: Lexicon) -> list[float]:
    """Dense features of one text."""
    low = text.lower()
    words = low.translate(_TO_SPACE).split()
    n = max(1, len(words))
    weights = list(map(lexicon.__getitem__, words))
    learnt = [w for w in weights if w]
    hits = [i for i, w in enumerate(words) if w in INSULTS] if not INSULTS.isdisjoint(words) else []
    marked = hits if not learnt else sorted({*hits, *(i for i, w in enumerate(weights) if w)})
    near = sum(not ADDRESSES.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]) for i in marked)
    addresses = sum(w in ADDRESSES for w in words)
    mixed = _MIXED.findall(low)
    hidden = sum(w.translate(_PLAIN, _JOINERS) in INSULTS for w in mixed)
    hidden += sum(w.translate(None, _JOINERS) in INSULTS for w in _SPACED.findall(low))
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = max(1, len(text))
    row = [
        np.log1p(len(words)), len(hits), len(hits) / n, hidden, hidden / n, near, addresses / n,
        of[_UPPER].sum() / max(1, of[_LETTER].sum()), of[_MARK].sum() / size, of[33] / size, of[63] / size, len(mixed) / n,
        len(learnt), len(learnt) / n, max(learnt, default=0), sum(learnt),
    ]
    return [float(x) for x in row]


def sample_of(labels: DataFrame, *, label: str = "toxic", key: str = "doc_id", bound: int = SAMPLE) -> DataFrame:
    """About ``bound`` labelled rows at most, the same in every run, with the part each belongs to."""
    known = labels.select(F.col(key).cast("long").alias("key_"), F.col(label).cast("int").alias("label_")).where(F.col("label_").isin(0, 1)).distinct()
    share = min(1.0, bound / max(1, known.count()))
    picked = known.where(F.pmod(F.xxhash64("key_"), F.lit(1 << 30)) < int(share * (1 << 30)))
    tenth = F.pmod(F.xxhash64("key_", F.lit("part")), F.lit(10))
    return picked.withColumn("part_", F.when(tenth < 4, "lexicon").when(tenth < 8, "trees").otherwise("calibration"))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of either label that have the term, added up for each batch."""
    for batch in batches:
        seen: Counter = Counter()
        toxic: Counter = Counter()
        for text, label in zip(text_bytes(batch.column("text_")), batch.column("label_").to_pylist(), strict=True):
            terms = {t for w in set(text.lower().translate(_TO_SPACE).split()) for t in terms_of(w)}
            seen.update(terms)
            if label:
                toxic.update(terms)
        names = list(seen)
        columns = [pa.array(names, pa.string()), pa.array([toxic[t] for t in names], pa.int64()), pa.array([seen[t] for t in names], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["term", "toxic", "seen"])


def learn_lexicon(docs: DataFrame, sample: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = LEXICON) -> dict[str, float]:
    """Terms that mark label 1 with their log-odds, the ``size`` strongest. Equal texts count once."""
    chosen = docs.select(F.col(key).cast("long").alias("key_"), F.col(text).alias("text_"))
    part = sample.where("part_ = 'lexicon'").select("key_", "label_")  # at most the bound of rows, so it may be sent to all
    texts = saved(chosen.join(F.broadcast(part), "key_").dropDuplicates(["label_", "text_"]).select("text_", "label_"))
    total = texts.agg(F.sum("label_").alias("toxic"), F.count(F.lit(1)).alias("seen")).first()
    if not total.toxic or total.toxic == total.seen:
        return {}
    counted = texts.mapInArrow(_terms, "term string, toxic long, seen long").groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("seen").alias("n"))
    rest = total.seen - total.toxic
    odds = F.log((F.col("t") + 0.5) / (total.toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (rest + 1))
    strong = counted.where(F.col("t") >= LEAST_TOXIC).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    best = strong.orderBy((F.col("odds") * F.sqrt("t")).desc(), "term").limit(size)
    return {r.term: r.odds for r in best.collect()}


def features(docs: DataFrame, terms: dict[str, float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Features of every document, kept in the shared folder."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for batch in batches:
            rows = [describe(text, lexicon) for text in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["key_", "features"])

    chosen = docs.select(F.col(key).cast("long").alias("key_"), F.col(text).alias("text_"))
    return saved(chosen.mapInArrow(described, "key_ long, features array<double>"))


@dataclass(frozen=True)
class Model:
    forest: trees.Forest
    at: np.ndarray
    level: np.ndarray

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.forest.raw(rows), self.at, self.level)


def fit_model(found: DataFrame, sample: DataFrame) -> Model:
    """Trees and calibration from the second and third part of the sample."""
    rows = found.join(F.broadcast(sample.where("part_ != 'lexicon'")), "key_")
    rows = rows.orderBy(F.xxhash64("key_", "label_", "features")).limit(2 * SAMPLE).toPandas()  # a bound under repeated keys too
    rows = rows.sort_values(["key_", "label_"], kind="stable")
    if not len(rows):
        return Model(trees.constant(0.0), np.zeros(1), np.zeros(1))
    x, y, later = np.stack(rows["features"].to_numpy()), rows["label_"].to_numpy(float), (rows["part_"] == "calibration").to_numpy()
    if not 0 < y.mean() < 1 or not later.any() or later.all():
        return Model(trees.constant(float(y.mean())), np.zeros(1), np.array([float(y.mean())]))
    forest = trees.fit(x[~later], y[~later], rounds=40, depth=3, ridge=5.0, directions=DIRECTIONS)
    return Model(forest, *trees.isotonic(forest.raw(x[later]), y[later]))


def score(found: DataFrame, model: Model) -> DataFrame:
    """key_ and calibrated probability of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("key_"), pa.array(model.probability(rows))], ["key_", "score"])

    return found.mapInArrow(scored, "key_ long, score double")
