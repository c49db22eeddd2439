"""Quality rules: hard limits on words, then boosted trees over statistics of each whole text.

``statistics`` reads every text once, in ``mapInArrow``, and keeps counts and features; ``fit_rules``
learns from a sample of about ``bound`` labelled rows at most, chosen by a hash of the key; ``apply_rules``
scores all rows with flat node arrays, ``filtered`` does both for tables with other columns. More repetition, symbols, capitals or table bars can only lower a score.

Defined cases: a null or blank text has no words and fails the hard limits; very long texts are read whole, one at
a time; a key repeated in labels counts once with each label; equal rows get equal
verdicts; labels other than 0 and 1 and labels without a document are not used; without labels of both
classes the trees keep everything that passes the limits; an empty table gives no rows. Columns of the
input other than key and text are not read and cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediaspark.llm import trees
from mediaspark.llm.common import saved, text_bytes, words_of

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
SAMPLE = 20_000
THRESHOLD = 0.5

_BYTE = np.arange(256)
_SPACE = np.isin(_BYTE, list(b" \t\n\v\f\r"))
_CONTINUES = (_BYTE & 0xC0) == 0x80
_SYMBOL = np.isin(_BYTE, list(b"#*$%&|<>"))
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 0xC0)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_MARK = np.isin(_BYTE, list(b".,;:!?'\"()-"))
_LOUD = np.isin(_BYTE, list(b"!?"))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features and the direction in which each may move the score.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbols": -1, "capitals": -1, "digits": 0, "marks": 0, "loud": -1, "bars": -1,
    "dup_lines": -1, "repeated": -1, "distinct": 0, "top_word": -1, "short_words": 0, "longest": 0, "words_a_line": 0,
}
SCHEMA = "key_ long, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>"


def repeated_words(words: list) -> int:
    """Words inside windows of five words that occur twice or more; the first occurrence counts too."""
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    found, total, reach = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if found[window] > 1:
            total += i + WINDOW - max(i, reach)
            reach = i + WINDOW
    return total


def repeated_lines(lines: list[bytes]) -> int:
    """Lines with a word that equal an earlier line."""
    with_words = [line for line in lines if line.strip()]
    return len(with_words) - len(set(with_words))


def describe(text: bytes) -> tuple[list[int], list[float]]:
    """The counts and the features of one text."""
    words, lines = words_of(text), text.split(b"\n")
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(of.sum() - of[_CONTINUES].sum() - of[_SPACE].sum())
    n, symbols, dup, repeated = len(words), int(of[_SYMBOL].sum()), repeated_lines(lines), repeated_words(words)
    most = max(1, chars)
    kinds = Counter(words)
    features = [
        float(np.log1p(n)), chars / max(1, n), symbols / most, of[_UPPER].sum() / max(1, of[_LETTER].sum()), of[_DIGIT].sum() / most,
        of[_MARK].sum() / most, of[_LOUD].sum() / most, of[124] / most, dup / len(lines), repeated / max(1, n), len(kinds) / max(1, n),
        max(kinds.values(), default=0) / max(1, n), sum(len(w) < 4 for w in words) / max(1, n),
        float(np.log1p(max(map(len, kinds), default=0))), n / len(lines),
    ]
    return [n, chars, symbols, dup, repeated], [float(x) for x in features]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [describe(text) for text in text_bytes(batch.column(1))]
        counts = np.array([x[0] for x in found], np.int64).reshape(-1, len(COUNTS))
        columns = [batch.column(0), *(pa.array(counts[:, i]) for i in range(len(COUNTS))), pa.array([x[1] for x in found], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["key_", *COUNTS, "features"])


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and features of every document, read once and kept in the shared folder."""
    chosen = docs.select(F.col(key).cast("long").alias("key_"), F.col(text).alias("text_"))
    return saved(chosen.mapInArrow(_statistics, SCHEMA))


def sample_of(labels: DataFrame, *, label: str = "quality", key: str = "doc_id", bound: int = SAMPLE) -> DataFrame:
    """About ``bound`` labelled rows at most, the same in every run."""
    known = labels.select(F.col(key).cast("long").alias("key_"), F.col(label).cast("int").alias("label_")).where(F.col("label_").isin(0, 1)).distinct()
    share = min(1.0, bound / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64("key_"), F.lit(1 << 30)) < int(share * (1 << 30)))


def fit_rules(found: DataFrame, sample: DataFrame) -> trees.Forest:
    """Trees for P(label = 1) from the sample's rows."""
    rows = found.join(sample, "key_").select("key_", "features", "label_")
    rows = rows.orderBy(F.xxhash64("key_", "label_", "features")).limit(2 * SAMPLE).toPandas()  # a bound under repeated keys too
    rows = rows.sort_values(["key_", "label_"], kind="stable")
    if not len(rows):
        return trees.constant(1.0)
    x = np.stack(rows["features"].to_numpy())
    y = rows["label_"].to_numpy(float)
    return trees.fit(x, y, directions=tuple(FEATURES.values())) if 0 < y.mean() < 1 else trees.constant(1.0)


def apply_rules(found: DataFrame, forest: trees.Forest, *, threshold: float = THRESHOLD) -> DataFrame:
    """key_, the counts, base_failed, score and kept of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
            columns = [batch.column(c) for c in ("key_", *COUNTS)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(forest.probability(rows))], ["key_", *COUNTS, "score"])

    scored = found.mapInArrow(score, "key_ long, " + ", ".join(f"{c} long" for c in COUNTS) + ", score double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def verdict(text: Column, forest: trees.Forest, *, threshold: float = THRESHOLD) -> Column:
    """Whether a text is kept, read and scored in one go; for filters on tables with other columns."""

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        found = [describe((t or "").encode()) for t in texts]
        scores = forest.probability(np.array([f for _, f in found], float).reshape(-1, len(FEATURES)))
        failed = [n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n for (n, *_, repeated), _ in found]
        return pd.Series((scores >= threshold) & ~np.array(failed, bool))

    return kept(text)


def filtered(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that pass, with the columns they have; the trees learn from the labelled ones among them."""
    sample = sample_of(labels)
    keys = sample.select(F.col("key_").alias(key)).distinct()  # bounded like the sample, so it may be sent to all
    found = statistics(docs.select(key, text).join(F.broadcast(keys), key, "left_semi"), key, text)
    return docs.where(verdict(F.col(text), fit_rules(found, sample)))
