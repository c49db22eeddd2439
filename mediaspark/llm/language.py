"""Language identification by mixtures: which languages a text holds, and how much of each.

``learn`` counts hashed character trigrams of every labelled text, language by language. ``mixture``
then explains the trigrams of one text as drawn from a mixture of languages: expectation-maximisation
estimates the proportions, and languages join the set one by one as long as the log-likelihood rises by
more than a penalty that grows with the text's length.

The model has languages × ``BUCKETS`` numbers, whatever the corpus; counts are added up in tasks first.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and no languages; so is every
text where nothing was learnt; rows without a label teach nothing; equal texts get equal answers; of equally
likely languages the first by name wins; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
UNKNOWN = "und"
PENALTY = 4.0  # log-likelihood a further language must add, times the log of the number of trigrams
STEPS = 12
OPEN_LANGUAGES = 64  # counted at once by a task

_LETTERS_ONLY = np.array([i if chr(i).isalpha() else 32 for i in range(128)], np.uint32)


def trigrams(text: str) -> np.ndarray:
    """How often each bucket of trigrams occurs; everything in ASCII that is no letter counts as a space."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(points < 128, _LETTERS_ONLY[np.minimum(points, 127)], points)
    mixed = points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA77) + points[2:] * np.uint32(0xC2B2AE3D)
    return np.bincount(mixed >> np.uint32(17), minlength=BUCKETS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def given(found: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, counts in found.items():
            bucket = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(bucket), pa.string()), pa.array(bucket.astype(np.int32)), pa.array(counts[bucket].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    found: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if lang not in found:
                if len(found) >= OPEN_LANGUAGES:
                    yield from given(found)
                    found = {}
                found[lang] = np.zeros(BUCKETS, np.int64)
            found[lang] += trigrams(text)
    yield from given(found)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    chance: np.ndarray  # buckets × languages


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Smoothed trigram chances of each language, from all labelled rows."""
    known = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    table = known.mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(table["lang"].unique()))
    counts = np.zeros((BUCKETS, len(languages)))
    counts[table["bucket"], [languages.index(x) for x in table["lang"]]] = table["n"]
    counts += 0.1
    return Model(languages, counts / counts.sum(axis=0))


def expected(chance: np.ndarray, n: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares after expectation-maximisation, and their log-likelihood."""
    total = n.sum()
    for _ in range(STEPS):
        share = share * ((n / (chance @ share)) @ chance) / total
    return share, float(n @ np.log(chance @ share))


def mixture(text: str | None, model: Model) -> tuple[list[tuple[str, float]], float]:
    """Languages with shares, the greatest share first, and the certainty of the first."""
    if not model.languages or not text or not any(map(str.isalpha, text)):
        return [], 0.0
    counts = trigrams(text)
    buckets = np.flatnonzero(counts)
    n, chance = counts[buckets].astype(float), model.chance[buckets]
    alone = n @ np.log(chance)
    full, _ = expected(chance, n, np.full(len(model.languages), 1 / len(model.languages)))
    chosen, best = [int(alone.argmax())], float(alone.max())
    shares = np.ones(1)
    gain = PENALTY * np.log(1 + n.sum())
    for other in np.argsort(-full, kind="stable"):
        if other in chosen:
            continue
        trial = [*chosen, int(other)]
        found, likelihood = expected(chance[:, trial], n, np.full(len(trial), 1 / len(trial)))
        if likelihood - best <= gain:
            break
        chosen, shares, best = trial, found, likelihood
    first = int(shares.argmax())
    # how likely the first language is, against all others alone; a trigram shares most with its neighbours
    odds = np.exp(np.clip((alone - alone[chosen[first]]) / 3, -700, 0 if len(chosen) == 1 else 700))
    odds[chosen] = 0
    certain = float(shares[first] / (1 + odds.sum()))
    ordered = sorted(zip(chosen, shares, strict=True), key=lambda x: (-x[1], x[0]))
    return [(model.languages[i], float(s)) for i, s in ordered], min(1.0, certain)


def identify(text: Column, model: Model) -> Column:
    """A struct of lang, score and all languages of the mixture, computed batch by batch."""
    kind = "lang string, score double, languages array<struct<lang:string,share:double>>"

    @F.pandas_udf(kind)
    def identified(texts: pd.Series) -> pd.DataFrame:
        found = [mixture(text, model) for text in texts]
        return pd.DataFrame({
            "lang": [langs[0][0] if langs else UNKNOWN for langs, _ in found],
            "score": [score for _, score in found],
            "languages": [[{"lang": lang, "share": share} for lang, share in langs] for langs, _ in found],
        })

    return identified(text)


LEAST_CERTAIN = 0.5


def filtered(docs: DataFrame, text: str = "text", lang: str = "lang", *, least: float = LEAST_CERTAIN) -> DataFrame:
    """The documents with a language that is certain enough, with the columns they have.

    ``und`` goes, and so does a text that is a mixture without a main language. Labels are for learning only.
    """
    found = identify(F.col(text), learn(docs, text, lang))
    return docs.where((found["lang"] != UNKNOWN) & (found["score"] >= least))
