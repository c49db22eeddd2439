"""The text operators against brute force, exact round trips and held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mediaspark.llm import imatch, kneser_ney, language, licenses, minhash, mixing, op10, packing, quality, sharding, toxicity, trees
from mediaspark.llm.common import fold, placed, saved
from mediaspark.llm.components import components
from mediaspark.llm.queries import QUERIES, VARIANTS
from tests.llm.helpers import FOLDER, awkward, labels

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# ---- 1: quality


def plain_counts(text):
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in lines
            lines.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)]


@pytest.mark.parametrize("text", ["", "a b c d e a b c d e", "a " * 30, "x\ny\n \nx\n\nx y\nx y", "é|# ü\x0b\x1cz", "a b c d e f a b c d e f g a b c d e"])
def test_counts_of_a_text(text):
    assert quality.describe(text.encode())[0] == plain_counts(text)


def test_quality_counts_of_all_documents(spark, texts):
    found = by_id(QUERIES["op1_quality_rules"](spark, FOLDER))
    for doc_id, text in texts.items():
        row, counts = found[doc_id], plain_counts(text)
        assert [row[c] for c in quality.COUNTS] == counts
        assert row.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (row.base_failed and row.kept)


def test_quality_on_labels_it_has_not_seen(spark):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality.statistics(docs)
    held = fold("doc_id", 3) == 0
    verdicts = quality.apply_rules(found, quality.fit_rules(found, quality.sample_of(marks.where(~held))))
    judged = verdicts.join(marks.where(held), F.col("key_") == F.col("doc_id")).where("quality IS NOT NULL")
    right = judged.where(F.col("kept") == (F.col("quality") == 1)).count()
    assert right >= 0.95 * judged.count()


def test_no_labels_keep_what_passes_the_limits(spark):
    kept = quality.filtered(awkward(spark), labels(spark).where(F.lit(False)))
    assert sorted(r.doc_id or 0 for r in kept.select("doc_id").collect()) == [0, 3, 4, 4, 10] and kept.columns == awkward(spark).columns


def test_forest_learns_and_keeps_its_directions():
    draw = np.random.default_rng(1)
    x = draw.random((4000, 3))
    y = (x[:, 0] + 0.3 * draw.normal(size=4000) > 0.5).astype(float)
    forest = trees.fit(x, y, rounds=30, depth=3, directions=(1, -1, 0))
    assert ((forest.probability(x) > 0.5) == (y > 0.5)).mean() > 0.75
    for feature, sign in ((0, 1), (1, -1)):
        line = np.tile(draw.random((50, 1, 3)), (1, 40, 1))
        line[:, :, feature] = np.linspace(0, 1, 40)
        moved = np.diff(forest.raw(line.reshape(-1, 3)).reshape(50, 40), axis=1)
        assert (sign * moved >= -1e-12).all()


def plain_walk(forest, row):
    total = forest.base
    for root in forest.roots:
        node = root
        while forest.left[node] != node:
            node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        total += forest.value[node]
    return total


def test_flat_arrays_score_like_a_walk():
    draw = np.random.default_rng(2)
    x, y = draw.random((500, 4)), draw.integers(0, 2, 500).astype(float)
    forest = trees.fit(x, y, rounds=10)
    assert np.allclose(forest.raw(x[:50]), [plain_walk(forest, row) for row in x[:50]])


def test_isotonic_steps_rise():
    draw = np.random.default_rng(3)
    scores = draw.normal(size=300)
    at, level = trees.isotonic(scores, (draw.random(300) < 1 / (1 + np.exp(-scores))).astype(float))
    assert (np.diff(at) >= 0).all() and (np.diff(level) >= 0).all() and 0 < level[0] and level[-1] < 1


# ---- 2: licenses


def plain_scan(text, keywords=True):
    found = []
    low = text.lower()
    for r in licenses.rules():
        if (r.first in low and r.second in low) or not (keywords or r.first == "spdx"):
            found += [(m.start(), -m.end(), -r.priority, r.order, r.label) for m in re.finditer(r.regex, text, re.A)]
    kept = []
    for d in sorted(found):
        if not any(k[0] <= d[0] and k[1] <= d[1] and k[2] <= d[2] and k != d for k in kept):
            kept.append(d)
    return [(d[0], -d[1], d[4], -d[2]) for d in kept]


LICENSED = [
    "Licensed under the Apache License, Version 2.0. Copyright (c) 2020 all rights\nreserved",
    "SPDX-License-Identifier: GPL-3.0-or-later and https://www.gnu.org/licenses/gpl-3.0",
    "This work is licensed under CC BY-NC-SA 4.0; see http://creativecommons.org/licenses/by-nc-sa/4.0/",
    "MIT License mit-license MIT licence, mit licenses", "Creative Commons Attribution-NonCommercial 3.0", "GPLv2 or GPL v3", "", "no terms at all",
    "the BSD 3-Clause License; released under the terms of the GNU Lesser General Public License, version 2.1", "é MIT License é" * 40,
]


def test_detections_equal_a_plain_scan(spark):
    df = spark.createDataFrame(list(enumerate(LICENSED)), "doc_id long, text string")
    for row in licenses.scan(df).collect():
        assert [(d.start, d.end, d.label, d.priority) for d in row.detections] == plain_scan(row.text), row.text


def test_every_host_of_an_address_is_found_without_keywords(spark):
    """As a search by the regexes alone finds them."""
    given = ["see https://openfontlicense.org", "see http://www.scripts.sil.org/OFL", "both https://scripts.sil.org https://www.openfontlicense.org/ofl", "no address"]
    for row in licenses.scan(spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")).collect():
        plain = sorted((m.start(), m.end(), r.label) for r in licenses.rules() for m in re.finditer(r.regex, row.text, re.A) if r.first == "://")
        found = sorted((d.start, d.end, d.label) for d in row.detections)
        assert found == plain and [f[2] for f in found] == ["ofl-1.1"] * row.text.count("http")


def test_every_rule_is_reached_through_a_gate():
    rules = licenses.rules()
    assert len(rules) > 200 and [r.order for r in rules] == list(range(len(rules)))
    for r in rules:
        re.compile(r.regex)
        assert r.first == r.first.lower() and r.second == r.second.lower()


# Notices as people write them, with the licenses that a reader finds in them.
NOTICES = [
    ("License: MIT", "mit"), ("This project is MIT licensed.", "mit"), ("Released under Apache 2.0", "apache-2.0"), ('"license": "ISC"', "isc"),
    ("under the terms of the GNU GPL version 3", "gpl-3.0"), ("GPL version 2 or later", "gpl-2.0"), ("dual-licensed MIT/Apache-2.0", "apache-2.0,mit"),
    ("licensed under MIT", "mit"), ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache-2.0,mit"), ("license = BSD-3-Clause", "bsd-3-clause"),
    ("SPDX-License-Identifier: (GPL-2.0-only AND BSD-2-Clause)", "bsd-2-clause,gpl-2.0"), ("Apache License\n * Version 2.0", "apache-2.0"),
    ("# Licensed under the Apache\n# License, Version 2.0", "apache-2.0"), ("Distributed\nunder the MPL 2.0", "mpl-2.0"), ("Apache-2.0 OR MIT", "apache-2.0,mit"),
    ("GNU LGPL v2.1", "lgpl-2.1"), ("available under the AGPLv3", "agpl-3.0"), ("published under the zlib", "zlib"), ("Licensed under the GPL", "gpl"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files", "mit"),
    ("Redistribution and use in source and binary forms: neither the name of the author nor the names of its\n contributors may be used to endorse or promote products", "bsd-3-clause"),
    ("Redistributions must reproduce it in the documentation and/or other materials provided with the distribution.\n\nTHIS SOFTWARE IS PROVIDED", "bsd-2-clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that", "isc"),
    ("GNU General Public License as published by the Free Software Foundation; either version 3 of the License", "gpl-3.0"),
    ("GNU Lesser General Public License as published by\n// the Free Software Foundation; either version 2.1", "lgpl-2.1"),
    ("TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION of the License", "apache-2.0"),
    ("we submit under pressure", ""), ("Apache helicopters, version 20", ""), ("er kam mit Apache und ging", ""), ("under the terms of the limited contract", ""), ("a permit, licensed", ""),
]
NO_LICENSE = {"licensed", "bsd-grant", "mit-grant", "isc-grant", "no-warranty", "copyright-notice"}


def test_notices_name_their_licenses(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(NOTICES)], "doc_id long, text string")
    for row in licenses.scan(df).collect():
        found = {d.label for d in row.detections} - NO_LICENSE
        # a family beside its version says nothing more
        named = {f for f in found if not any(o != f and o.startswith(f + "-") for o in found)}
        assert ",".join(sorted(named)) == NOTICES[row.doc_id][1], row.text
        assert [(d.start, d.end, d.label, d.priority) for d in row.detections] == plain_scan(row.text, keywords=False), row.text


def plain_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    starts, found = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        own = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(own)] == own:
                starts.append(i)
                found.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(found))


def test_base_phrases(spark, tmp_path):
    cases = [*LICENSED, "mit MIT\nLicense-apache license", "émit license", "mit license2 general  public. license", "MIT_LICENSE x MIT--License", None]
    spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for doc_id, row in by_id(QUERIES["op2_license_scan"](spark, str(tmp_path))).items():
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == plain_base(cases[doc_id] or ""), cases[doc_id]
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1


# ---- 3: near-duplicates


def plain_components(texts, size, num, den):
    sets = {}
    for key, text in texts.items():
        w = [x.lower() for x in WORDS.findall(text)]
        sets[key] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    least = {k: k for k in texts}

    def root(k):
        while least[k] != k:
            k = least[k]
        return k

    for a, b in combinations(texts, 2):
        both = len(sets[a] & sets[b])
        if both and den * both >= num * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            least[y] = x
    return {k: root(k) for k in texts}


def family(size, seed, rate):
    """Texts made from one base by changing words, dropping some, and a few copies."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(400)}" for _ in range(160)]
    out = []
    for i in range(size):
        words = [w if draw.random() > rate * draw.random() else f"x{draw.randrange(10_000)}" for w in base]
        words = [w for w in words if draw.random() > 0.02 * (i % 3)]
        out.append(" ".join(words))
    return out + out[:3]


@pytest.mark.parametrize("size, num", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, size, num):
    """Families whose members lie on both sides of the threshold to their centre and to each other."""
    made = [t for seed, rate in ((1, 0.05), (2, 0.1), (3, 0.2)) for t in family(60, seed, rate)] + ["one", "one", "one two", "", "  "]
    texts = dict(enumerate(made))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = {r.key_: r.component for r in minhash.near_duplicates(df, size=size, num=num, den=100).collect()}
    assert found == plain_components(texts, size, num, 100)


def test_one_row_of_each_component_stays(spark):
    kept = minhash.one_of_each(awkward(spark))
    assert kept.columns == awkward(spark).columns
    # rows without words are no copies of one another; of three equal texts one stays
    assert len(kept.collect()) == 10


def test_passed_tokens_have_all_common_ones(spark):
    draw = np.random.default_rng(4)
    tokens = draw.integers(-(2**63), 2**63 - 1, (200, minhash.COORDINATES))
    tokens[0, :3] = (0, 1, 1 << 20)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(tokens)], "node long, tokens array<long>")
    common = saved(spark.createDataFrame([(int(t), 2) for t in tokens[:40].ravel()], "token long, df long"))
    found = {(r.node, r.token) for r in minhash._likely_shared(df, common).collect()}
    wanted = {(i, int(t)) for i in range(40) for t in tokens[i]}
    assert wanted <= found and len(found) < len(wanted) + 100


def test_least_matches_miss_one_link_in_a_million():
    assert 36 <= minhash.least_matches(85, 100) <= 44 and minhash.least_matches(80, 100) < minhash.least_matches(85, 100)


def test_components_of_long_paths_and_stars(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200)]
    draw.shuffle(edges)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}}


# ---- 4: fingerprints


def test_next_document_across_buckets(spark):
    keys = [5, 3, 3, 9, 1, None, 7, 20, 21, 22]
    df = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate(keys)], "doc_id long, text string")
    order = sorted(((k, f"t{i}") for i, k in enumerate(keys)), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    expected = {t: order[(i + 1) % len(order)][1] for i, (_, t) in enumerate(order)}
    for rows in (1, 3, 100):
        dealt, window = imatch.with_next(df, rows_a_bucket=rows)
        found = dealt.withColumn("following", F.lead("text").over(window)).where(~F.col("ghost_")).collect()
        assert len(found) == len(keys) and {r.text: r.following for r in found} == expected, rows


def test_every_term_of_the_band_counts(spark):
    """Whichever of 300 terms of the band a text lacks, its fingerprint differs, in one hash of 64 only."""
    common = [f"band{i}" for i in range(300)]
    rows = [(i, " ".join(w for j, w in enumerate(common) if j != i)) for i in range(300)] + [(1000 + i, f"other{i}") for i in range(3000)]
    df = spark.createDataFrame([*rows, (-1, " ".join(common))], "doc_id long, text string")
    printed = {r.doc_id: r.fp for r in imatch.with_parts(df, "text", imatch.lexicon_parts(df), "fp").where("doc_id < 1000").collect()}
    whole = printed.pop(-1).split("-")
    assert len(printed) == 300
    assert all(sum(a != b for a, b in zip(whole, fp.split("-"), strict=True)) == 1 for fp in printed.values())


def test_texts_with_few_terms_of_the_band_stay_like_their_edits(spark):
    text = " ".join(f"rare{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (2, text.replace("rare7", "new")), *((i, f"a{i} b{i}") for i in range(3, 600)), (600, None)], "doc_id long, text string")
    printed = imatch.with_parts(df, "text", imatch.lexicon_parts(df), "fp")
    found = {r.doc_id: r.fp for r in printed.collect()}
    pair = spark.createDataFrame([(found[1], found[2]), (found[1], found[3]), (found[1], found[600])], "a string, b string")
    likeness = [r.l for r in pair.select(imatch.likeness(F.col("a"), F.col("b")).alias("l")).collect()]
    assert likeness[0] > 0.8 and likeness[1] < 0.1 and likeness[2] == 0


def test_fingerprints_tell_edits_from_other_texts(spark):
    means = QUERIES["op4_imatch_fingerprints"](spark, "/root/testdata/sf0.01").agg(F.avg("near_edited").alias("e"), F.avg("near_next").alias("n")).first()
    assert means.e > 0.2 and means.n < 0.05


# ---- 5: languages


def test_languages_of_held_out_documents(spark):
    df = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = df.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count()


def test_mixture_finds_both_languages(texts, docs):
    model = language.learn(docs)
    langs = {r.doc_id: r.lang for r in docs.collect()}
    longest = {lang: max((t for k, t in texts.items() if langs[k] == lang), key=len)[:3000] for lang in ("en", "de")}
    found, _ = language.mixture(longest["en"] + "\n" + longest["de"][:1500], model)
    assert [lang for lang, _ in found] == ["en", "de"] and 0.55 < found[0][1] < 0.8
    alone, certain = language.mixture(longest["de"], model)
    assert [lang for lang, _ in alone] == ["de"] and certain > 0.99
    assert language.mixture("123 !!", model) == language.mixture(None, model) == ([], 0.0)


def test_unlabelled_documents_teach_nothing(spark):
    model = language.learn(awkward(spark).where("lang IS NULL"))
    assert model.languages == () and language.filtered(awkward(spark).where("lang IS NULL")).count() == 0


def test_expectation_maximisation_raises_the_likelihood(texts, docs):
    model = language.learn(docs)
    counts = language.trigrams(next(iter(texts.values())))
    at = np.flatnonzero(counts)
    n, chance = counts[at].astype(float), model.chance[at]
    start = np.full(len(model.languages), 1 / len(model.languages))
    share, after = language.expected(chance, n, start)
    assert after >= n @ np.log(chance @ start) and share.sum() == pytest.approx(1)


# ---- 6: sharding


def test_more_shards_take_rows_only_into_themselves(spark):
    rows = QUERIES["op6_rendezvous_sharding"](spark, "/root/testdata/sf0.1").collect()
    assert all(r.grown_shard in (r.shard, 40) for r in rows)
    counts, moved = Counter(r.shard for r in rows), sum(r.grown_shard == 40 for r in rows)
    assert set(counts) == set(range(40)) and max(counts.values()) < 1.3 * len(rows) / 40 and 0.7 < moved / (len(rows) / 41) < 1.3
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()}
    assert all(r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)


def test_weights_and_bad_weights(spark):
    df = sharding.assign_shards(spark.range(20_000).withColumnRenamed("id", "k"), "k", [3.0, 1.0, 0.0])
    counts = {r.shard: r["count"] for r in df.groupBy("shard").count().collect()}
    assert set(counts) == {0, 1} and 2.8 < counts[0] / counts[1] < 3.2
    with pytest.raises(ValueError, match="weights"):
        sharding.shard_of(F.col("k"), [])


def test_written_shards_come_back_whole(spark, tmp_path):
    df = sharding.assign_shards(spark.range(1000), "id", [1.0] * 4)
    sharding.write_shards(df, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1000


# ---- 7: toxicity


def test_toxic_documents_of_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.1"
    df = QUERIES["op7_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out AND toxic IS NOT NULL")
    rows = df.collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == k] for k in (1, 0))
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.02


def test_features_find_hidden_insults():
    empty = toxicity.Lexicon({})
    at = {name: i for i, name in enumerate(toxicity.FEATURES)}
    row = toxicity.describe("You are an 1d10t, a st*pid m0r0n! c l o w n".encode(), empty)
    assert row[at["obfuscated_insults"]] >= 2 and row[at["mixed_a_word"]] > 0
    near = toxicity.describe(b"you idiot. " + b"word " * 20 + b"trash", empty)
    assert near[at["insults"]] == 2 and near[at["near_address"]] == 1
    assert toxicity.describe(b"", empty) == [0.0] * len(toxicity.FEATURES)
    learnt = toxicity.describe("Loweischaft ist".encode(), toxicity.Lexicon({"lowei*": 3.0}))
    assert learnt[at["learnt"]] == 1 and learnt[at["learnt_most"]] == 3.0


def test_a_model_without_labels_scores_zero(spark):
    none = labels(spark).where(F.lit(False))
    sample = toxicity.sample_of(none)
    assert toxicity.learn_lexicon(awkward(spark), sample) == {}
    found = toxicity.features(awkward(spark), {})
    assert {r.score for r in toxicity.score(found, toxicity.fit_model(found, sample)).collect()} == {0.0}


# ---- 8: mixing


def test_shared_budget_stops_at_the_limit():
    given = mixing.shared([100, 100, 1000], [5, 2, 1], 1800, 2)
    assert given == pytest.approx([200, 200, 1400]) and mixing.shared([], [], 0, 2) == []
    again = mixing.shared([10, 500, 500], [5, 2, 1], 1500, 2)
    assert again[0] == 20 and sum(again) == pytest.approx(1500) and all(g <= 2 * s + 1e-9 for g, s in zip(again, [10, 500, 500], strict=True))


@pytest.mark.parametrize("block", [8, 64, 4096])
def test_words_taken_come_near_the_target(spark, block):
    """Also through several levels of the tree, and the same in another partitioning."""
    draw = random.Random(9)
    rows = [(i, i * 7 % 1009, "abc"[i % 3] if i % 5 else None, draw.randrange(0, 400)) for i in range(1500)]
    df = spark.createDataFrame(rows, "item_ long, order_ long, source string, size long")
    goals = saved(mixing.targets(df))
    found = mixing.copies(df, goals, block=block, fan=4)
    again = {r.item_: r.copies for r in mixing.copies(df.repartition(7), goals, block=block, fan=4).collect()}
    copies = {r.item_: r.copies for r in found.collect()}
    assert copies == again and len(copies) == len(rows) and set(copies.values()) <= {0, 1, 2}
    for goal in goals.collect():
        taken = sum(copies[i] * size for i, _, source, size in rows if source == goal.source)
        assert abs(taken - goal.target) <= 0.02 * goal.target + 1
    assert {g.source for g in goals.collect()} == {"a", "b", "c", None}


def test_copies_keep_their_expectation(spark):
    rows = [(i, i, "a", 10 + i % 5) for i in range(60)] + [(100 + i, 100 + i, "b", 30) for i in range(60)]
    df = saved(spark.createDataFrame(rows, "item_ long, order_ long, source string, size long"))
    goals = saved(mixing.targets(df, budget=0.5))
    total = Counter()
    for seed in range(6):
        total.update({r.item_: r.copies for r in mixing.copies(df, goals, seed=seed).collect()})
    times = {g.source: g.target / g.source_size for g in goals.collect()}
    for source in "ab":
        own = [total[i] / 6 for i, _, s, _ in rows if s == source]
        assert np.mean(own) == pytest.approx(times[source], abs=0.04) and max(own) <= math.ceil(times[source])


def test_equal_rows_are_split_into_blocks(spark):
    """500 equal rows of a null source are dealt into blocks of at most 64, alike in another partitioning."""
    rows = [(i, 7 if i < 500 else i, None if i < 500 else "a", 20) for i in range(600)]
    df = saved(spark.createDataFrame(rows, "item_ long, order_ long, source string, size long"))
    dealt = Counter(r.among_ for r in mixing._numbered(df, 64).where("order_ = 7").collect())
    assert sum(dealt.values()) == 500 and max(dealt.values()) <= 64 and dealt == Counter(i // 64 for i in range(500))
    goals = saved(mixing.targets(df))
    one, two = (mixing.copies(x, goals, block=64).join(df, "item_") for x in (df, df.repartition(5)))
    taken = [Counter((r.order_, r.copies) for r in x.collect()) for x in (one, two)]
    assert taken[0] == taken[1] and sum(taken[0].values()) == 600


def test_places_hold_in_any_parts(spark, tmp_path):
    spark.range(1000).withColumn("file", F.lit(1)).repartition(3).write.parquet(f"{tmp_path}/t")
    first = {r.id: (r.f, r.r) for r in placed(spark.read.parquet(f"{tmp_path}/t"), "f", "r").collect()}
    again = {r.id: (r.f, r.r) for r in placed(spark.read.parquet(f"{tmp_path}/t"), "f", "r").where("id % 2 = 0").repartition(7).collect()}
    assert len(set(first.values())) == 1000 and again == {k: v for k, v in first.items() if k % 2 == 0}


def test_repeated_labels_do_not_break_the_bound(spark):
    marked = spark.createDataFrame([(1, 1, 1)] * 3000 + [(i, i % 2, i % 2) for i in range(2, 2000)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        found = module.sample_of(marked, bound=500)
        assert 300 < found.count() < 700 and found.select("key_").distinct().count() == found.count()


def test_mixed_documents_keep_their_columns(spark):
    df = awkward(spark)
    out = mixing.mixed(df)
    assert out.columns == df.columns and out.where("doc_id = 7").count() <= 2


# ---- 9: language model


def test_scores_equal_a_plain_model(spark, texts):
    found = by_id(QUERIES["op9_kneser_ney_scores"](spark, FOLDER))
    tokens = {k: [w.lower() for w in t.encode().split()] + [2] for k, t in texts.items()}
    trained = [t for k, t in tokens.items() if zlib.crc32(str(k).encode()) % 7 != 2]
    single = Counter(w for t in trained for w in t)
    pairs = Counter(p for t in trained for p in zip([1, *t[:-1]], t, strict=True))
    ahead = Counter(w for _, w in pairs)

    def discounts(counts):
        n = [sum(v == k for v in counts.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        return [0] + [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]

    d, e = discounts(pairs), discounts(ahead)
    total, left = Counter(), defaultdict(float)
    for (v, _), n in pairs.items():
        total[v] += n
        left[v] += d[min(n, 3)]
    rest = sum(e[min(n, 3)] for n in ahead.values()) / len(pairs)

    def lower(w):
        return (ahead[w] - e[min(ahead[w], 3)]) / len(pairs) + rest / (len(single) + 1)

    def chance(v, w):
        return (pairs[v, w] - d[min(pairs[v, w], 3)] + left[v] * lower(w)) / total[v] if total[v] else lower(w)

    n, v = sum(single.values()), len(single)
    for k, t in tokens.items():
        row = found[k]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(t), sum(single[w] > 0 for w in t), n)
        assert row.base_score == pytest.approx(sum(math.log10((single[w] + 1) / (n + v + 1)) for w in t))
        assert row.score == pytest.approx(sum(math.log10(chance(*p)) for p in zip([1, *t[:-1]], t, strict=True)))
    some = tokens[0][0]
    assert sum(chance(some, w) for w in single) + left[some] * rest / (v + 1) / total[some] == pytest.approx(1)


def test_many_shards_and_blocks_score_alike(spark, docs, monkeypatch):
    plain = {r.key_: r.score for r in kneser_ney.score(docs, kneser_ney.train(docs)).collect()}
    for name, value in (("BLOCK_TOKENS", 900), ("SHARD_TOKENS", 2_000), ("WORD_SHARD_TOKENS", 9_000)):
        monkeypatch.setattr(kneser_ney, name, value)
    model = kneser_ney.train(docs.repartition(6))
    assert model.pair_shards > 10 and len(model.hot) > 1
    assert {r.key_: r.score for r in kneser_ney.score(docs, model).collect()} == pytest.approx(plain)


def test_scores_of_order_three_equal_a_plain_model(spark, texts):
    found = by_id(VARIANTS["op9_kneser_ney_scores_order3"](spark, FOLDER))
    tokens = {k: [w.lower() for w in t.encode().split()] + [2] for k, t in texts.items()}
    trained = [t for k, t in tokens.items() if zlib.crc32(str(k).encode()) % 7 != 2]
    single = Counter(w for t in trained for w in t)
    triples = Counter(x for t in trained for x in zip([1, *t[:-2]], t[:-1], t[1:], strict=True))
    pairs = Counter((v, w) for _, v, w in triples) + Counter((1, t[0]) for t in trained)
    ahead = Counter(w for _, w in pairs)

    def level(counts):
        n = [sum(v == k for v in counts.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [0] + [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
        total, left = Counter(), defaultdict(float)
        for gram, n in counts.items():
            total[gram[:-1]] += n
            left[gram[:-1]] += d[min(n, 3)]
        return d, total, left

    levels = {3: (triples, *level(triples)), 2: (pairs, *level(pairs))}
    e = level({(w,): n for w, n in ahead.items()})[0]
    rest = sum(e[min(n, 3)] for n in ahead.values()) / len(pairs)

    def chance(*gram):
        if len(gram) == 1:
            return (ahead[gram[0]] - e[min(ahead[gram[0]], 3)]) / len(pairs) + rest / (len(single) + 1)
        counts, d, total, left = levels[len(gram)]
        before, below = gram[:-1], chance(*gram[1:])
        return (counts[gram] - d[min(counts[gram], 3)] + left[before] * below) / total[before] if total[before] else below

    for k, t in tokens.items():
        grams = [(1, t[0]), *zip([1, *t[:-2]], t[:-1], t[1:], strict=True)]
        assert (found[k].n_tokens, found[k].n_known) == (len(t), sum(single[w] > 0 for w in t))
        assert found[k].score == pytest.approx(sum(math.log10(chance(*g)) for g in grams))
    u, v, _ = max(triples, key=triples.get)
    unknown = levels[3][3][u, v] / levels[3][2][u, v] * levels[2][3][v,] / levels[2][2][v,] * rest / (len(single) + 1)
    assert sum(chance(u, v, w) for w in single) + unknown == pytest.approx(1)


def test_many_shards_of_order_three_score_alike(spark, docs, monkeypatch):
    plain = {r.key_: r.score for r in kneser_ney.score(docs, kneser_ney.train(docs, order=3)).collect()}
    for name, value in (("BLOCK_TOKENS", 900), ("SHARD_TOKENS", 2_000), ("WORD_SHARD_TOKENS", 9_000), ("FEW", 3)):
        monkeypatch.setattr(kneser_ney, name, value)
    model = kneser_ney.train(docs.repartition(6), order=3)
    assert model.pair_shards > 10 and len(model.hot) > 1
    assert {r.key_: r.score for r in kneser_ney.score(docs, model).collect()} == pytest.approx(plain)


def test_order_three_on_awkward_and_on_no_texts(spark):
    df = awkward(spark)
    assert kneser_ney.score(df, kneser_ney.train(df, order=3)).count() == df.count()
    assert {r.score for r in kneser_ney.score(df, kneser_ney.train(df.limit(0), order=3)).collect()} == {0.0}


def test_few_long_texts_are_counted_in_several_groups(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "GROUP_BYTES", 1_000)
    long = spark.createDataFrame([(i, f"word{i} " * 400) for i in range(3)] + [(3, None)], "doc_id long, text_ string")
    assert kneser_ney.word_groups(long) == (4, 8)
    assert kneser_ney.word_groups(long.where("doc_id = 3")) == (1, 1) and kneser_ney.word_groups(long.limit(0)) == (0, 1)


def test_packed_numbers_come_back():
    values = np.sort(np.random.default_rng(4).integers(0, 2**63, 1000, dtype=np.uint64))
    assert (kneser_ney.unpack(kneser_ney.pack(values, rising=True), np.uint64, rising=True) == values).all()
    assert (kneser_ney.unpack(kneser_ney.pack(values), np.uint64) == values).all()


# ---- 10: packing


def test_pieces_are_the_tokenizer_s_ids(spark):
    df = awkward(spark)
    pieces = packing.token_pieces(df, **op10.TOKENIZER, with_ids=True).collect()
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = defaultdict(list)
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(bytes(p.ids)) and p.length * 4 == len(p.ids) and p.length <= 1024
        found[p.key_].append((p.piece, p.start, p.length, list(np.frombuffer(bytes(p.ids), "<u4"))))
    for row in df.where("doc_id IN (1, 2, 3, 7, 9, 10)").collect():
        ids = own.encode(row.text or "", add_special_tokens=False).ids + [2]
        parts = sorted(found[row.doc_id])
        assert [x for p in parts for x in p[3]] == ids
        assert [p[1] for p in parts] == list(np.cumsum([0] + [p[2] for p in parts[:-1]]))
        assert all(p[2] == 1024 for p in parts[1:])
    assert len(found[4]) == 2


def test_fast_and_slow_ids_agree():
    encoder = packing.Encoder(**op10.TOKENIZER)
    draw = random.Random(8)
    letters = [chr(i) for i in (9, 10, 13, *range(32, 127), *range(0xA1, 0x250), *range(0x2013, 0x2027))]
    for _ in range(3000):
        text = "".join(draw.choice(letters if draw.random() < 0.5 else "  \n'abcdtmsvell") for _ in range(draw.randrange(40)))
        assert encoder.OTHER.search(text) is None
        assert list(encoder.ids(text)) == encoder.slow.encode(text, add_special_tokens=False).ids


def places_hold(rows, sizes, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, sizes[r.item_]))
    for own in bins.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("block", [64, 65_536])
def test_bins_are_gapless_and_few(spark, block):
    draw = random.Random(6)
    sizes = {i: draw.choice((draw.randrange(1, 1025), draw.randrange(1, 200), 1024, 300)) for i in range(3000)}
    df = saved(spark.createDataFrame(list(sizes.items()), "item_ long, length int").repartition(6))
    rows = packing.pack(df, block=block).collect()
    assert len(rows) == len(sizes)
    bins = places_hold(rows, sizes, 1024)
    assert bins <= (1.2 if block == 64 else 1.02) * sum(sizes.values()) / 1024 + 1


@pytest.mark.parametrize("block", [64, 65_536])
def test_sorted_items_take_no_more_bins(spark, block):
    """Long ones in the first files and those that fit beside them in the last; a block of 64 has them uneven by chance."""
    sizes = {i: 600 if i < 2000 else 424 for i in range(4000)}
    df = saved(spark.createDataFrame(list(sizes.items()), "item_ long, length int").coalesce(1).repartitionByRange(4, "item_"))
    rows = packing.pack(df, block=block).collect()
    assert len(rows) == 4000 and places_hold(rows, sizes, 1024) <= (1.05 if block == 64 else 1.02) * 2000


def test_items_that_never_fit_together_end_the_rounds(spark):
    sizes = {i: 600 for i in range(500)}
    rows = packing.pack(spark.createDataFrame(list(sizes.items()), "item_ long, length int"), block=64).collect()
    assert places_hold(rows, sizes, 1024) == len(rows) == 500


def test_best_fit_takes_the_fullest_bin():
    assert packing.best_fit(np.array([6, 5, 4, 4, 1]), 10) == [[0, 2], [1, 3, 4]]
    assert packing.best_fit(np.array([], dtype=int), 10) == []


def test_texts_meet_decisions_in_the_same_way_at_any_size(spark):
    """Small decisions are not broadcast either, so the disk that texts take grows with them from the first."""
    df = spark.createDataFrame([(i, f"w{i} " * (20 + i % 7), "en", "ab"[i % 2], 9) for i in range(60)], "doc_id long, text string, lang string, source string, n_chars int")
    for made in (mixing.mixed(df), minhash.one_of_each(df)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert made.columns == df.columns and made.count() > 0
