"""Conversation repair, the Merkle manifest and SentencePiece pieces against brute force and round trips."""

import random
import zlib
from hashlib import sha256
from itertools import product

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from mediaspark.llm import merkle, op11, op12, op13, pieces, repair
from mediaspark.llm.queries import QUERIES
from tests.llm.helpers import awkward, nothing

# ---- 11: conversations


def by_force(rows):
    """Cheapest edits of (initial, fault) rows, by trying every one with up to three insertions in a gap."""
    best = None
    choices = [[("D", "", 2)] if fault in (1, 2) else [("D", "", 2), ("K", initial, 5 * (fault == 3)), ("R", "u", 1 + 5 * (fault == 3)), ("R", "a", 1 + 5 * (fault == 3))]
               for initial, fault in rows]
    inserted = [[("I", r, 5) for r in roles] for n in range(3) for roles in product("ua", repeat=n)]
    for gaps in product(inserted, repeat=len(rows) + 1):
        if sum(map(len, gaps)) > 3:
            continue
        for edits in product(*choices):
            path = [e for gap, edit in zip(gaps, [*edits, None], strict=True) for e in [*gap, *([edit] if edit else [])]]
            left = "".join(role for _, role, _ in path)
            body = left.removeprefix("s")
            if body == "ua" * (len(body) // 2) and (body or not left):
                found = (sum(c for _, _, c in path), "".join(e for e, _, _ in path))
                best = found if best is None else min(best, found)
    return best


def test_cheapest_edits_equal_brute_force():
    rng = random.Random(11)
    for _ in range(150):
        rows = [(rng.choice("ssuuaax"), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(4))]
        assert tuple(repair.cheapest(rows)) == by_force(rows), rows


def test_segments_join_to_the_same_edits():
    rng = random.Random(12)
    for _ in range(200):
        rows = [(rng.choice("suuaax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(1, 14))]
        joiner, at = repair.Joiner(), 0
        while at < len(rows):
            size = rng.randrange(1, 5)
            part, at = rows[at : at + size], at + size
            ways = [(s, e, *w) for s in repair.EVERY for e in repair.EVERY if (w := repair.cheapest(part, s, (e,))) is not None]
            joiner.add(ways)
        assert joiner.result() == repair.cheapest(rows), rows


def test_a_long_conversation_takes_linear_steps():
    rng = random.Random(13)
    rows = [(rng.choice("suax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(20_000)]
    way = repair.cheapest(rows)
    assert len(way.audit.replace("I", "")) == 20_000 and way.cost == repair.suffix_bounds(rows, repair.ENDS)[0][repair.NOTHING]


CONVERSATIONS = [
    (1, None, "user", "hm."), (1, 0, "system", "be kind."), (1, 1, "user", "hello?"), (1, 1, "user", "hello?"), (1, 5, None, None), (1, 6, "assistant", "Yes"),
    (2, 3, "", "x."), (2, 4, "tool", " "), (None, 1, "user", "a."), (None, None, "assistant", "b!"), (4, 0, "user", "long. " * 50_000),
    (-7, 2**40, "assistant", "\t\n"), (-7, -5, "user", "no end"),
]


def plain_report(rows):
    """What the query returns, from all rows of one conversation in plain code."""
    damaged = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        damaged += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha256(r[2].encode()).digest()))
    coded, seen = [], set()
    for _, role, text in damaged:
        shown = text.strip("\x20\t\n\x0b\x0c\r")
        coded.append((role[:1], 1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0))
        seen.add((role, text))
    turns = [t for t, _, _ in damaged if t is not None]
    way = repair.cheapest(coded)
    written = [f"{r}:{t}" for r, t in repair.rewritten(way.audit, iter([d[1:] for d in damaged]))]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{name: sum(f == n for _, f in coded) for n, name in ((1, "blank"), (2, "duplicate"), (3, "truncated"))},
        "illegal": sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:], strict=False)),
        "cost": way.cost,
        "audit": way.audit,
        "repaired_sha256": sha256("\n".join(written).encode()).hexdigest(),
    }


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, conv_ string")


@pytest.mark.parametrize("segment", [2, repair.SEGMENT])
def test_awkward_conversations_equal_plain_code(spark, segment):
    rng = random.Random(5)
    hot = [(9, rng.choice([None, *range(400)]), rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", " ", "c!"])) for _ in range(600)]
    rows = CONVERSATIONS + hot
    found = repair.report(op11.damaged(table_of(spark, rows)), segment=segment).collect()
    expected = {c: plain_report([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert len(found) == len(expected)
    for row in found:
        given = row.asDict()
        assert given == {"conv_": row.conv_, **expected[row.conv_]}


def test_repaired_rows_hash_to_the_report(spark):
    rows = op11.damaged(table_of(spark, CONVERSATIONS))
    written = {}
    for r in sorted(repair.repaired(rows, segment=2).collect(), key=lambda r: r.place_):
        written.setdefault(r.conv_, []).append(f"{r.role_}:{r.text_}")
    for r in repair.report(rows).collect():
        assert r.repaired_sha256 == sha256("\n".join(written.get(r.conv_, [])).encode()).hexdigest()


def test_no_conversations(spark):
    assert repair.report(op11.damaged(table_of(spark, CONVERSATIONS).where("false"))).count() == 0


# ---- 12: manifest


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(leaves):
    """Root and each leaf's steps: (sibling or None, whether it stands to the left)."""
    steps, level, places = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, at in enumerate(places):
            steps[i].append((level[at ^ 1] if at ^ 1 < len(level) else None, at & 1))
        level = [digest(*level[i : i + 2]) for i in range(0, len(level), 2)]
        places = [at // 2 for at in places]
    return level[0], steps


def plain_manifest(docs):
    trees = {}
    for d in docs:
        trees.setdefault(d["lang"], []).append((d["doc_id"] is not None, d["doc_id"] or 0, plain_leaf(*(d[c] for c in op12.FIELDS)), d))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {n: plain_tree([x[2] for x in sorted(trees[n], key=lambda x: x[:3])]) for n in names}
    root, above = plain_tree([made[n][0] for n in names])
    rows = []
    for name, upper in zip(names, above, strict=True):
        for (_, _, leaf, d), steps in zip(sorted(trees[name], key=lambda x: x[:3]), made[name][1], strict=True):
            path = steps + upper
            chosen = d["doc_id"] is not None and d["n_chars"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 7 == 0
            node = plain_leaf(d["doc_id"], d["source"], d["lang"], d["n_chars"] + 1, d["text"]) if chosen else leaf
            for sibling, left in path:
                node = digest(node) if sibling is None else digest(sibling, node) if left else digest(node, sibling)
            rows.append((d["doc_id"], leaf, made[name][0], root, digest(*(s for s, _ in path if s)), node, node == root))
    return rows


@pytest.mark.parametrize("height", [1, 2, 12])
def test_proofs_equal_plain_trees_at_any_record_size(spark, height):
    langs = [None, "", "de", "en", "zz", "é"]
    rows = [(i * 7 % 101, f"text {i}" * (i % 5), langs[min(i % 9, 5)], None if i % 4 == 0 else "web", None if i % 11 == 0 else i) for i in range(83)]
    docs = awkward(spark).unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    found = op12.manifest_rows(docs, height).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(plain_manifest([r.asDict() for r in docs.collect()]), key=repr)


def test_requests_open_only_their_leaves(spark):
    docs = spark.range(9_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    made = merkle.manifest(docs.withColumn("leaf", F.unhex("leaf")), tree="lang", order=["doc_id"], leaf="leaf", payload=["doc_id"])
    asked = spark.createDataFrame([("=en", 0), ("=en", 4_095), ("=en", 4_096), ("=en", 8_999), ("=en", 9_000), ("=xx", 0)], "tree_ string, rank_ long")
    found = merkle.proofs(made, asked).collect()
    assert sorted(r.rank_ for r in found) == [0, 4_095, 4_096, 8_999] == sorted(r.doc_id for r in found)
    assert all(merkle.folded(r.node.hex(), bytes(r.path))[0] == r.root.hex() for r in found)


def test_a_changed_record_is_refused(spark):
    docs = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("leaf"))
    made = merkle.manifest(docs, tree="lang", order=["doc_id"], leaf="leaf", payload=["doc_id"])
    forged = F.when(F.col("rank_") == 3, F.unhex(F.sha2(F.lit("other"), 256))).otherwise(F.col("node"))
    made.trees.rounds[0] = made.trees.rounds[0].withColumn("node", forged)
    with pytest.raises(Exception, match="does not hold"):
        merkle.proofs(made).collect()


# ---- 13: pieces

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=op13.MODEL)
ALPHABET = "ab c  \n\té日本😀́▁<s> 　①ﬁ​Ａ\x00"


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(13)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30))) for _ in range(2_000)]


def test_ids_spans_and_decoding_equal_the_library(odd_texts):
    model = pieces.loaded(op13.MODEL)
    ids, begins, ends = model.encode([t.encode() for t in odd_texts])
    assert ids == LIBRARY.encode(odd_texts)
    assert model.decode(ids) == [LIBRARY.decode(i) for i in ids]
    for text, begin, end in zip(odd_texts, begins, ends, strict=True):
        expected = [(p.begin, p.end) for p in LIBRARY.encode(text, return_type="proto").pieces]
        assert list(zip(begin.tolist(), end.tolist(), strict=True)) == expected


@pytest.mark.parametrize("rules", list(product([False, True], repeat=3)))
@pytest.mark.parametrize("name", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_normaliser_equals_the_library_for_compiled_maps(odd_texts, name, rules):
    prefix, one_space, marked = rules
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=name, add_dummy_prefix=prefix, remove_extra_whitespaces=one_space, escape_whitespaces=marked)
    spec = dict(pieces.fields(dict(pieces.fields(theirs.serialized_model_proto()))[pieces.NORMALISER]))
    ours = object.__new__(pieces.Model)
    ours.map, ours.users = pieces.CharacterMap(spec.get(pieces.MAP, b"")), None
    ours.beginnings = ours.map.beginnings()
    ours.add_prefix, ours.one_space, ours.mark_space = rules
    for text in odd_texts[:600]:
        normal, places = theirs.normalize(text, with_offsets=True)
        new, origin = ours.normalise(text.encode())
        starts = np.cumsum([0, *(len(c.encode()) for c in text)])
        chars = np.cumsum([0, *(len(c.encode()) for c in normal)])
        assert (new.decode(), [int(origin[i]) for i in chars]) == (normal, [int(starts[p]) for p in places])


def test_all_documents_equal_the_library(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in QUERIES["op13_sentencepiece"](spark, folder).collect():
        ids = LIBRARY.encode(texts[row.doc_id])
        assert row.n_tokens == len(ids) and row.bytes_spanned == len(texts[row.doc_id].encode())
        assert row.ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_awkward_texts_are_encoded_whole(spark):
    found = pieces.encoded(awkward(spark), op13.MODEL).collect()
    texts = [r.text or "" for r in awkward(spark).collect()]
    expected = sorted((LIBRARY.encode(t), LIBRARY.decode(LIBRARY.encode(t)) if t else "") for t in texts)
    assert sorted((r.ids, r.decoded) for r in found) == expected
    for row in found:
        assert len(row.ids) == len(row.begins) == len(row.ends)
        assert all(b == e for b, e in zip(row.begins[1:], row.ends, strict=False))  # spans tile the text
    assert pieces.encoded(nothing(spark), op13.MODEL).count() == 0


def test_bytes_that_are_no_utf8_are_replaced():
    assert pieces._valid(b"a\xffb") == "a�b".encode()
