"""Query op4_imatch_fingerprints: fingerprints of every document and of its edited text.

Every term of the band is dealt into one of the lexicons. The variant op4_imatch_fingerprints_random_lexicons draws
smaller lexicons, which together hold about a fifth of the band.
"""

from pyspark.sql import functions as F

from mediaspark.llm import imatch
from mediaspark.llm.registry import query, table, variant

_HEX = ", ".join(f"'{i:02x}'" for i in range(imatch.KEPT))

OP4_SQL = rf"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
ordered AS (
    SELECT *, length(text) AS n, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id
    FROM base WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edited AS (SELECT doc_id, n, next_id, text, substr(text, 1, n - n // 3) || substr(next_text, 1, n // 3) AS edited FROM ordered),
words AS (
    SELECT doc_id, kind, list_distinct(regexp_extract_all(lower(t), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS terms
    FROM (SELECT doc_id, 'own' AS kind, text AS t FROM edited UNION ALL SELECT doc_id, 'edited', edited FROM edited)),
lexicon AS (
    SELECT t, list_filter(range({imatch.SUBSETS}), lambda j: substr(md5(t), CAST(2 * j + 1 AS INT), 2) IN ({_HEX})) AS s
    FROM (SELECT unnest(terms) AS t FROM words WHERE kind = 'own') GROUP BY t
    HAVING count(*) * {imatch.LOW[1]} >= {imatch.LOW[0]} * (SELECT count(*) FROM documents)
       AND count(*) * {imatch.HIGH[1]} <= {imatch.HIGH[0]} * (SELECT count(*) FROM documents)),
used AS (
    SELECT doc_id, kind, list({{'t': t, 's': s}}) AS found
    FROM (SELECT doc_id, kind, unnest(terms) AS t FROM words) JOIN lexicon USING (t) WHERE len(s) > 0 GROUP BY doc_id, kind),
hits AS (SELECT doc_id, kind, terms AS all_terms, coalesce(found, []) AS found FROM words LEFT JOIN used USING (doc_id, kind)),
prints AS (
    SELECT doc_id, kind, CASE WHEN len(found) = 0 THEN md5(coalesce(array_to_string(list_sort(all_terms), ' '), ''))
           ELSE array_to_string(list_transform(range({imatch.SUBSETS}), lambda j: CASE WHEN len(list_filter(found, lambda e: list_contains(e.s, j))) = 0 THEN ''
                ELSE substr(md5(array_to_string(list_transform(list_sort(list_filter(found, lambda e: list_contains(e.s, j))), lambda e: e.t), ' ')), 1, 8) END), '-') END AS fp
    FROM hits),
joined AS (
    SELECT e.doc_id, e.n, e.edited, a.fp, b.fp AS fp_edited, c.fp AS fp_next
    FROM edited e JOIN prints a ON a.doc_id = e.doc_id AND a.kind = 'own' JOIN prints b ON b.doc_id = e.doc_id AND b.kind = 'edited'
    JOIN prints c ON c.doc_id = e.next_id AND c.kind = 'own')
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, fp AS fingerprint, fp_edited AS edited_fingerprint,
       @EDITED@ AS near_edited, @NEXT@ AS near_next
FROM joined"""

_LIKE = """CASE WHEN contains(fp, '-') AND contains({0}, '-')
    THEN len(list_filter(list_zip(string_split(fp, '-'), string_split({0}, '-')), lambda p: p[1] <> '' AND p[1] = p[2]))
       / len(list_filter(list_zip(string_split(fp, '-'), string_split({0}, '-')), lambda p: p[1] <> '' OR p[2] <> ''))
    ELSE CAST(fp = {0} AS DOUBLE) END"""


_PART = "(strpos('0123456789abcdef', substr(md5(t), 1, 1)) - 1) * 16 + strpos('0123456789abcdef', substr(md5(t), 2, 1)) - 1"
_HELD = "list_filter(found, lambda e: e.p = j)"

WHOLE_SQL = f"""{OP4_SQL[: OP4_SQL.index("lexicon AS (")]}lexicon AS (
    SELECT t FROM (SELECT unnest(terms) AS t FROM words WHERE kind = 'own') GROUP BY t
    HAVING count(*) * {imatch.LOW[1]} >= {imatch.LOW[0]} * (SELECT count(*) FROM documents)
       AND count(*) * {imatch.HIGH[1]} <= {imatch.HIGH[0]} * (SELECT count(*) FROM documents)),
band AS (SELECT doc_id, kind, list(t) AS held FROM (SELECT doc_id, kind, unnest(terms) AS t FROM words) JOIN lexicon USING (t) GROUP BY doc_id, kind),
hits AS (
    SELECT doc_id, kind, list_transform(list_sort(CASE WHEN coalesce(len(held), 0) < {imatch.FEW_HELD} THEN terms ELSE held END),
                                        lambda t: {{'t': t, 'p': ({_PART}) % {imatch.PARTS}}}) AS found
    FROM words LEFT JOIN band USING (doc_id, kind)),
prints AS (
    SELECT doc_id, kind, CASE WHEN len(found) = 0 THEN md5('')
           ELSE array_to_string(list_transform(range({imatch.PARTS}), lambda j: CASE WHEN len({_HELD}) = 0 THEN ''
                ELSE substr(md5(array_to_string(list_transform({_HELD}, lambda e: e.t), ' ')), 1, 8) END), '-') END AS fp
    FROM hits),
{OP4_SQL[OP4_SQL.index("joined AS (") :]}"""


def _with_likeness(sql):
    return sql.replace("@EDITED@", _LIKE.format("fp_edited")).replace("@NEXT@", _LIKE.format("fp_next"))


@query("op4_imatch_fingerprints", _with_likeness(WHOLE_SQL))
def op4_imatch_fingerprints(spark, folder):
    return _fingerprints(spark, folder, imatch.lexicon_parts, imatch.with_parts)


@variant("op4_imatch_fingerprints_random_lexicons", _with_likeness(OP4_SQL))
def op4_imatch_fingerprints_random_lexicons(spark, folder):
    return _fingerprints(spark, folder, imatch.lexicon, imatch.with_fingerprint)


def _fingerprints(spark, folder, lexicon, with_fingerprint):
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    slots = lexicon(docs)
    dealt, order = imatch.with_next(docs)
    n = F.char_length("text").cast("long")
    third = F.floor(n / 3).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), n.cast("int") - third)
    staged = dealt.withColumn("next_text", F.lead("text").over(order)).select(
        "doc_id",
        "text",
        "ghost_",
        "b_",
        n.alias("n_chars"),
        F.concat(kept, F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third)).alias("edited"),
    )
    own = with_fingerprint(staged, "text", slots, "fingerprint")
    both = with_fingerprint(own, "edited", slots, "edited_fingerprint")
    named = both.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("edited")
    following = named.withColumn("next_fingerprint", F.lead("fingerprint").over(order)).where(~F.col("ghost_"))
    return following.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        imatch.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        imatch.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
