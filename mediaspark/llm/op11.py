"""Query op11_conversation_repair: damaged conversations and the cheapest edits that mend their structure."""

from pyspark.sql import functions as F

from mediaspark.llm import repair
from mediaspark.llm.registry import CRC_SQL, query, table

KINDS = 20
DROPPED, EMPTIED, UNENDED, REPEATED, TURNED = range(5)

# States: nothing, system, user or assistant written last. Keys are never null; costs lead the text that is minimised.
OP11_SQL = rf"""
WITH RECURSIVE base AS (
    SELECT *, {CRC_SQL.format("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % {KINDS} AS kind,
           coalesce(CAST(conv_id AS VARCHAR), 'null') AS c
    FROM conversations),
hurt AS (
    SELECT c, turn, CASE WHEN kind = {TURNED} THEN 'user' ELSE coalesce(role, ' ') END AS role,
           CASE kind WHEN {EMPTIED} THEN '' WHEN {UNENDED} THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
    FROM base, (SELECT unnest([0, 1]) AS copy) WHERE kind <> {DROPPED} AND (copy = 0 OR kind = {REPEATED})),
numbered AS (
    SELECT *, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
           regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS shown
    FROM hurt),
flagged AS (
    SELECT *, CASE WHEN shown = '' THEN 1 WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 2 WHEN shown NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
           lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair
    FROM numbered),
facts AS (
    SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
           count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM flagged GROUP BY c),
writes(s, t, initial) AS (VALUES (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')),
gaps(s, t, letters, cost) AS (
    SELECT unnest([0, 1, 2, 3]), unnest([0, 1, 2, 3]), '', 0 UNION ALL SELECT s, t, 'I', 5 FROM writes
    UNION ALL SELECT a.s, b.t, 'II', 10 FROM writes a JOIN writes b ON b.s = a.t),
edits(s, t, letter, need, cost) AS (
    SELECT unnest([0, 1, 2, 3]), unnest([0, 1, 2, 3]), 'D', '', 2 UNION ALL SELECT 0, 1, 'K', 's', 0
    UNION ALL SELECT s, t, 'K', initial, 0 FROM writes UNION ALL SELECT s, t, 'R', '', 1 FROM writes),
moves AS (SELECT g.s, e.t, letters || letter AS letters, letter, need, g.cost + e.cost AS cost FROM gaps g JOIN edits e ON e.s = g.t),
convs AS (SELECT DISTINCT c, conv_id FROM base),
best AS (
    SELECT c, 0 AS i, 0 AS s, '000000000000' AS v FROM convs
    UNION ALL
    SELECT d.c, d.i + 1, m.t,
           min(lpad(CAST(CAST(substr(v, 1, 12) AS BIGINT) + cost + CASE WHEN fault = 3 AND letter <> 'D' THEN 5 ELSE 0 END AS VARCHAR), 12, '0') || substr(v, 13) || letters)
    FROM best d JOIN flagged f ON f.c = d.c AND f.i = d.i + 1
    JOIN moves m ON m.s = d.s AND (letter = 'D' OR (fault IN (0, 3) AND (need = '' OR need = initial))) GROUP BY d.c, d.i, m.t),
chosen AS (
    SELECT c, min(lpad(CAST(CAST(substr(v, 1, 12) AS BIGINT) + cost AS VARCHAR), 12, '0') || substr(v, 13) || letters) AS v
    FROM best JOIN gaps USING (s) LEFT JOIN facts USING (c) WHERE i = coalesce(n, 0) AND t IN (0, 3) GROUP BY c),
letters AS (
    SELECT c, p, substr(v, 12 + p, 1) AS letter, p - len(replace(substr(v, 13, p), 'I', '')) AS inserted, len(replace(substr(v, 13, p), 'D', '')) AS k
    FROM (SELECT c, v, unnest(range(1, len(v) - 11)) AS p FROM chosen)),
written AS (
    SELECT l.c, p, k, letter, role, text, max(CASE WHEN k = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.c) AS has_system
    FROM letters l LEFT JOIN flagged f ON f.c = l.c AND f.i = p - inserted AND letter <> 'I' WHERE letter <> 'D'),
repaired AS (
    SELECT c, string_agg(CASE WHEN letter = 'K' THEN role WHEN (k - has_system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS body
    FROM written GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(substr(v, 1, 12) AS BIGINT) AS cost, substr(v, 13) AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM convs JOIN chosen USING (c) LEFT JOIN facts USING (c) LEFT JOIN repaired USING (c)"""


def damaged(rows):
    """Rows as the repair reads them, damaged by the CRC of conversation and turn; a null counts as one space.

    A dropped row stays to name its conversation; a repeated one comes twice.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % KINDS
    given = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == EMPTIED, "").when(F.col("kind") == UNENDED, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == TURNED, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    hurt = given.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != DROPPED).alias("live"), copies.alias("copy"))
    return repair.prepared(hurt, live="live")


@query("op11_conversation_repair", OP11_SQL)
def op11_conversation_repair(spark, folder):
    found = repair.report(damaged(table(spark, folder, "conversations")))
    return found.withColumnRenamed("conv_", "conv_id")
