"""Query op3_minhash_near_duplicates: components of documents that share 85 % of their 3-word shingles."""

from pyspark.sql import functions as F

from mediaspark.llm import minhash
from mediaspark.llm.registry import query, table

OP3_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                   WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS found FROM documents UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.found)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(found) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)"""


@query("op3_minhash_near_duplicates", OP3_SQL)
def op3_minhash_near_duplicates(spark, folder):
    found = minhash.near_duplicates(table(spark, folder, "documents"), size=3, num=85, den=100)
    return found.select(
        F.col("key_").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("key_").eqNullSafe(F.col("component")).alias("kept"),
    )
