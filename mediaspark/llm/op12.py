"""Query op12_merkle_manifest: leaf, roots and checked proof of every document."""

import pyarrow as pa
from pyspark.sql import functions as F

from mediaspark.llm import merkle
from mediaspark.llm.common import saved
from mediaspark.llm.registry import CRC_SQL, query, table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_OF = 7


def _leaf_sql(n_chars: str) -> str:
    values = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


OP12_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, coalesce('=' || lang, '') AS tree, {_leaf_sql("n_chars")} AS leaf,
           CASE WHEN doc_id IS NOT NULL AND {CRC_SQL.format("CAST(doc_id AS VARCHAR)")} % {TAMPERED_OF} = 0 THEN {_leaf_sql("(n_chars + 1)")} END AS tampered
    FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes AS (
    SELECT tree, 0 AS h, k, n, leaf AS d FROM ranked
    UNION ALL
    SELECT tree, h + 1, k // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY k)) FROM nodes WHERE n > 1 GROUP BY tree, h, k // 2, n),
subroots AS (SELECT tree, d FROM nodes WHERE n = 1),
top_ranked AS (SELECT tree, d, row_number() OVER (ORDER BY tree) - 1 AS k, count(*) OVER () AS n FROM subroots),
top_nodes AS (
    SELECT 0 AS h, k, n, d FROM top_ranked
    UNION ALL
    SELECT h + 1, k // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY k)) FROM top_nodes WHERE n > 1 GROUP BY h, k // 2, n),
steps AS (
    SELECT r.tree, r.k, a.h, a.k & 1 AS odd, s.d AS sibling FROM ranked r
    JOIN nodes a ON a.tree = r.tree AND a.k = r.k >> a.h AND a.n > 1 LEFT JOIN nodes s ON s.tree = a.tree AND s.h = a.h AND s.k = xor(a.k, 1)),
top_steps AS (
    SELECT r.tree, 1000 + a.h AS h, a.k & 1 AS odd, s.d AS sibling FROM top_ranked r
    JOIN top_nodes a ON a.k = r.k >> a.h AND a.n > 1 LEFT JOIN top_nodes s ON s.h = a.h AND s.k = xor(a.k, 1)),
paths AS (
    SELECT tree, k, list({{'odd': odd, 'sibling': coalesce(sibling, '')}} ORDER BY h) AS path
    FROM (SELECT tree, k, h, odd, sibling FROM steps UNION ALL SELECT r.tree, r.k, t.h, t.odd, t.sibling FROM ranked r JOIN top_steps t ON t.tree = r.tree)
    GROUP BY tree, k),
climbed AS (
    SELECT tree, k, 0 AS h, coalesce(tampered, leaf) AS d, path FROM ranked LEFT JOIN paths USING (tree, k)
    UNION ALL
    SELECT tree, k, h + 1, CASE WHEN path[h + 1].odd = 1 THEN sha256(path[h + 1].sibling || d) ELSE sha256(d || path[h + 1].sibling) END, path
    FROM climbed WHERE h < coalesce(len(path), 0))
SELECT r.doc_id, r.leaf, s.d AS subroot, t.d AS root,
       sha256(coalesce(array_to_string(list_transform(c.path, lambda p: p.sibling), ''), '')) AS proof_sha256,
       c.d AS folded_root, c.d = t.d AS verified
FROM ranked r JOIN subroots s USING (tree) JOIN climbed c ON c.tree = r.tree AND c.k = r.k AND c.h = coalesce(len(c.path), 0)
CROSS JOIN (SELECT d FROM top_nodes WHERE n = 1) t"""


def leaves(docs):
    """doc_id, lang, leaf, and the tampered leaf where one is tampered with (null elsewhere and where n_chars is null)."""
    columns = {name: F.col(name) for name in FIELDS}
    leaf = lambda values: merkle.hashed(*map(merkle.field, values))
    more = {**columns, "n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    chosen = (F.crc32(F.col("doc_id").cast("string")) % TAMPERED_OF == 0) & F.col("n_chars").isNotNull()
    return docs.select("doc_id", "lang", leaf(columns.values()).alias("leaf"), F.when(chosen, leaf(more.values())).alias("tampered"))


def folded(found):
    """Adds proof_sha256 and folded_root, the root that the tampered leaf, else the leaf itself, and the path give."""

    def fold(batches):
        for batch in batches:
            given = zip(*(batch.column(c).to_pylist() for c in ("tampered", "node", "path")), strict=True)
            roots, proofs = zip(*(merkle.folded((t or n).hex(), p) for t, n, p in given), strict=True) if batch.num_rows else ((), ())
            names = [*batch.schema.names, "folded_root", "proof_sha256"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.string()), pa.array(proofs, pa.string())], names)

    return found.mapInArrow(fold, found.withColumn("folded_root", F.lit("")).withColumn("proof_sha256", F.lit("")).schema)


def manifest_rows(docs, height=merkle.HEIGHT):
    """Leaf, roots and checked proof of every document."""
    made = merkle.manifest(saved(leaves(docs)), tree="lang", order=["doc_id"], leaf="leaf", payload=["doc_id", "tampered"], height=height)
    shown = lambda c: F.lower(F.hex(c)).alias(c)
    found = folded(merkle.proofs(made)).withColumnRenamed("node", "leaf")
    return found.select(
        "doc_id", shown("leaf"), shown("subroot"), shown("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lower(F.hex("root"))).alias("verified")
    )


@query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark, folder):
    return manifest_rows(table(spark, folder, "documents"))
