"""Query op6_rendezvous_sharding: all documents in 40 equal shards by their doc_id."""

from pyspark.sql import functions as F

from mediaspark.llm import sharding
from mediaspark.llm.registry import query, table

SHARDS = 40


@query("op6_rendezvous_sharding")
def op6_rendezvous_sharding(spark, folder):
    text = F.coalesce(F.col("text"), F.lit(""))
    records = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = sharding.assign_shards(records, "doc_id", [1.0] * SHARDS)
    grown = sharding.assign_shards(placed, "doc_id", [1.0] * (SHARDS + 1), shard="grown_shard")
    numbered = sharding.number_rows(grown, "shard", ["doc_id", "size", "text_crc32"])
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
