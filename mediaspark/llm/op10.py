"""Query op10_best_fit_packing: tokens of all documents in sequences of at most 1,024."""

import public_tokenizers
from pyspark.sql import functions as F

from mediaspark.llm import packing
from mediaspark.llm.registry import query, table

TOKENIZER = {
    "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
    "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
}


def packed(docs):
    """One row for each piece with its place."""
    pieces = packing.token_pieces(docs, **TOKENIZER)
    places = packing.pack(pieces.select("item_", "length"))
    return pieces.join(places, "item_").select(
        F.col("key_").alias("doc_id"),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        F.col("offset").cast("long").alias("offset"),
    )


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark, folder):
    return packed(table(spark, folder, "documents"))
