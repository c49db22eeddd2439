"""Query op13_sentencepiece: token ids of every document, and the text they decode to."""

import public_tokenizers
from pyspark.sql import functions as F

from mediaspark.llm import pieces
from mediaspark.llm.registry import query, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@query("op13_sentencepiece")
def op13_sentencepiece(spark, folder):
    found = pieces.encoded(table(spark, folder, "documents"), MODEL)
    hashed = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select(
        F.col("key_").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        hashed(F.array_join("ids", ",")).alias("ids_sha256"),
        hashed(F.col("decoded")).alias("decoded_sha256"),
        F.coalesce(F.get("ends", F.size("ends") - 1), F.lit(0)).alias("bytes_spanned"),
    )
