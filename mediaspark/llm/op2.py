"""Query op2_license_scan: words, base phrases and detected licenses of every document."""

from pyspark.sql import functions as F

from mediaspark.llm import licenses
from mediaspark.llm.registry import query, table

W, B = licenses.WORD, licenses.BREAK
# Phrases and their labels. Each phrase ends in "license", so two never overlap.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
ANY_PHRASE = f"(?i)(?<!{W})(?:" + "|".join(p.replace(" ", f"{B}+") for p, _ in PHRASES) + f")(?!{W})"


@query("op2_license_scan")
def op2_license_scan(spark, folder):
    text = F.coalesce(F.col("text"), F.lit(""))
    words = lambda x: F.regexp_count(x, F.lit(f"{W}+"))
    scanned = licenses.scan(table(spark, folder, "documents").select("doc_id", text.alias("text")))
    spoken = F.contains(F.lower("text"), F.lit("license"))
    counted = scanned.select(
        "doc_id",
        "detections",
        words(F.col("text")).cast("long").alias("n_words"),
        F.when(spoken, licenses.pieces_of(F.col("text"), F.lit(ANY_PHRASE))).otherwise(F.array(F.lit(""))).alias("pieces"),
        F.when(spoken, F.regexp_extract_all("text", F.lit(ANY_PHRASE), F.lit(0))).otherwise(F.array().cast("array<string>")).alias("matches"),
    )
    n_base = F.size("matches")
    label = lambda m: F.coalesce(*(F.when(F.startswith(F.lower(m), F.lit(p.split()[0])), F.lit(x)) for p, x in PHRASES))
    last = words(F.element_at("pieces", -1)) + words(F.element_at("matches", -1))
    base_labels = F.array_sort(F.array_distinct(F.transform("matches", label)))
    own_labels = F.transform("detections", lambda d: d["label"])
    return counted.select(
        "doc_id",
        "n_words",
        n_base.cast("long").alias("n_base"),
        F.when(n_base > 0, words(F.element_at("pieces", 1))).cast("long").alias("first_word"),
        F.when(n_base > 0, F.col("n_words") - last).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own_labels))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
        F.to_json("detections").alias("detections"),
    )
