"""Query op1_quality_rules: counts and verdict of every document."""

from pyspark.sql import functions as F

from mediaspark.llm import quality
from mediaspark.llm.registry import query, table


@query("op1_quality_rules")
def op1_quality_rules(spark, folder):
    found = quality.statistics(table(spark, folder, "documents"))
    forest = quality.fit_rules(found, quality.sample_of(table(spark, folder, "labels")))
    verdicts = quality.apply_rules(found, forest)
    return verdicts.select(F.col("key_").alias("doc_id"), *quality.COUNTS, "base_failed", "kept", "score")
