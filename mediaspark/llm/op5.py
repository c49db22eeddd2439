"""Query op5_language_id: the main language of every document, learnt from two folds of three."""

from pyspark.sql import functions as F

from mediaspark.llm import language
from mediaspark.llm.common import fold
from mediaspark.llm.registry import query, table

FOLDS, HELD_OUT = 3, 1


@query("op5_language_id")
def op5_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    model = language.learn(docs.where(fold("doc_id", FOLDS) != HELD_OUT))
    found = docs.select("doc_id", language.identify(F.col("text"), model).alias("found"))
    return found.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.to_json("found.languages").alias("languages"),
    )
