"""Query op7_toxicity: calibrated toxicity of every document, learnt from three folds of four."""

from pyspark.sql import functions as F

from mediaspark.llm import toxicity
from mediaspark.llm.common import fold
from mediaspark.llm.registry import query, table

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3


@query("op7_toxicity")
def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    sample = toxicity.sample_of(table(spark, folder, "labels").where(fold("doc_id", FOLDS) != HELD_OUT))
    found = toxicity.features(docs, toxicity.learn_lexicon(docs, sample))
    model = toxicity.fit_model(found, sample)
    return toxicity.score(found, model).select(
        F.col("key_").alias("doc_id"),
        (fold("key_", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
