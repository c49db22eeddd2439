"""Query op9_kneser_ney_scores: probability of every document, learnt from six folds of seven.

Its variant op9_kneser_ney_scores_order3 knows two words of history instead of one.
"""

from pyspark.sql import functions as F

from mediaspark.llm import kneser_ney
from mediaspark.llm.common import fold
from mediaspark.llm.registry import query, table, variant

FOLDS, HELD_OUT = 7, 2


def _scores(spark, folder, order):
    docs = table(spark, folder, "documents")
    model = kneser_ney.train(docs.where(fold("doc_id", FOLDS) != HELD_OUT), order=order)
    return kneser_ney.score(docs, model).select(
        F.col("key_").alias("doc_id"),
        (fold("key_", FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


@query("op9_kneser_ney_scores")
def op9_kneser_ney_scores(spark, folder):
    return _scores(spark, folder, 2)


@variant("op9_kneser_ney_scores_order3")
def op9_kneser_ney_scores_order3(spark, folder):
    return _scores(spark, folder, 3)
