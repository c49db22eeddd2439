"""Query op8_pivotal_mixing: how many words the mix takes of every document."""

from pyspark.sql import functions as F

from mediaspark.llm import mixing
from mediaspark.llm.common import saved
from mediaspark.llm.registry import query, table


@query("op8_pivotal_mixing")
def op8_pivotal_mixing(spark, folder):
    sized = saved(mixing.sized_documents(table(spark, folder, "documents")))
    goals = mixing.targets(sized)
    decided = mixing.copies(sized, goals)
    goal = goals.select(F.col("source").alias("source_"), "source_size", "target")
    return (
        sized.join(decided, "item_")
        .join(F.broadcast(goal), F.col("source").eqNullSafe(F.col("source_")))
        .select(F.col("key_").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "source")
    )
