"""Use, faults and speed of the saved queries, from the steps that agent runs leave behind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds of steps, and the ending of an observation's title.
TOOL_CALL, OBSERVATION, FALLBACK = "tool_call", "observation", "fallback"
RESULT_SUFFIX = " result"


def tool_usage(steps: DataFrame) -> DataFrame:
    """Per tool: calls, results, share of failed results, time taken.

    A result names its tool only in its title.
    """
    tool = F.when(F.col("kind") == OBSERVATION, F.substring_index("title", RESULT_SUFFIX, 1)).otherwise(
        F.col("tool_name")
    )
    answered = F.col("kind") == OBSERVATION
    named = steps.withColumn("tool", tool).filter(F.col("kind").isin(TOOL_CALL, OBSERVATION))
    failed = F.count_if(answered & (F.col("status") == "error"))
    return named.groupBy("tool").agg(
        F.count_if(F.col("kind") == TOOL_CALL).alias("calls"),
        F.count_if(answered).alias("results"),
        F.try_divide(failed, F.count_if(answered)).alias("error_share"),
        F.avg(F.when(answered, F.col("duration_ms"))).alias("avg_ms"),
        F.max(F.when(answered, F.col("duration_ms"))).alias("max_ms"),
    )


def run_summary(steps: DataFrame) -> DataFrame:
    """Per run: steps taken, tool calls, total time, and whether it fell back."""
    return steps.groupBy("run_id").agg(
        F.max("step_index").alias("steps"),
        F.count_if(F.col("kind") == TOOL_CALL).alias("calls"),
        F.sum("duration_ms").alias("total_ms"),
        F.max(F.coalesce((F.col("kind") == FALLBACK) | (F.col("status") == FALLBACK), F.lit(False))).alias("fell_back"),
    )


def run_overview(runs: DataFrame) -> DataFrame:
    """One row over all runs."""
    return runs.agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg("steps").alias("avg_steps"),
        F.avg("calls").alias("avg_calls"),
        F.try_divide(F.count_if(F.col("fell_back")), F.count(F.lit(1))).alias("fallback_share"),
    )
