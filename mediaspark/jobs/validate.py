"""Check a layer; the exit code is 1 if any check fails."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from mediaspark.jobs.common import arguments, report, session_and_layout
from mediaspark.layout import LakeLayout
from mediaspark.operators.quality import union_all
from mediaspark.plans import layer_checks
from mediaspark.sinks.measures import read_known

LAYERS = ("bronze", "silver", "gold")


def run(spark: SparkSession, layout: LakeLayout, layer: str, expected=layer_checks.BRONZE_EXPECTED) -> DataFrame:
    """Check results of one layer: name, passed, detail.

    Tables that the jobs wrote are judged by their stored measures; others, and those of increments, are read.
    """

    def found(layer_name, tables):
        return {table: read_known(spark, layout, layer_name, table) for table in tables}

    sources = (*layer_checks.BRONZE_EXPECTED, layer_checks.STREAM_TABLE)
    if layer == "bronze":
        results, tables = layer_checks.bronze(spark, found("bronze", sources), expected), tuple(expected)
    elif layer == "silver":
        tables = layer_checks.SILVER_TABLES
        results = layer_checks.silver(spark, found("silver", tables), found("bronze", sources))
    elif layer == "gold":
        tables = layer_checks.GOLD_TABLES
        results = layer_checks.gold(spark, found("gold", tables), found("silver", layer_checks.SILVER_TABLES))
    else:
        raise ValueError(f"no layer named {layer}")
    return union_all([results, layer_checks.commit_marks(spark, layout, layer, tables)])


def main() -> None:
    parser = arguments(__doc__)
    parser.add_argument("layer", choices=LAYERS)
    given = parser.parse_args()
    spark, layout = session_and_layout(f"validate-{given.layer}", given)
    results = run(spark, layout, given.layer).persist()
    report(results)
    failed = results.filter("NOT passed").count()
    spark.stop()
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
