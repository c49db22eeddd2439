"""Run all layers in order; a layer whose checks fail stops the run with exit code 1."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from mediaspark.jobs import bronze, gold, models, silver, validate
from mediaspark.jobs.common import arguments, report, session_and_layout
from mediaspark.layout import LakeLayout

# The layers whose checks must pass before the next one is built.
GATED = ("silver", "gold")


class ChecksFailed(Exception):
    """Raised with the failed checks of a layer."""

    def __init__(self, layer: str, failed: list[str]):
        super().__init__(f"{layer}: {'; '.join(failed)}")
        self.layer, self.failed = layer, failed


def require(layer: str, results: DataFrame) -> None:
    """Checks are few, a fixed number per table; their names come to the driver."""
    failed = [row["name"] for row in results.filter("NOT passed").select("name").orderBy("name").collect()]
    if failed:
        raise ChecksFailed(layer, failed)


def run(spark: SparkSession, layout: LakeLayout, sources, as_of=None, als_blocks: int = 10, zone: str | None = None) -> dict[str, DataFrame]:
    """Rows written per table, for each layer."""
    steps = {
        "bronze": lambda: bronze.run(spark, layout, sources),
        "silver": lambda: silver.run(spark, layout, as_of, zone),
        "gold": lambda: gold.run(spark, layout),
        "models": lambda: models.run(spark, layout, as_of, als_blocks),
    }
    written = {}
    for layer, build in steps.items():
        written[layer] = build()
        if layer in GATED:
            require(layer, validate.run(spark, layout, layer))
    return written


def main() -> None:
    parser = arguments(__doc__)
    bronze.add_source_arguments(parser)
    parser.add_argument("--as-of", default=None, help="day that counts as today")
    parser.add_argument("--als-blocks", type=int, default=10)
    given = parser.parse_args()
    spark, layout = session_and_layout("all-layers", given)
    try:
        sources = bronze.given_sources(spark, given)
        for rows in run(spark, layout, sources, given.as_of, given.als_blocks, given.zone).values():
            report(rows)
    except ChecksFailed as failure:
        print(failure, file=sys.stderr)
        sys.exit(1)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
