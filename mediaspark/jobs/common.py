"""Arguments and reporting shared by the jobs."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame

from mediaspark.layout import LakeLayout
from mediaspark.plans import layer_checks
from mediaspark.session import DEFAULT_FORMAT, DEFAULT_ZONE, DELTA_OPTIONS, build_session
from mediaspark.sinks.measures import overwrite_measured


def arguments(description: str) -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=description)
    parser.add_argument("--base", required=True, help="lake folder")
    parser.add_argument("--format", default=DEFAULT_FORMAT, help="table format")
    parser.add_argument("--zone", default=DEFAULT_ZONE, help="zone in which dates are cut")
    parser.add_argument("--shuffle-partitions", type=int, default=None)
    return parser


def session_and_layout(name: str, given: argparse.Namespace):
    spark = build_session(
        name,
        zone=given.zone,
        shuffle_partitions=given.shuffle_partitions,
        options=DELTA_OPTIONS if given.format == "delta" else None,
    )
    return spark, LakeLayout(given.base, given.format)


def write_layer(df: DataFrame, layout: LakeLayout, layer: str, table: str, partition_by: Sequence[str] = ()) -> int:
    """Write a table with the measures that the checks of its layer read."""
    extra = (layer, table)
    return overwrite_measured(df, layout, layer, table, partition_by, conditions=layer_checks.CONDITIONS.get(extra), keys=layer_checks.KEYS.get(extra, ()))


def report(rows: DataFrame) -> None:
    rows.show(rows.count(), truncate=False)
