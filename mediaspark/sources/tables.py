"""Layer tables by path, and the optional ones among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediaspark.layout import LakeLayout, path_exists


def read_table(spark: SparkSession, layout: LakeLayout, layer: str, name: str) -> DataFrame:
    return spark.read.format(layout.fmt).load(layout.table(layer, name))


def read_if_present(spark: SparkSession, layout: LakeLayout, layer: str, name: str) -> DataFrame | None:
    """The table, or None if its folder is not there; any other fault is raised."""
    if not path_exists(spark, layout.table(layer, name)):
        return None
    return read_table(spark, layout, layer, name)


def with_source(df: DataFrame, tag: str) -> DataFrame:
    """Audit columns of a bronze table."""
    return df.withColumns({"_ingested_at": F.current_timestamp(), "_source": F.lit(tag)})
