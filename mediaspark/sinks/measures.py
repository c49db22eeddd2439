"""Measures of a table taken when it is written: rows, and nulls, least and greatest of each column.

They come from one aggregation over the written files, which costs half of what observing each row of the write does;
distinct values of declared keys are counted exactly from the key columns of these files. Checks then read one row
instead of a table. A table's measures lie at ``measures/<table>`` of its layer and are replaced whenever it is written whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediaspark.layout import LakeLayout, path_exists
from mediaspark.operators.quality import Stored
from mediaspark.sinks.tables import overwrite, write_whole
from mediaspark.sources.tables import read_if_present

# One row a table. Values are kept as text beside the type they are read back in.
SCHEMA = "rows bigint, nulls map<string,bigint>, least map<string,string>, greatest map<string,string>, broken map<string,bigint>, distinct map<string,bigint>"


def measures_path(layout: LakeLayout, layer: str, table: str) -> str:
    return layout.table(layer, f"measures/{table}")


def _ordered(df: DataFrame) -> list[str]:
    """Columns that have a least and a greatest value worth keeping."""
    return [f.name for f in df.schema if f.dataType.typeName() not in ("array", "map", "struct", "binary", "boolean", "variant")]


def overwrite_measured(
    df: DataFrame,
    layout: LakeLayout,
    layer: str,
    table: str,
    partition_by: Sequence[str] = (),
    *,
    conditions: Mapping[str, str] | None = None,
    keys: Sequence[Sequence[str]] = (),
) -> int:
    """Replace the table and its measures; ``conditions`` names SQL conditions whose rows are counted, ``keys`` sets of columns."""
    ordered, conditions = _ordered(df), conditions or {}
    path, spark = layout.table(layer, table), df.sparkSession
    write_whole(df, path, layout.fmt, partition_by)
    reader = spark.read if layout.fmt == "delta" else spark.read.schema(df.schema)  # a partitioned table without rows has no file to tell it
    written = reader.format(layout.fmt).load(path)
    found = written.agg(
        F.count(F.lit(1)).alias("rows"),
        *((F.count(F.lit(1)) - F.count(c)).alias(f"nulls {c}") for c in df.columns),
        *(F.min(c).cast("string").alias(f"least {c}") for c in ordered),
        *(F.max(c).cast("string").alias(f"greatest {c}") for c in ordered),
        *(F.count_if(F.expr(condition)).alias(f"broken {name}") for name, condition in conditions.items()),
    ).first()
    distinct = {}
    if keys:
        counted = written.agg(*(F.count_distinct(F.struct(*key)).alias(",".join(key)) for key in keys)).first()
        distinct = {",".join(key): counted[",".join(key)] for key in keys}

    def of(kind, names):
        return {name: found[f"{kind} {name}"] for name in names}

    row = (found["rows"], of("nulls", df.columns), of("least", ordered), of("greatest", ordered), of("broken", conditions), distinct)
    overwrite(spark.createDataFrame([row], SCHEMA), measures_path(layout, layer, table), layout.fmt)
    return found["rows"]


def read_measures(spark: SparkSession, layout: LakeLayout, layer: str, table: str) -> DataFrame | None:
    """The one row of measures, or None for a table that was written without."""
    path = measures_path(layout, layer, table)
    return spark.read.schema(SCHEMA).format(layout.fmt).load(path) if path_exists(spark, path) else None


def read_known(spark: SparkSession, layout: LakeLayout, layer: str, table: str) -> DataFrame | Stored | None:
    """The table with its stored measures, the table alone where it has none, or None where there is no table."""
    df = read_if_present(spark, layout, layer, table)
    measures = None if df is None else read_measures(spark, layout, layer, table)
    return df if measures is None else Stored(df, measures)
