"""Intermediate tables in the cluster's shared folder: lineage is cut there, and lost executors cost nothing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from mediaspark.session import shared_folder


def new_folder(spark: SparkSession) -> str:
    """A new path in the shared folder, deleted when the driver ends; one of our own only where none is set and all runs on one machine."""
    base = shared_folder(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.gettempdir()
    path = f"{base.rstrip('/')}/mediaspark-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame) -> DataFrame:
    """The same rows, read from a table in the shared folder."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
