"""File sources: CSV, JSON arrays, review texts, thumbnails, trace files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediaspark import schemas

# File-name forms.
REVIEW_NAME = r"(USR-[^_/]+)_(CNT-[^_/]+)_(\d{4}-\d{2}-\d{2})\.txt$"
THUMBNAIL_NAME = r"(CNT-[^_/]+)_v(\d+)\.jpg$"
PARAGRAPH_BREAK = r"\r?\n\r?\n"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType, *, lines: bool = False) -> DataFrame:
    """Files that hold one array of objects each, or one object per line with ``lines``.

    A file with one array is read by one task; give large exports as many files or as
    lines, which Spark splits.
    """
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_content_metadata(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CONTENT_METADATA)


def read_viewing_events(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.VIEWING_EVENT, lines=lines)


def read_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One row per review file; author, title and day are in the file name."""
    name = F.col("_metadata.file_name")
    return spark.read.option("pathGlobFilter", "*.txt").text(folder, wholetext=True).select(
        F.nullif(F.regexp_extract(name, REVIEW_NAME, 1), F.lit("")).alias("user_id"),
        F.nullif(F.regexp_extract(name, REVIEW_NAME, 2), F.lit("")).alias("content_id"),
        F.regexp_extract(name, REVIEW_NAME, 3).try_cast("date").alias("review_date"),
        F.split("value", PARAGRAPH_BREAK).alias("paragraphs"),
    )


def read_thumbnails(spark: SparkSession, folder: str) -> DataFrame:
    """One row per image file. The bytes are not selected, so they are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(folder).select(
        F.nullif(F.regexp_extract("path", THUMBNAIL_NAME, 1), F.lit("")).alias("content_id"),
        F.regexp_extract("path", THUMBNAIL_NAME, 2).try_cast("int").alias("version"),
        F.col("length").alias("n_bytes"),
    )


def thumbnail_versions(thumbnails: DataFrame) -> DataFrame:
    return thumbnails.groupBy("content_id").agg(
        F.count(F.lit(1)).alias("versions"), F.sum("n_bytes").alias("n_bytes")
    )


def read_traces(spark: SparkSession, folder: str) -> DataFrame:
    """Steps of agent runs, one JSON array per file; the file name is the run."""
    steps = spark.read.schema(schemas.TRACE_STEP).option("multiLine", True).json(folder)
    return steps.withColumn("run_id", F.col("_metadata.file_name"))
