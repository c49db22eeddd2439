"""The event topic as a stream: from the broker, or from files of stored messages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from mediaspark import schemas


# Messages of one micro-batch, so that a first or late start is many batches and not one.
MOST_PER_TRIGGER = 5_000_000


def topic_options(
    servers: str, topic: str, *, max_per_trigger: int | None = MOST_PER_TRIGGER, min_partitions: int | None = None, since: datetime | None = None
) -> dict[str, str]:
    """Options of the topic reader. ``since`` starts at the first message of that time or later, in partitions that have one; else at the earliest."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if since is not None:
        if since.tzinfo is None:
            raise ValueError("the start needs a time with a zone")
        options |= {"startingTimestamp": str(int(since.timestamp() * 1000)), "startingOffsetsByTimestampStrategy": "latest"}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, **choices) -> DataFrame:
    """Stream of a topic; needs Spark's Kafka package. ``choices`` are those of ``topic_options``.

    A bounded micro-batch keeps catching up from becoming one huge batch; ``min_partitions`` splits a topic of few
    partitions over more tasks.
    """
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **choices)).load()


def read_message_files(
    spark: SparkSession, folder: str, *, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    """Stream of stored messages with columns value, partition and offset."""
    reader = spark.readStream.schema(schemas.MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(folder)
