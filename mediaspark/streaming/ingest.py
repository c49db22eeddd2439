"""Event topic to bronze table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mediaspark import schemas
from mediaspark.layout import LakeLayout
from mediaspark.sinks.tables import overwrite
from mediaspark.sources.tables import with_source

# Source tag, table, checkpoint name and trigger interval.
SOURCE_TAG = "kafka"
TABLE = "viewing_events"
REJECTED = "viewing_events_rejected"
CHECKPOINT = "bronze_viewing_events"
TRIGGER = "30 seconds"

PROGRESS = "ingest"


def parse_viewing_events(raw: DataFrame) -> DataFrame:
    """Messages (value, partition, offset) to event columns; works on streams and tables.

    A message that is no JSON object gives a row of nulls, as the silver step expects.
    """
    data = F.from_json(F.col("value").cast("string"), schemas.VIEWING_EVENT)
    return with_source(
        raw.select(
            data.alias("data"),
            F.col("partition").alias("_kafka_partition"),
            F.col("offset").alias("_kafka_offset"),
        ).select("data.*", "_kafka_partition", "_kafka_offset"),
        SOURCE_TAG,
    )


# Why a message is no event.
NO_VALUE, NO_OBJECT, NO_FIELD = "no value", "no JSON object", "no known field"


def judged(raw: DataFrame) -> DataFrame:
    """Messages with their parsed ``data`` and, for those that are no event, the ``reason``; works on streams and tables.

    A message is rejected if nothing of an event can be read from it. One with a field of the wrong type is an event in
    which that field is null.
    """
    text = F.col("value").cast("string")
    kept = T.StructType([*schemas.VIEWING_EVENT, T.StructField("_broken", T.StringType())])
    data = F.from_json(text, kept, {"columnNameOfCorruptRecord": "_broken"})
    told = raw.select(text.alias("value"), "partition", "offset", data.alias("data"))
    nothing = F.coalesce(*(F.col(f"data.{name}").cast("string") for name in schemas.VIEWING_EVENT.names)).isNull()
    reason = F.when(F.col("value").isNull(), NO_VALUE).when(nothing & (F.col("data._broken").isNotNull() | (F.trim(text) == "")), NO_OBJECT).when(nothing, NO_FIELD)
    return told.withColumn("reason", reason)


def split_batch(batch: DataFrame, batch_id: int, *, layout: LakeLayout) -> None:
    """Write the events of a micro-batch and its rejected messages to their tables, each over what the same batch left there."""
    rows = judged(batch).persist()
    try:
        events = rows.filter(F.col("reason").isNull()).select(
            *(F.col(f"data.{name}").alias(name) for name in schemas.VIEWING_EVENT.names),
            F.col("partition").alias("_kafka_partition"),
            F.col("offset").alias("_kafka_offset"),
        )
        rejected = rows.filter(F.col("reason").isNotNull()).select("partition", "offset", "value", "reason")
        for df, table in ((with_source(events, SOURCE_TAG), TABLE), (with_source(rejected, SOURCE_TAG), REJECTED)):
            overwrite(df, f"{layout.bronze(table)}/batch={batch_id}", layout.fmt)
    finally:
        rows.unpersist()


def start_split_ingest(raw: DataFrame, layout: LakeLayout, *, once: bool = False, trigger: str = TRIGGER) -> StreamingQuery:
    """Events to bronze, rejected messages with offset and reason to a table beside it.

    Both tables are folders of batches; a batch that is run again replaces its own. A new checkpoint starts again with
    batch 0, so it needs empty tables.
    """
    write = partial(split_batch, layout=layout)
    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", layout.checkpoint(CHECKPOINT))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)).start()


def observed(parsed: DataFrame) -> DataFrame:
    """Count rows and rejected messages per micro-batch, under ``observedMetrics``."""
    nothing = F.coalesce(*(F.col(name).cast("string") for name in schemas.VIEWING_EVENT.names)).isNull()
    return parsed.observe(
        PROGRESS, F.count(F.lit(1)).alias("rows"), F.count_if(nothing).alias("rejected")
    )


def start_append(
    df: DataFrame, path: str, checkpoint: str, fmt: str, *, once: bool = False, trigger: str = TRIGGER
) -> StreamingQuery:
    """Append a stream to a table; ``once`` takes all that is there and stops."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return writer.start(path)


def start_ingest(raw: DataFrame, layout: LakeLayout, *, once: bool = False, trigger: str = TRIGGER) -> StreamingQuery:
    return start_append(
        observed(parse_viewing_events(raw)),
        layout.bronze(TABLE),
        layout.checkpoint(CHECKPOINT),
        layout.fmt,
        once=once,
        trigger=trigger,
    )


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for the query; an interrupt stops it after the running micro-batch."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()
