"""Session set-up shared by every job."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The zone in which calendar dates are cut, and the short table-format name.
DEFAULT_ZONE = "Asia/Kolkata"
DEFAULT_FORMAT = "parquet"

# Shuffles start wide and AQE merges small partitions, so one setting serves
# small runs and large ones. Skewed sort-merge joins are split by AQE. A join side is
# broadcast at planning only below Spark's own small limit; above it, only once AQE has
# measured the shuffled side and found it below the limit here.
ENGINE_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Stream state on local disk with checkpoints, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


# Needed where tables are kept in the Delta format and its package is on the class path.
DELTA_OPTIONS = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def build_session(
    app_name: str,
    *,
    zone: str = DEFAULT_ZONE,
    shuffle_partitions: int | None = None,
    master: str | None = None,
    options: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) the session; ``options`` win over the defaults above.

    ``shuffle_partitions`` is best set to two or three times the cluster's cores;
    left out, the cluster's own setting stands.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(ENGINE_OPTIONS)
    settings["spark.sql.session.timeZone"] = zone
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(options or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """The cluster's folder for checkpoints and cut lineage, or None where none is set."""
    return spark.conf.get("spark.checkpoint.dir", None)
