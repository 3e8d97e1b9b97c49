"""Session settings the jobs are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Only settings a caller has not chosen already are applied.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Top rows of a group are cut before the shuffle whatever their number.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}

# Read once at start-up. Capturing the Python call site of every column expression
# costs more than building the plan.
STATIC_DEFAULTS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(
    app_name: str = "trailmark",
    master: str | None = None,
    extra: dict[str, str] | None = None,
    hive: bool = False,
) -> SparkSession:
    """Session with :data:`DEFAULTS`; ``master`` is normally left to spark-submit.

    ``hive`` resolves table names in the cluster's Hive metastore.
    """
    builder = SparkSession.builder.appName(app_name)
    if SparkSession.getActiveSession() is None:
        for key, value in STATIC_DEFAULTS.items():
            builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configured = spark.conf.getAll
    for key, value in DEFAULTS.items():
        if key not in configured:
            spark.conf.set(key, value)
    return spark


# Keyed state in files of its own on each executor, with only a batch's changes uploaded;
# empty batches would take batch numbers without anything to count.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for streams with keyed state, next to ``spark`` and its settings.

    ``partitions`` are those of the state, which stay what they were when a stream first
    started; as many as the cluster has cores if not given.
    """
    made = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        made.conf.set(key, spark.conf.get(key))
    for key, value in STREAM_SETTINGS.items():
        made.conf.set(key, value)
    number = partitions or spark.sparkContext.defaultParallelism
    made.conf.set("spark.sql.shuffle.partitions", str(number))
    return made
