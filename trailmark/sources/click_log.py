"""Ad click log: ``epochMillis province city userId adId`` lines, batch or streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions.times import format_date
from trailmark.schemas import CLICK_LOG_LINE

_TOKENS = 5

# Times from 0001-01-02 to 9999-12-30 UTC: days with four-digit years in every zone.
FIRST_MILLIS = -62_135_510_400_000
LAST_MILLIS = 253_402_214_399_999


# Where a line of a message log comes from; names it for good.
OFFSETS = ("topic", "partition", "offset")


def kafka_options(
    servers: str,
    topics: Sequence[str],
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Offsets live in the query's checkpoint, so a restart resumes where it stopped.

    ``max_offsets`` bounds a batch, so the backlog after a stop is worked off in batches of
    a size that fits; ``min_partitions`` splits few large topic partitions over more tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_kafka_lines(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str],
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Streaming ``value`` lines with their ``OFFSETS``; needs Spark's Kafka connector on the
    class path."""
    options = kafka_options(servers, topics, starting_offsets, max_offsets, min_partitions)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"), *OFFSETS)


def read_file_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming ``value`` lines from text files dropped into ``path``."""
    reader = spark.readStream.format("text").schema(CLICK_LOG_LINE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def parse_click_log(lines: DataFrame) -> DataFrame:
    """``lines`` with typed fields and a ``malformed`` flag; the raw line is kept.

    A line is malformed when it has not exactly five tokens, when the time, user or ad
    is no number, or when the time is outside the years 1 to 9999 (as nanoseconds are).
    """
    token = F.split("value", " ")
    parsed = lines.select(
        "*",
        F.size(token).alias("tokens"),
        F.get(token, F.lit(0)).try_cast("long").alias("millis"),
        F.get(token, F.lit(1)).alias("province"),
        F.get(token, F.lit(2)).alias("city"),
        F.get(token, F.lit(3)).try_cast("long").alias("user_id"),
        F.get(token, F.lit(4)).try_cast("long").alias("ad_id"),
    )
    complete = (
        (F.col("tokens") == _TOKENS)
        & F.col("millis").between(FIRST_MILLIS, LAST_MILLIS)
        & F.col("user_id").isNotNull()
        & F.col("ad_id").isNotNull()
    )
    return parsed.withColumn("malformed", ~F.coalesce(complete, F.lit(False))).drop("tokens")


def valid_clicks(parsed: DataFrame, *others: str) -> DataFrame:
    """Clicks with their day in the session's time zone, and the ``others`` columns."""
    # Checked here as well, as filters may be reordered and the conversion can fail.
    in_range = F.col("millis").between(FIRST_MILLIS, LAST_MILLIS)
    time = F.timestamp_millis(F.when(in_range, F.col("millis")))
    return parsed.where(~F.col("malformed")).select(
        format_date(time).alias("day"), "province", "city", "user_id", "ad_id", *others
    )


def malformed_lines(parsed: DataFrame, *others: str) -> DataFrame:
    return parsed.where(F.col("malformed")).select("value", *others)
