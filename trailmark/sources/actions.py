"""Scans of the visit-action log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.functions.times import parse_time

# A bare date is exactly this long in the yyyy-MM-dd format.
_DATE_LENGTH = 10


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or temporary view, or a parquet path if ``name`` holds a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def with_action_time(actions: DataFrame) -> DataFrame:
    """Action times as timestamps; text times are parsed, unreadable ones become null."""
    kind = actions.schema["action_time"].dataType
    if isinstance(kind, T.StringType):
        return actions.withColumn("action_time", parse_time(F.col("action_time")))
    if isinstance(kind, T.TimestampType):
        return actions.withColumn("action_time", F.col("action_time").cast("timestamp_ntz"))
    return actions


def scan_actions(
    actions: DataFrame, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """Actions whose ``update_date`` is in the inclusive range; an absent bound is open.

    The bounds are literals on the bare column, so a table partitioned by
    ``update_date`` is pruned to the days asked for.
    """
    if start_date is not None:
        actions = actions.where(F.col("update_date") >= F.lit(start_date))
    if end_date is not None:
        actions = actions.where(F.col("update_date") <= F.lit(end_date))
    return actions


def within_days(
    actions: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Leaves out text times before the day of ``start`` or after that of ``end``.

    Hours may be unpadded, so times do not compare as text, but their days do. The
    comparison is on the bare column and reaches the files' statistics, which the
    exact bounds on parsed times cannot. Other column types are returned as they are.
    """
    if not isinstance(actions.schema["action_time"].dataType, T.StringType):
        return actions
    text = F.col("action_time")
    first, last = _day(start), _day(end)
    if first is not None:
        actions = actions.where(text >= first.isoformat())
    if last is not None:
        actions = actions.where(text < (last + dt.timedelta(days=1)).isoformat())
    return actions


def _day(bound: str | None) -> dt.date | None:
    """The day of a date or time, None if there is none to prune by."""
    try:
        day = dt.date.fromisoformat((bound or "")[:_DATE_LENGTH])
    except ValueError:
        return None
    return day if day < dt.date.max else None


def scan_clicks(
    actions: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """(city_id, product_id) of product clicks whose time is from ``start`` to ``end``.

    Bounds are dates or times; a bare end date includes that whole day.
    """
    time = F.col("action_time")
    clicks = actions.where(F.col("click_product_id").isNotNull())
    if start is not None:
        clicks = clicks.where(time >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        bound = F.lit(end).cast("timestamp_ntz")
        if len(end) == _DATE_LENGTH:
            clicks = clicks.where(time < bound + F.expr("INTERVAL 1 DAY"))
        else:
            clicks = clicks.where(time <= bound)
    return clicks.select("city_id", F.col("click_product_id").alias("product_id"))
