"""Reproducible session sample, spread over days and hours by their share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.functions.texts import id_list_text, list_text
from trailmark.functions.times import format_date, format_time, hour_text
from trailmark.operators.ranking import top_per_group
from trailmark.operators.sessions import session_detail, session_rollup

DEFAULT_TOTAL = 100


def _with_hour(sessions: DataFrame) -> DataFrame:
    started = sessions.where(F.col("start_time").isNotNull())
    return started.withColumns(
        {"date": format_date(F.col("start_time")), "hour": hour_text(F.col("start_time"))}
    )


def session_hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per date and hour of their start; sessions without a time are left out."""
    return _with_hour(sessions).groupBy("date", "hour").agg(
        F.count(F.lit(1)).alias("session_count")
    )


def sample_quota(hour_counts: DataFrame, total: int = DEFAULT_TOTAL) -> DataFrame:
    """How many sessions to draw per hour.

    ``total`` is split evenly over the days, a day's part by the hours' shares,
    both rounded down. Works on at most 24 rows per day, hence the one
    unpartitioned window that counts the days.
    """
    in_day = W.partitionBy("date")
    first_of_day = F.row_number().over(in_day.orderBy("hour")) == 1
    counts = hour_counts.select(
        "*",
        F.sum("session_count").over(in_day).alias("day_count"),
        F.when(first_of_day, 1).otherwise(0).alias("_day"),
    )
    counts = counts.withColumn("days", F.sum("_day").over(W.partitionBy())).drop("_day")
    counts = counts.selectExpr("*", f"{int(total)}L div days AS per_day")
    return counts.selectExpr(
        "*", "least(session_count, (session_count * per_day) div day_count) AS quota"
    )


def sample_sessions(
    sessions: DataFrame, total: int = DEFAULT_TOTAL, seed: str = "0"
) -> DataFrame:
    """Draws each hour's quota by a seeded hash of the session id.

    No quota exceeds ``total``, so that literal bounds what leaves the map side.
    """
    started = _with_hour(sessions)
    draw = F.md5(F.concat_ws("|", F.col("session_id"), F.lit(seed)).cast("binary"))
    drawn = top_per_group(
        started.select("session_id", "start_time", "date", "hour", draw.alias("_draw")),
        ["date", "hour"],
        [F.col("_draw"), F.col("session_id")],
        total,
        "_rank",
    )
    quota = sample_quota(session_hour_counts(sessions), total)
    quota = quota.where(F.col("quota") > 0).select("date", "hour", "quota")
    return (
        drawn.join(quota, ["date", "hour"])
        .where(F.col("_rank") <= F.col("quota"))
        .select("session_id", "start_time")
    )


def sample_report(actions: DataFrame, sample: DataFrame, task_id: int = 0) -> DataFrame:
    """The sampled sessions with their keywords and clicked categories as text.

    The lists are built for the sampled sessions only.
    """
    lists = session_rollup(session_detail(actions, sample), lists=True)
    return lists.select(
        F.lit(task_id).cast("long").alias("task_id"),
        "session_id",
        format_time(F.col("start_time")).alias("start_time"),
        list_text(F.col("search_keywords")).alias("search_keywords"),
        id_list_text(F.col("click_category_ids")).alias("click_category_ids"),
    )


def sample_detail(actions: DataFrame, sample: DataFrame) -> DataFrame:
    """All actions of the sampled sessions; the join is broadcast by its measured size."""
    return session_detail(actions, sample)
