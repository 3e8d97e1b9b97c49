"""Ad clicks per day and user, and the blacklist they feed, over clicks with a batch number.

The stream drops a user's clicks from the batch after the one in which a daily
count of theirs first passes the threshold. Nothing is dropped before that batch,
so it is the first one in which the plain running count passes, and no iteration
over batches is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

THRESHOLD = 100
CLICK_KEYS = ("day", "user_id", "ad_id")


def click_counts(clicks: DataFrame, *extra_keys: str) -> DataFrame:
    """Clicks per day, user and ad (and ``extra_keys``)."""
    return clicks.groupBy(*extra_keys, *CLICK_KEYS).agg(F.count(F.lit(1)).alias("click_count"))


def sum_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*CLICK_KEYS).agg(F.sum("click_count").alias("click_count"))


def over_threshold(counts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    return counts.where(F.col("click_count") > threshold)


def blacklist_of(batch_counts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(user_id, since_batch): users and the batch in which they passed the threshold.

    The window runs over per-batch counts, one row per batch of a day at most.
    """
    so_far = W.partitionBy(*CLICK_KEYS).orderBy("batch").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    running = batch_counts.withColumn("click_count", F.sum("click_count").over(so_far))
    return (
        over_threshold(running, threshold)
        .groupBy("user_id")
        .agg(F.min("batch").alias("since_batch"))
    )


def ad_blacklist(clicks: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    return blacklist_of(click_counts(clicks, "batch"), threshold)


def without_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Rows up to and including the batch in which their user was listed."""
    listed = blacklist.select(F.col("user_id").alias("_listed"), "since_batch")
    dropped = (F.col("user_id") == F.col("_listed")) & (F.col("batch") > F.col("since_batch"))
    return clicks.join(listed, dropped, "left_anti")


def ad_daily_counts(clicks: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Total clicks per day, user and ad that were not dropped by the blacklist.

    Filters the per-batch counts instead of the clicks: a busy user is a few rows.
    """
    per_batch = click_counts(clicks, "batch")
    return sum_counts(without_blacklisted(per_batch, blacklist_of(per_batch, threshold)))
