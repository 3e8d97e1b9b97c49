"""Streaming ad click counts with a blacklist that feeds back into the stream.

Counts are keyed state of Spark's own aggregation: a batch looks up and updates the keys it
holds, whatever the day has gathered before. The state counts all clicks, also of users who
are blacklisted by then. That is enough: nothing of a user is dropped up to the batch that
lists them, so a total is what was kept as long as the user is not listed, and totals that
change later are not taken any more. The feedback therefore needs no state of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trailmark.functions.times import DATE_TEXT
from trailmark.operators.ads import CLICK_KEYS, THRESHOLD, click_counts, over_threshold
from trailmark.schemas import AD_BLACKLIST, AD_CLICK_COUNT
from trailmark.sinks import results
from trailmark.sinks.batch_log import BatchLog
from trailmark.sinks.keyed_table import KeyedTable
from trailmark.sources.click_log import OFFSETS, malformed_lines, parse_click_log, valid_clicks

BATCH_INTERVAL = "5 seconds"

# A batch's changed rows go out as (result table, rows, batch number).
Publish = Callable[[str, DataFrame, int], None]


def publish_changes(target: results.Target) -> Publish:
    """Appends a batch's changed totals and new users to ``TABLE_changes``.

    Rows carry their ``batch_id``, as a replayed batch appends them again: of the rows of
    a key, one with the highest batch number holds.
    """

    def publish(table: str, rows: DataFrame, batch_id: int) -> None:
        numbered = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
        results.write_result(numbered, target, f"{table}_changes")

    return publish


def publish_totals(counts: KeyedTable) -> Publish:
    """Keeps the table of counts current: totals of the changed keys replace earlier ones."""

    def publish(table: str, rows: DataFrame, batch_id: int) -> None:
        if table == results.AD_USER_CLICK_COUNT:
            counts.upsert(rows.withColumnRenamed("date", "day"), batch_id)

    return publish


def publish_to_database(target: results.JdbcTarget) -> Publish:
    """Keeps database tables current: one merge per batch, fenced by its number."""
    keys = {
        results.AD_USER_CLICK_COUNT: ("date", "user_id", "ad_id"),
        results.AD_BLACKLIST: ("user_id",),
    }

    def publish(table: str, rows: DataFrame, batch_id: int) -> None:
        target.upsert(rows, table, keys[table], batch_id)

    return publish


def totals_table(spark: SparkSession, root: str) -> KeyedTable:
    """The counts by day, user and ad as a table that batches update in place."""
    return KeyedTable(spark, root, AD_CLICK_COUNT, CLICK_KEYS, "day")


def _last_totals(rows: DataFrame) -> DataFrame:
    """Totals only grow, so the largest of a key is its last."""
    return rows.groupBy(*CLICK_KEYS).agg(F.max("click_count").alias("click_count"))


def _first_listing(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id").agg(F.min("since_batch").alias("since_batch"))


class AdBlacklistStream:
    """State and step of the stream; everything it keeps lies below ``root``.

    The checkpoint is kept there too: batch numbers and stored batches belong together.
    ``publish`` is given each batch's changed totals and new users. ``listed_elsewhere``
    is asked in every batch for users (user_id) whom someone else has blacklisted; one that
    it has named stays listed.

    With ``keep_days`` the state of a day is dropped once clicks are that many days newer;
    clicks that come later than that are not counted any more, and clicks dated more than a
    day ahead are quarantined, so that a wrong clock cannot end the days of the others.
    Without it every key is kept and no click is late.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        threshold: int = THRESHOLD,
        rollup_every: int = 100,
        publish: Publish | None = None,
        listed_elsewhere: Callable[[], DataFrame] | None = None,
        keep_days: int | None = None,
    ):
        root = root.rstrip("/")
        self.publish = publish
        self.listed_elsewhere = listed_elsewhere
        self.threshold = threshold
        self.keep_days = keep_days
        self.checkpoint = f"{root}/checkpoint"
        self.quarantine = f"{root}/quarantine"
        self.counts = BatchLog(
            spark, f"{root}/counts", AD_CLICK_COUNT, _last_totals, "day", rollup_every
        )
        self.blacklist = BatchLog(
            spark,
            f"{root}/blacklist",
            AD_BLACKLIST,
            _first_listing,
            rollup_every=rollup_every,
        )

    def _parsed(self, lines: DataFrame) -> DataFrame:
        parsed = parse_click_log(lines)
        if self.keep_days is None:
            return parsed
        ahead = F.unix_millis(F.current_timestamp()) + F.lit(86_400_000)
        early = F.coalesce(F.col("millis") > ahead, F.lit(False))
        return parsed.withColumn("malformed", F.col("malformed") | early)

    def totals(self, lines: DataFrame) -> DataFrame:
        """Streaming (day, user_id, ad_id, click_count) of the keys that change in a batch.

        Lines that carry where they come from (topic, partition, offset) count once.
        """
        parsed = self._parsed(lines)
        if self.keep_days is None:
            return click_counts(valid_clicks(parsed))
        start = F.to_timestamp("day", DATE_TEXT).alias("day_start")
        clicks = valid_clicks(parsed, *(name for name in OFFSETS if name in lines.columns))
        clicks = clicks.select("*", start).withWatermark("day_start", f"{self.keep_days} days")
        if set(OFFSETS) <= set(lines.columns):
            clicks = clicks.dropDuplicatesWithinWatermark(list(OFFSETS))
        return click_counts(clicks, "day_start").drop("day_start")

    def process(self, totals: DataFrame, batch_id: int) -> None:
        """Takes over a batch's changed totals. Reads only what earlier batches stored, so
        it can be repeated; what it reads are users, not counts."""
        self.counts.roll_up(batch_id)
        self.blacklist.roll_up(batch_id)

        listed = self.blacklist.read_before(batch_id).select("user_id")
        kept = totals.join(listed, "user_id", "left_anti")
        elsewhere = None
        if self.listed_elsewhere is not None:
            elsewhere = self.listed_elsewhere().select("user_id").distinct()
            kept = kept.join(elsewhere, "user_id", "left_anti")
        stored = self.counts.write(batch_id, kept)

        offenders = over_threshold(stored, self.threshold).select("user_id").distinct()
        new = offenders
        if elsewhere is not None:
            new = new.union(elsewhere.join(listed, "user_id", "left_anti")).distinct()
        self.blacklist.write(batch_id, new.withColumn("since_batch", F.lit(batch_id).cast("long")))
        if self.publish is not None:
            changed = stored.withColumnRenamed("day", "date")
            self.publish(results.AD_USER_CLICK_COUNT, changed, batch_id)
            self.publish(results.AD_BLACKLIST, offenders, batch_id)

    def start(self, lines: DataFrame, available_now: bool = False) -> StreamingQuery:
        """Starts the counts on a streaming frame of ``value`` lines. The state store is
        that of the frame's session, see ``session.stream_session``."""
        writer = (
            self.totals(lines)
            .writeStream.queryName("ad_blacklist")
            .outputMode("update")
            .option("checkpointLocation", self.checkpoint)
            .foreachBatch(self.process)
        )
        return _triggered(writer, available_now)

    def start_quarantine(self, lines: DataFrame, available_now: bool = False) -> StreamingQuery:
        """Starts a query of its own that keeps malformed lines, with where they come from."""
        writer = (
            malformed_lines(self._parsed(lines), *(n for n in OFFSETS if n in lines.columns))
            .writeStream.queryName("ad_quarantine")
            .format("parquet")
            .option("path", self.quarantine)
            .option("checkpointLocation", f"{self.checkpoint}-quarantine")
        )
        return _triggered(writer, available_now)

    def export(self, target: results.Target) -> None:
        """Writes the current totals and blacklist as plain result tables."""
        counts = self.counts.read_all().withColumnRenamed("day", "date")
        results.write_result(counts, target, results.AD_USER_CLICK_COUNT, "overwrite")
        listed = self.blacklist.read_all().select("user_id")
        results.write_result(listed, target, results.AD_BLACKLIST, "overwrite")


def _triggered(writer, available_now: bool) -> StreamingQuery:
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=BATCH_INTERVAL).start()
