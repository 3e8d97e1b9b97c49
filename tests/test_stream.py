from __future__ import annotations

import random
from collections import Counter

import pytest

from tests.frames import table, tuples
from tests.test_ads import replay
from trailmark.operators.ads import sum_counts
from trailmark.schemas import AD_CLICK_COUNT
from trailmark.sinks import results
from trailmark.sinks.batch_log import BatchLog
from trailmark.sources.click_log import kafka_options, read_file_lines
from trailmark.session import stream_session
from trailmark.streaming.ad_blacklist import (
    AdBlacklistStream,
    publish_changes,
    publish_totals,
    totals_table,
)

DAY = 86_400_000
START = 1704067200000


def clicks(batches=6, per_batch=40):
    """(id, day, user, ad, batch) and the log line of each."""
    rng = random.Random(11)
    rows = []
    for batch in range(batches):
        for _ in range(per_batch):
            day = min(batch // 2, 1) if rng.random() > 0.1 else 0
            user = rng.choice([1, rng.randrange(12)])
            ad = rng.randrange(2)
            line = f"{START + day * DAY + len(rows)} p c {user} {ad}"
            rows.append(((len(rows), f"2024-01-0{day + 1}", user, ad, batch), line))
    return rows


def batches(rows):
    """The lines of each batch, with a broken one."""
    for batch in sorted({row[4] for row, _ in rows}):
        yield batch, [line for row, line in rows if row[4] == batch] + [f"broken {batch}"]


@pytest.fixture(scope="module")
def session(spark):
    """Where streams run: keyed state in two partitions."""
    return stream_session(spark, 2)


def feed(session, stream, folder, lines):
    """One micro-batch of ``lines``, by a query that starts from what the last one left."""
    incoming = folder / "incoming"
    incoming.mkdir(exist_ok=True)
    (incoming / f"{len(list(incoming.iterdir()))}.txt").write_text("\n".join(lines))
    stream.start(read_file_lines(session, str(incoming)), available_now=True).awaitTermination()


def stored(stream):
    counts = {row[:3]: row[3] for row in tuples(stream.counts.read_all())}
    return counts, dict(tuples(stream.blacklist.read_all()))


@pytest.mark.parametrize("rollup_every, keep_days", [(1, None), (2, 30), (100, 30)])
def test_batches_equal_the_replay_however_they_are_rolled_up(
    spark, session, tmp_path, rollup_every, keep_days
):
    rows = clicks()
    for _, lines in batches(rows):
        # A restarted query has nothing but the files.
        stream = AdBlacklistStream(
            spark, str(tmp_path / "state"), 4, rollup_every, keep_days=keep_days
        )
        feed(session, stream, tmp_path, lines)
    totals, listed, _ = replay([row for row, _ in rows], 4)
    assert listed
    assert stored(stream) == (dict(totals), listed)


def test_a_batch_run_again_changes_nothing(spark, session, tmp_path):
    rows = clicks()
    table_of = totals_table(spark, str(tmp_path / "totals"))
    before = {}
    for batch, lines in batches(rows):
        seen = []

        class Twice(AdBlacklistStream):
            def process(self, totals, batch_id):
                super().process(totals, batch_id)
                seen.append((stored(self), tuples(table_of.read())))
                super().process(totals, batch_id)
                seen.append((stored(self), tuples(table_of.read())))

        stream = Twice(
            spark, str(tmp_path / "state"), 4, rollup_every=2, publish=publish_totals(table_of)
        )
        feed(session, stream, tmp_path, lines)
        assert len(seen) == 2 and seen[0] == seen[1]
        before[batch] = seen[1][0]
    totals, listed, _ = replay([row for row, _ in rows], 4)
    assert before[5] == (dict(totals), listed)
    assert {row[:3]: row[3] for row in tuples(table_of.read())} == dict(totals)


def test_a_batch_that_dies_is_taken_up_again(spark, session, tmp_path):
    rows = clicks(batches=3)

    class Dies(AdBlacklistStream):
        def publish_and_die(self, table_name, rows, batch_id):
            raise OSError("gone")

    for batch, lines in batches(rows):
        stream = Dies(spark, str(tmp_path / "state"), 4)
        stream.publish = stream.publish_and_die
        with pytest.raises(Exception, match="gone"):
            feed(session, stream, tmp_path, lines)
        stream = AdBlacklistStream(spark, str(tmp_path / "state"), 4)
        source = read_file_lines(session, str(tmp_path / "incoming"))
        stream.start(source, available_now=True).awaitTermination()
    totals, listed, _ = replay([row for row, _ in rows], 4)
    assert stored(stream) == (dict(totals), listed)


def test_work_of_a_batch_follows_the_batch_not_the_day(spark, session, tmp_path):
    """A day of 10^6 keys, then a batch of 10 clicks: ten keys are updated and stored, and
    no count that was stored before is read."""
    big = tmp_path / "incoming"
    spark.range(1_000_000).selectExpr(f"concat('{START} p c ', id, ' 1') AS value").write.text(str(big))
    stream = AdBlacklistStream(spark, str(tmp_path / "state"), 4, keep_days=3)
    stream.start(read_file_lines(session, str(big)), available_now=True).awaitTermination()
    assert stream.counts.read_all().count() == 1_000_000

    reads = []
    stream.counts.read_before = lambda *given: reads.append(given)
    (big / "more.txt").write_text("\n".join(f"{START} p c {user} 1" for user in range(10)))
    query = stream.start(read_file_lines(session, str(big)), available_now=True)
    query.awaitTermination()
    state = query.lastProgress["stateOperators"][0]
    assert (state["numRowsTotal"], state["numRowsUpdated"]) == (1_000_000, 10)
    assert reads == []
    changed = spark.read.parquet(f"{stream.counts.root}/batches/batch_id=1")
    assert tuples(changed, "user_id", "click_count") == [(user, 2) for user in range(10)]


def test_state_of_past_days_is_dropped(spark, session, tmp_path):
    stream = AdBlacklistStream(spark, str(tmp_path / "state"), 9, keep_days=2)
    for day in (0, 1, 5, 6, 0, 6):
        feed(session, stream, tmp_path, [f"{START + day * DAY} p c 1 1", f"{START + day * DAY} p c 2 1"])
    counts = {(row[0], row[1]): row[3] for row in tuples(stream.counts.read_all())}
    # The fifth batch is too late for its day and changes nothing.
    assert counts == {
        (f"2024-01-0{day + 1}", user): 1 + (day == 6) for day in (0, 1, 5, 6) for user in (1, 2)
    }
    (tmp_path / "incoming" / "last.txt").write_text(f"{START + 6 * DAY} p c 3 1")
    lines = read_file_lines(session, str(tmp_path / "incoming"))
    query = stream.start(lines, available_now=True)
    query.awaitTermination()
    # Days 5 and 6 of users 1 and 2, day 6 of user 3.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 5


def test_a_click_from_the_future_does_not_end_a_day(spark, session, tmp_path):
    stream = AdBlacklistStream(spark, str(tmp_path / "state"), 9, keep_days=2)
    future = 32503680000000  # the year 3000
    for _ in range(2):
        feed(session, stream, tmp_path, [f"{START} p c 1 1", f"{future} p c 1 1"])
    assert stored(stream)[0] == {("2024-01-01", 1, 1): 2}
    lines = read_file_lines(session, str(tmp_path / "incoming"))
    stream.start_quarantine(lines, available_now=True).awaitTermination()
    kept = spark.read.parquet(stream.quarantine)
    assert tuples(kept) == [(f"{future} p c 1 1",)] * 2


def test_redelivered_lines_count_once(spark, session, tmp_path):
    """Lines that carry where they come from, delivered twice in a batch and in a later one."""
    schema = "value string, topic string, partition int, offset long"
    incoming = str(tmp_path / "incoming")
    stream = AdBlacklistStream(spark, str(tmp_path / "state"), 9, keep_days=2)
    rows = [(f"{START} p c 1 1", "t", 0, 5), (f"{START} p c 1 1", "t", 1, 5), ("bad", "t", 1, 6)]
    for delivered in (rows, rows + rows[:1], [(f"{START} p c 1 1", "t", 0, 7)] * 2):
        spark.createDataFrame(delivered, schema).coalesce(1).write.mode("append").json(incoming)
        lines = session.readStream.schema(schema).json(incoming)
        stream.start(lines, available_now=True).awaitTermination()
    assert stored(stream)[0] == {("2024-01-01", 1, 1): 3}
    stream.start_quarantine(lines, available_now=True).awaitTermination()
    kept = spark.read.parquet(stream.quarantine)
    assert tuples(kept, "value", "partition", "offset") == [("bad", 1, 6)] * 2


def test_batch_reads_only_the_days_it_needs(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path), AD_CLICK_COUNT, sum_counts, "day", rollup_every=2)
    for batch, day in enumerate(["a", "b", "a", "b", "a"]):
        log.roll_up(batch)
        log.write(batch, table(spark, AD_CLICK_COUNT, (day, 1, 1, 1), ("z", 2, 2, 1)))
    found = Counter()
    for row in log.read_before(5, ["a"]).collect():
        found[row.day, row.user_id] += row.click_count
    assert found == {("a", 1): 3}
    paths = {path.split("/")[-2] for path in log.read_before(5, ["a"]).inputFiles()}
    assert paths == {"upto=4", "batch_id=4"}
    assert tuples(log.read_all()) == [("a", 1, 1, 3), ("b", 1, 1, 2), ("z", 2, 2, 5)]


def test_unfinished_rollup_is_ignored(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path), AD_CLICK_COUNT, sum_counts, "day", rollup_every=2)
    for batch in range(3):
        log.write(batch, table(spark, AD_CLICK_COUNT, ("a", 1, 1, 1)))
    # A rollup without its marker, as left by a crash.
    half = table(spark, AD_CLICK_COUNT, ("a", 9, 9, 9)).drop("day")
    half.write.parquet(f"{tmp_path}/rollups/day=a/upto=2")
    assert tuples(log.read_all()) == [("a", 1, 1, 3)]
    log.roll_up(2)
    assert tuples(log.read_all()) == [("a", 1, 1, 3)]


def test_a_new_log_is_empty(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "none"), AD_CLICK_COUNT, sum_counts, "day")
    assert log.read_all().count() == 0
    assert log.read_before(0, []).count() == 0


def test_kafka_options():
    assert kafka_options("a:1,b:1", ["x", "y"]) == {
        "kafka.bootstrap.servers": "a:1,b:1",
        "subscribe": "x,y",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }


def test_kafka_batches_are_bounded():
    options = kafka_options("a:1", ["x"], max_offsets=1000, min_partitions=64)
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("1000", "64")


def test_busy_user_is_one_row_per_key_before_the_blacklist_join(spark, session, tmp_path):
    stream = AdBlacklistStream(spark, str(tmp_path / "state"), 4)
    feed(session, stream, tmp_path, [f"{START} p c 1 1"] * 5000)
    assert spark.read.parquet(f"{tmp_path}/state/counts/batches/batch_id=0").count() == 1
    assert stored(stream) == ({("2024-01-01", 1, 1): 5000}, {1: 0})


@pytest.mark.parametrize("time", ["1704067200000000000", "1704067200000000", "-1", str(2**63 - 1)])
def test_a_time_out_of_range_goes_to_quarantine(spark, session, tmp_path, time):
    stream = AdBlacklistStream(spark, str(tmp_path / "state"), 4)
    feed(session, stream, tmp_path, [f"{START} p c 1 1", f"{time} p c 1 2"])
    lines = read_file_lines(session, str(tmp_path / "incoming"))
    stream.start_quarantine(lines, available_now=True).awaitTermination()
    if time == "-1":  # the last millisecond of 1969
        assert ("1969-12-31", 1, 2) in stored(stream)[0]
    else:
        assert stored(stream)[0] == {("2024-01-01", 1, 1): 1}
        assert tuples(spark.read.parquet(stream.quarantine)) == [(f"{time} p c 1 2",)]


def test_folders_stay_level(spark, session, tmp_path):
    stream = AdBlacklistStream(spark, str(tmp_path / "state"), 4, rollup_every=2)
    sizes = []
    for batch in range(9):
        feed(session, stream, tmp_path, [f"{START + batch} p c {batch % 3} 1"])
        kept = [p for p in tmp_path.glob("state/*/*/*=*") if p.parts[-3] in ("counts", "blacklist")]
        sizes.append(sum(not path.name.startswith(".") for path in kept))
    assert sizes[7:] == sizes[5:7]  # every second batch rolls up
    assert stored(stream)[0] == {("2024-01-01", user, 1): 3 for user in range(3)}


def test_changes_go_out_and_users_come_in(spark, session, tmp_path):
    target = results.FileTarget(str(tmp_path / "out"))
    stream = AdBlacklistStream(
        spark,
        str(tmp_path / "state"),
        1,
        publish=publish_changes(target),
        listed_elsewhere=lambda: table(spark, "user_id long", (9,)),
    )
    for _ in range(2):
        feed(session, stream, tmp_path, [f"{START} p c {user} 1" for user in (1, 9)])
    counts = spark.read.parquet(str(tmp_path / "out" / "ad_user_click_count_changes"))
    columns = ["date", "user_id", "click_count", "batch_id"]
    assert tuples(counts, *columns) == [("2024-01-01", 1, 1, 0), ("2024-01-01", 1, 2, 1)]
    listed = spark.read.parquet(str(tmp_path / "out" / "ad_blacklist_changes"))
    assert tuples(listed, "user_id", "batch_id") == [(1, 1)]
