"""Upserts by key against a dictionary, with replays, late writers and crashes."""

from __future__ import annotations

import random

import pytest

from tests.frames import table, tuples
from trailmark.operators.ads import CLICK_KEYS
from trailmark.schemas import AD_CLICK_COUNT
from trailmark.sinks.keyed_table import KeyedTable
from trailmark.sinks.results import fence_statement, merge_statement


def keyed(spark, tmp_path, buckets=4):
    return KeyedTable(spark, str(tmp_path), AD_CLICK_COUNT, CLICK_KEYS, "day", buckets)


def read(kept):
    return {row[:3]: row[3] for row in tuples(kept.read())}


def test_batches_replace_rows_by_key(spark, tmp_path):
    rng = random.Random(4)
    kept, expected = keyed(spark, tmp_path), {}
    assert kept.read().count() == 0
    for batch in range(5):
        rows = {
            (f"2024-01-0{rng.randrange(1, 3)}", rng.randrange(6), rng.randrange(2)): rng.randrange(99)
            for _ in range(8)
        }
        expected |= rows
        frame = table(spark, AD_CLICK_COUNT, *(key + (n,) for key, n in rows.items()))
        assert kept.upsert(frame, batch)
        assert not kept.upsert(frame, batch)  # again: changes nothing
        assert read(kept) == expected
    stale = table(spark, AD_CLICK_COUNT, ("2024-01-01", 0, 0, -1))
    assert not kept.upsert(stale, 2)  # a late writer
    assert read(kept) == expected
    assert kept.upsert(table(spark, AD_CLICK_COUNT), 5)  # nothing to change
    assert read(kept) == expected


def test_a_batch_that_died_is_not_seen_and_can_be_repeated(spark, tmp_path, monkeypatch):
    kept = keyed(spark, tmp_path)
    kept.upsert(table(spark, AD_CLICK_COUNT, ("d", 1, 1, 1), ("d", 2, 2, 2)), 0)

    def die(path):
        raise OSError("gone")

    half = table(spark, AD_CLICK_COUNT, ("d", 1, 1, 10), ("e", 3, 3, 3))
    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(kept, "_fs_create", die)
        kept.upsert(half, 1)
    assert read(kept) == {("d", 1, 1): 1, ("d", 2, 2): 2}
    # Its successor holds other rows, as if the batch had been put together anew.
    kept.upsert(table(spark, AD_CLICK_COUNT, ("d", 1, 1, 11), ("d", 4, 4, 4)), 1)
    assert read(kept) == {("d", 1, 1): 11, ("d", 2, 2): 2, ("d", 4, 4): 4}


def test_only_buckets_with_a_changed_key_are_written(spark, tmp_path):
    kept = keyed(spark, tmp_path, buckets=8)
    kept.upsert(table(spark, AD_CLICK_COUNT, *(("d", n, 1, 1) for n in range(100))), 0)
    kept.upsert(table(spark, AD_CLICK_COUNT, ("d", 5, 1, 2)), 1)
    assert len(list(tmp_path.glob("parts/day=d/bucket=*/version=0"))) == 8
    assert len(list(tmp_path.glob("parts/day=d/bucket=*/version=1"))) == 1
    for batch in range(2, 6):
        kept.upsert(table(spark, AD_CLICK_COUNT, ("d", 5, 1, batch)), batch)
    # The version before the last stays for readers that began earlier.
    assert len(list(tmp_path.glob("parts/day=d/bucket=*/version=[1-9]"))) == 2
    assert len(list(tmp_path.glob("commits/batch_id=*"))) <= 2 and not list(tmp_path.glob("staged/batch_id=*"))
    assert read(kept) == {("d", n, 1): 5 if n == 5 else 1 for n in range(100)}


def test_statements_for_a_database():
    given = ("t", "t_staging", ["date", "user_id"], ["date", "user_id", "click_count"])
    assert merge_statement("jdbc:mysql://h/d", *given) == (
        "INSERT INTO t (date, user_id, click_count) SELECT date, user_id, click_count FROM t_staging "
        "ON DUPLICATE KEY UPDATE click_count = VALUES(click_count)"
    )
    assert merge_statement("jdbc:postgresql://h/d", *given) == (
        "INSERT INTO t (date, user_id, click_count) SELECT date, user_id, click_count FROM t_staging "
        "WHERE true ON CONFLICT (date, user_id) DO UPDATE SET click_count = excluded.click_count"
    )
    assert merge_statement("jdbc:oracle:thin:@h", *given) == (
        "MERGE INTO t t USING t_staging s ON (t.date = s.date AND t.user_id = s.user_id) "
        "WHEN MATCHED THEN UPDATE SET click_count = s.click_count "
        "WHEN NOT MATCHED THEN INSERT (date, user_id, click_count) "
        "VALUES (s.date, s.user_id, s.click_count)"
    )
    assert fence_statement("t", 7) == (
        "UPDATE trailmark_batches SET batch_id = 7 WHERE table_name = 't' AND batch_id < 7"
    )


@pytest.mark.parametrize("values", [[], ["click_count"]])
def test_merge_statement_runs(values):
    """The statement as an embedded database of this process has it."""
    import sqlite3

    db = sqlite3.connect(":memory:")
    columns = ["user_id", *values]
    for name in ("t", "t_staging"):
        db.execute(f"CREATE TABLE {name} ({', '.join(columns)}, PRIMARY KEY (user_id))")
    marks = ", ".join("?" * len(columns))
    db.executemany(f"INSERT INTO t VALUES ({marks})", [(1, 5)[: len(columns)], (2, 6)[: len(columns)]])
    db.executemany(
        f"INSERT INTO t_staging VALUES ({marks})", [(2, 60)[: len(columns)], (3, 7)[: len(columns)]]
    )
    statement = merge_statement("jdbc:sqlite:x", "t", "t_staging", ["user_id"], columns)
    for _ in range(2):
        db.execute(statement)
        rows = sorted(db.execute("SELECT * FROM t"))
        assert rows == [row[: len(columns)] for row in ((1, 5), (2, 60), (3, 7))]


def test_buckets_of_a_small_batch_are_written_by_several_tasks(spark, tmp_path):
    rows = [(f"2024-01-0{day}", user, 0, 1) for day in range(1, 6) for user in range(20)]
    kept = keyed(spark, tmp_path)
    assert kept.upsert(table(spark, AD_CLICK_COUNT, *rows), 0)
    files = [path.name for path in tmp_path.rglob("part-*.parquet")]
    assert len(files) == 5 * 4  # one for each day's bucket
    assert len({name[:10] for name in files}) > 1
    assert read(kept) == {row[:3]: 1 for row in rows}
