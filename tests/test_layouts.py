"""What the stored layouts of the action log save: row groups, exchanges, reads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.frames import tuples
from trailmark.operators import ordering, sessions
from trailmark.sinks import results
from trailmark.sources.actions import with_action_time
from trailmark.sources.dimensions import quantile_query, split_predicates
from trailmark.verification.views import Views

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def log(spark):
    return Views(spark, FOLDER).actions


def scanned_rows(df):
    """Rows that the scan of ``df`` handed on after leaving out row groups."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().get("numOutputRows").get().value()


def test_lookups_by_session_skip_row_groups(spark, log, tmp_path):
    path = str(tmp_path / "log")
    # Two days, row groups of some hundred rows; sessions overlap in name order.
    whole = log.withColumn("update_date", F.lit("2024-01-01"))
    small = {"parquet.block.size": "4096", "parquet.block.size.row.check.min": "64"}
    small |= {"parquet.page.size.row.check.min": "64", "parquet.page.size.row.check.max": "64"}
    results.write_actions(whole.coalesce(1), path, options=small)
    stored = spark.read.parquet(path)
    ids = [row.session_id for row in log.select("session_id").distinct().orderBy("session_id").limit(400).collect()]
    named = spark.createDataFrame([(ids[3],), (ids[300],)], "session_id string")
    found = sessions.named_sessions(stored, named, 100)
    assert tuples(found.select("page_id", "session_id")) == tuples(
        whole.join(named, "session_id").select("page_id", "session_id")
    )
    assert 0 < scanned_rows(found) < stored.count() / 4
    absent = spark.createDataFrame([(ids[3] + "x",)], "session_id string")
    assert scanned_rows(sessions.named_sessions(stored, absent, 100)) < stored.count() / 4


def test_every_row_group_has_an_index(spark, log, tmp_path):
    import pyarrow.parquet as pq

    results.write_actions(log, str(tmp_path / "log"))
    for file in (tmp_path / "log").rglob("*.parquet"):
        names = pq.read_schema(file).names
        column = pq.read_metadata(file).row_group(0).column(names.index("session_id"))
        assert column.to_dict().get("bloom_filter_offset", 1)
        values = pq.read_table(file, columns=["session_id"], partitioning=None)
        order = [v for v in values.column("session_id").to_pylist() if v is not None]
        assert order == sorted(order)


def test_many_names_are_joined(spark, log):
    named = log.select("session_id").limit(5)
    one, other = (sessions.named_sessions(log, named, most) for most in (5, 10**6))
    assert tuples(one.select("session_id", "page_id")) == tuples(other.select("session_id", "page_id"))
    assert sessions.named_sessions(log, named.limit(0), 5).count() == 0


@pytest.fixture(scope="module", params=[True, False])
def bucketed(request, spark, log):
    name = f"bucketed_{request.param}".lower()
    results.write_bucketed_actions(log, name, 4, by_day=request.param)
    yield spark.table(name)
    spark.sql(f"DROP TABLE {name}")


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("Exchange hashpartitioning")


def test_work_by_session_exchanges_nothing_on_a_bucketed_log(spark, log, bucketed):
    plain, dealt = with_action_time(log), with_action_time(bucketed)
    rollup = sessions.session_rollup(dealt)
    assert exchanges(rollup) == 0 < exchanges(sessions.session_rollup(plain))
    assert tuples(rollup) == tuples(sessions.session_rollup(plain))

    def long_ones(actions):
        chosen = sessions.session_rollup(actions).where("step_length > 3").hint("merge")
        return sessions.session_detail(actions, chosen).select("session_id", "page_id")

    assert exchanges(long_ones(dealt)) == 0 < exchanges(long_ones(plain))
    assert tuples(long_ones(dealt)) == tuples(long_ones(plain))

    def pairs(actions):
        rows = ordering.with_previous(
            actions, "session_id", "action_time", ["page_id"], {"before": "page_id"}
        )
        return rows.select("session_id", "action_time", "page_id", "before")

    assert exchanges(pairs(dealt)) == 0 < exchanges(pairs(plain))
    assert tuples(pairs(dealt)) == tuples(pairs(plain))


@pytest.mark.parametrize("bounds", [[], [5], [5, 5, 5], [1, 4, 4, 9], [-3, 0, 7, 20]])
def test_split_predicates_cover_each_row_once(bounds):
    import sqlite3

    db = sqlite3.connect(":memory:")
    db.execute("CREATE TABLE t (id INTEGER)")
    db.executemany("INSERT INTO t VALUES (?)", [(n,) for n in [*range(-10, 30), None, None]])
    predicates = split_predicates("id", bounds)
    met = [db.execute(f"SELECT rowid FROM t WHERE {p}").fetchall() for p in predicates]
    assert sorted(row for rows in met for row in rows) == [(n,) for n in range(1, 43)]


def test_quantile_bounds_split_skewed_ids_evenly():
    import sqlite3

    db = sqlite3.connect(":memory:")
    db.execute("CREATE TABLE t (id INTEGER)")
    ids = [*range(900), *(10**9 + 1000 * n for n in range(100)), None]
    db.executemany("INSERT INTO t VALUES (?)", [(n,) for n in ids])
    bounds = [row[0] for row in db.execute(quantile_query("t", "id", 10))]
    sizes = [
        db.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0]
        for p in split_predicates("id", bounds)
    ]
    assert sum(sizes) == len(ids) and max(sizes) <= 101 and len(sizes) == 10
