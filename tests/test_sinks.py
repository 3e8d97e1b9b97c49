from __future__ import annotations

import pytest

from tests.frames import actions, table, tuples
from trailmark.session import build_session
from trailmark.sinks import results, staging
from trailmark.sources.actions import read_table, scan_actions
from trailmark.sources.dimensions import JdbcConnection, JdbcSplit, jdbc_read_options

CONNECTION = JdbcConnection("jdbc:mysql://db/x", "me", "secret", "com.example.Driver")


def test_file_target_appends_and_overwrites(spark, tmp_path):
    target = results.FileTarget(str(tmp_path))
    for mode, rows in [("append", 1), ("append", 2), ("overwrite", 1)]:
        results.write_result(table(spark, "a int", (1,)), target, "t", mode)
        assert spark.read.parquet(f"{tmp_path}/t").count() == rows


def test_catalog_target(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS reports")
    target = results.CatalogTarget("reports")
    results.write_result(table(spark, "a int", (1,)), target, "t", "overwrite")
    assert tuples(read_table(spark, "reports.t")) == [(1,)]
    spark.sql("DROP TABLE reports.t")


def test_jdbc_options_of_reads_and_writes():
    login = {
        "url": "jdbc:mysql://db/x",
        "user": "me",
        "password": "secret",
        "driver": "com.example.Driver",
    }
    assert jdbc_read_options(CONNECTION, "city_info") == login | {
        "dbtable": "city_info",
        "fetchsize": "10000",
    }
    split = JdbcSplit("city_id", 0, 100, 4)
    assert jdbc_read_options(CONNECTION, "city_info", split) == login | {
        "dbtable": "city_info",
        "fetchsize": "10000",
        "partitionColumn": "city_id",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "4",
    }
    assert results.JdbcTarget(CONNECTION).options("t") == login | {
        "dbtable": "t",
        "batchsize": "5000",
        "numPartitions": "10",
    }
    assert "secret" not in repr(CONNECTION)


def test_date_scan_prunes_folders_and_columns(spark, tmp_path):
    log = actions(spark, [{"update_date": f"2020-05-0{n}"} for n in (1, 2, 3)], parse=False)
    results.write_actions(log, str(tmp_path / "log"))
    stored = read_table(spark, str(tmp_path / "log"))
    scan = scan_actions(stored, "2020-05-02", "2020-05-02").select("session_id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(update_date" in plan
    assert "ReadSchema: struct<session_id:string>" in plan
    assert scan.count() == 1


def test_staged_results_live_in_the_shared_folder(spark):
    folder = staging.run_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    kept = staging.staged(table(spark, "a int", (1,), (2,)), folder, "t")
    assert kept.inputFiles()[0].startswith(f"file://{folder}/t") or folder in kept.inputFiles()[0]
    assert tuples(kept) == [(1,), (2,)]
    staging.drop_folder(spark, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/t")


def test_database_writes_move_rows_not_the_scan(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "log"))
    scan = spark.read.parquet(str(tmp_path / "log")).where("id > 3")
    target = results.JdbcTarget(CONNECTION, connections=3)
    spread = target.spread(scan)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "Exchange RoundRobinPartitioning(3)" in plan
    assert plan.index("Exchange") < plan.index("FileScan")
    assert spread.rdd.getNumPartitions() == 3


def test_file_writes_are_few_files(spark, tmp_path):
    results.write_result(spark.range(0, 100, 1, 20), results.FileTarget(str(tmp_path)), "t")
    assert len(list((tmp_path / "t").glob("part-*"))) == 1


def test_session_keeps_what_the_caller_set(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
    again = build_session()
    assert again.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"
    assert again.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    assert again.conf.get("spark.sql.shuffle.partitions") == "8"
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
