"""Every registered query against its SQL twin, and the shape of its plan."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from tests.compare import differences
from trailmark.verification import oracle
from trailmark.verification import queries as registered

FOLDER = "/root/testdata/sf0.01"
QUERIES = registered.queries()
ORACLE = oracle.oracle_sql()


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLE.keys() <= contract.oracle_sql().keys()


def test_entry(spark):
    assert contract.entry(spark).first().session_count == 100


def executed_plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def final_plan(df):
    df.collect()
    return executed_plan(df)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_the_twin(spark, name):
    """Equal results from a plan without cross joins, nested loops or Python rows."""
    df = QUERIES[name](spark, FOLDER)
    assert differences(df, FOLDER, ORACLE[name]) == []
    plan = executed_plan(df)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["category_top_sessions", "area_top3", "session_sample"])
def test_ranked_groups_are_cut_before_the_shuffle(spark, name):
    plan = final_plan(QUERIES[name](spark, FOLDER))
    assert re.search(r"Exchange hashpartitioning.*\n[^\n]*WindowGroupLimit.*Partial", plan)


def test_top_categories_need_no_full_sort(spark):
    plan = final_plan(QUERIES["category_top10"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_sample_reads_the_rollup_once(spark):
    plan = final_plan(QUERIES["session_sample"](spark, FOLDER))
    assert "ReusedExchange [session_id" in plan


def test_funnel_is_one_scan(spark):
    plan = final_plan(QUERIES["page_convert_rate"](spark, FOLDER))
    assert plan.count("FileScan") == 1


def test_scans_read_only_the_needed_columns(spark):
    plan = final_plan(QUERIES["session_stat_ratios"](spark, FOLDER))
    scan = re.search(r"FileScan parquet \[ts#\d+,user_id#\d+L\]", plan)
    assert scan is not None
