from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from tests.frames import actions, clock, tuples
from trailmark.operators import sampling
from trailmark.operators.sessions import session_rollup


def visits(per_hour):
    return [
        {"session_id": f"{day}-{hour}-{n}", "action_time": clock(hour * 3600 + n, day)}
        for (day, hour), count in per_hour.items()
        for n in range(count)
    ]


COUNTS = {
    ("2020-05-01", 8): 30,
    ("2020-05-01", 9): 10,
    ("2020-05-02", 0): 3,
    ("2020-05-02", 23): 70,
}


def quotas(total):
    days = len({day for day, _ in COUNTS})
    by_day = defaultdict(int)
    for (day, _), count in COUNTS.items():
        by_day[day] += count
    return {
        key: min(count, count * (total // days) // by_day[key[0]])
        for key, count in COUNTS.items()
    }


@pytest.mark.parametrize("total", [0, 1, 7, 100, 2500])
def test_quota_and_sample(spark, total):
    """2,500 is beyond Spark's group limit and takes the salted path."""
    log = actions(spark, visits(COUNTS) + [{"session_id": "untimed"}])
    rollup = session_rollup(log)
    wanted = quotas(total)
    found = sampling.sample_quota(sampling.session_hour_counts(rollup), total)
    assert {
        (row.date, int(row.hour)): row.quota for row in found.collect()
    } == wanted

    names = defaultdict(list)
    for visit in visits(COUNTS):
        day, hour = visit["session_id"].rsplit("-", 2)[:2]
        names[day, int(hour)].append(visit["session_id"])
    expected = {
        name
        for key, quota in wanted.items()
        for name in sorted(
            names[key], key=lambda s: hashlib.md5(f"{s}|0".encode()).hexdigest()
        )[:quota]
    }
    drawn = tuples(sampling.sample_sessions(rollup, total), "session_id")
    assert [name for (name,) in drawn] == sorted(expected)


def test_seed_changes_the_draw_and_repeats_it(spark):
    rollup = session_rollup(actions(spark, visits(COUNTS)))
    draws = [
        tuples(sampling.sample_sessions(rollup, 20, seed), "session_id") for seed in "0101"
    ]
    assert draws[0] == draws[2]
    assert draws[1] == draws[3]
    assert draws[0] != draws[1]


def test_quota_uses_whole_number_arithmetic(spark):
    """29 of 100 sessions of a day's 100 draw 29, not the 28 of truncated floats."""
    counts = {("2020-05-01", 1): 29, ("2020-05-01", 2): 71}
    hours = sampling.session_hour_counts(session_rollup(actions(spark, visits(counts))))
    assert tuples(sampling.sample_quota(hours, 100), "hour", "quota") == [("01", 29), ("02", 71)]


def test_report_has_sorted_lists_and_null_for_none(spark):
    log = actions(
        spark,
        [
            {"action_time": clock(5), "click_category_id": 12},
            {"action_time": clock(6), "click_category_id": 2},
            {"action_time": clock(7), "click_category_id": 12},
        ],
    )
    sample = sampling.sample_sessions(session_rollup(log), 10)
    assert tuples(sampling.sample_report(log, sample, 3)) == [
        (3, "s", "2020-05-01 00:00:05", None, "2,12")
    ]
    assert sampling.sample_detail(log, sample).count() == 3


def test_no_sessions(spark):
    rollup = session_rollup(actions(spark, []))
    assert sampling.sample_sessions(rollup).count() == 0
