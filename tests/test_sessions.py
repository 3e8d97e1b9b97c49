from __future__ import annotations

import datetime as dt

import pytest

from tests.frames import actions, clock, tuples, users
from trailmark.operators import sessions
from trailmark.params import JobParams


def lasting(seconds):
    name = f"v{seconds}"
    return [
        {"session_id": name, "action_time": clock(0)},
        {"session_id": name, "action_time": clock(seconds)},
    ]


def test_visit_length_edges(spark):
    edges = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    log = actions(spark, [row for edge in edges for row in lasting(edge)])
    found = sessions.visit_length_histogram(sessions.session_rollup(log)).first().asDict()
    assert found == {
        "session_count": 18,
        "visit_length_1s_3s": 2,
        "visit_length_4s_6s": 2,
        "visit_length_7s_9s": 2,
        "visit_length_10s_30s": 2,
        "visit_length_30s_60s": 2,
        "visit_length_1m_3m": 2,
        "visit_length_3m_10m": 2,
        "visit_length_10m_30m": 2,
        "visit_length_30m": 1,
    }


def test_step_length_edges(spark):
    edges = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    log = actions(spark, [{"session_id": f"n{edge}"} for edge in edges for _ in range(edge)])
    found = sessions.step_length_histogram(sessions.session_rollup(log)).first().asDict()
    assert found == {
        "session_count": 11,
        "step_length_1_3": 2,
        "step_length_4_6": 2,
        "step_length_7_9": 2,
        "step_length_10_30": 2,
        "step_length_30_60": 2,
        "step_length_60": 1,
    }


def test_times_of_a_session(spark):
    log = actions(
        spark,
        [
            {"action_time": None},
            {"action_time": ""},
            {"action_time": "bad"},
            {"action_time": "2020-05-01 9:05:07"},
            {"action_time": "2020-05-01 09:06:07"},
            {"session_id": "none", "action_time": "bad"},
        ],
    )
    found = tuples(
        sessions.session_rollup(log), "session_id", "start_time", "visit_length", "step_length"
    )
    assert found == [("none", None, 0, 1), ("s", dt.datetime(2020, 5, 1, 9, 5, 7), 60, 5)]


def test_lists_are_sets_of_whole_values(spark):
    log = actions(
        spark,
        [
            {"click_category_id": 12},
            {"click_category_id": 1},
            {"click_category_id": 12},
            {"search_keyword": "tea pot"},
            {"search_keyword": "tea"},
            {"search_keyword": ""},
        ],
    )
    row = sessions.session_rollup(log, lists=True).first()
    assert sorted(row.click_category_ids) == [1, 12]
    assert sorted(row.search_keywords) == ["tea", "tea pot"]


def test_unknown_users_drop_out(spark):
    log = actions(spark, [{"session_id": "a"}, {"session_id": "b", "user_id": 9}])
    joined = sessions.join_users(sessions.session_rollup(log), users(spark, [{"user_id": 1}]))
    assert tuples(joined, "session_id") == [("a",)]


PEOPLE = [
    {"user_id": 1, "age": 20, "professional": "p1", "city": "c1", "sex": "male"},
    {"user_id": 2, "age": 35, "professional": "p2", "city": "c2", "sex": "female"},
    {"user_id": 3, "age": None, "professional": None, "city": None, "sex": None},
]
VISITS = [
    {"session_id": "a", "user_id": 1, "search_keyword": "tea"},
    {"session_id": "a", "user_id": 1, "click_category_id": 1},
    {"session_id": "b", "user_id": 2, "search_keyword": "tea pot"},
    {"session_id": "b", "user_id": 2, "click_category_id": 12},
    {"session_id": "c", "user_id": 3},
]


@pytest.mark.parametrize(
    ("params", "kept"),
    [
        ({}, "abc"),
        ({"start_age": 20, "end_age": 34}, "a"),
        ({"start_age": 21, "end_age": 35}, "b"),
        ({"start_age": 99}, "abc"),
        ({"end_age": 1}, "abc"),
        ({"professionals": ("p2", "p3")}, "b"),
        ({"professionals": ("p9",)}, ""),
        ({"cities": ("c1", "c2")}, "ab"),
        ({"sex": "male"}, "a"),
        ({"keywords": ("tea",)}, "a"),
        ({"keywords": ("pot", "tea pot")}, "b"),
        ({"keywords": ()}, ""),
        ({"category_ids": (1,)}, "a"),
        ({"category_ids": (2, 12)}, "b"),
        ({"category_ids": ()}, ""),
        ({"sex": "male", "keywords": ("tea",), "category_ids": (1, 5)}, "a"),
        ({"sex": "female", "keywords": ("tea",)}, ""),
    ],
)
@pytest.mark.parametrize("lists", [False, True])
def test_criteria(spark, params, kept, lists):
    """Flags computed in the rollup and comparisons of finished lists agree."""
    log, people, wanted = actions(spark, VISITS), users(spark, PEOPLE), JobParams(**params)
    if lists:
        rollup = sessions.join_users(sessions.session_rollup(log, lists=True), people)
        found = sessions.filter_sessions(rollup, wanted)
    else:
        found = sessions.selected_sessions(log, people, wanted)
    assert tuples(found, "session_id") == [(name,) for name in kept]


def test_detail_keeps_each_action_once(spark):
    log = actions(spark, VISITS)
    kept = sessions.session_rollup(log).where("session_id = 'b'")
    assert tuples(sessions.session_detail(log, kept), "event_id") == [(2,), (3,)]


def test_ratios(spark):
    log = actions(spark, lasting(2) + lasting(5) + lasting(0))
    row = sessions.session_stat_ratios(sessions.session_rollup(log), 4).first()
    assert (row.task_id, row.session_count) == (4, 3)
    assert (row.visit_length_1s_3s_ratio, row.visit_length_4s_6s_ratio) == (0.33, 0.33)
    assert (row.visit_length_30m_ratio, row.step_length_1_3_ratio) == (0.0, 1.0)


def test_ratios_without_sessions_are_null(spark):
    row = sessions.session_stat_ratios(sessions.session_rollup(actions(spark, []))).first()
    assert row.session_count == 0
    assert row.step_length_1_3_ratio is None
