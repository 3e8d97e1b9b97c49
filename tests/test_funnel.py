from __future__ import annotations

import random

import pytest

from tests.frames import actions, clock, tuples
from trailmark.operators import funnel
from trailmark.operators.ordering import with_previous


def walk(pages, session="s", start=0):
    return [
        {"session_id": session, "page_id": page, "action_time": clock(start + i)}
        for i, page in enumerate(pages)
    ]


def brute_pairs(records):
    """(session, from, to) in time order, written with plain lists."""
    sessions = {}
    for i, record in enumerate(records):
        if record.get("action_time"):
            hms = [int(part) for part in record["action_time"].split(" ")[1].split(":")]
            sessions.setdefault(record.get("session_id", "s"), []).append(
                (hms, i, record["page_id"])
            )
    pairs = []
    for name, steps in sessions.items():
        pages = [page for _, _, page in sorted(steps)]
        pairs += [(name, a, b) for a, b in zip(pages, pages[1:])]
    return sorted(pairs, key=lambda pair: (pair[0] or "", *pair[1:]))


def test_rates_against_the_step_before(spark):
    log = actions(spark, walk([1, 2, 3, 1, 2], "a") + walk([1, 4, 1], "b"))
    matches = funnel.page_flow_matches(log, [1, 2, 3, 4])
    assert tuples(matches) == [(1, 1, 2, 2, 4), (2, 2, 3, 1, 2), (3, 3, 4, 0, 1)]
    rates = funnel.page_convert_rate(matches)
    assert tuples(rates, "step", "page_pair", "convert_rate") == [
        (1, "1_2", 0.5),
        (2, "2_3", 0.5),
        (3, "3_4", 0.0),
    ]
    text = funnel.page_convert_text(rates, 3).first()
    assert tuple(text) == (3, "1_2=0.5|2_3=0.5|3_4=0.0")


def test_zero_denominator_has_no_rate(spark):
    log = actions(spark, walk([1, 5]))
    rates = funnel.page_convert_rate(funnel.page_flow_matches(log, [1, 2, 3]))
    assert tuples(rates, "step", "pv", "convert_rate") == [(1, 0, 0.0), (2, 0, None)]
    assert funnel.page_convert_text(rates).first().convert_rate == "1_2=0.0|2_3="


def test_pair_twice_in_the_flow_counts_per_position(spark):
    log = actions(spark, walk([1, 2, 1, 2]))
    matches = funnel.page_flow_matches(log, [1, 2, 1, 2])
    assert tuples(matches, "step", "pv", "previous_pv") == [(1, 4, 2), (2, 1, 4), (3, 4, 1)]
    text = funnel.page_convert_text(funnel.page_convert_rate(matches)).first()
    assert text.convert_rate == "1_2=4.0|2_1=0.25"


def test_flow_of_one_page_has_no_steps(spark):
    log = actions(spark, walk([1, 2]))
    rates = funnel.page_convert_rate(funnel.page_flow_matches(log, [1]))
    assert rates.count() == 0
    assert funnel.page_convert_text(rates).first().convert_rate == ""
    assert funnel.start_page_pv(log, [1]).first().start_pv == 1


def test_equal_times_follow_event_order_or_page_order(spark):
    records = [{"page_id": page, "action_time": clock(0)} for page in (3, 1, 2)]
    log = actions(spark, records)
    assert tuples(funnel.page_pairs(log), "from_page", "to_page") == [(1, 2), (3, 1)]
    without_id = funnel.page_pairs(log.drop("event_id"))
    assert tuples(without_id, "from_page", "to_page") == [(1, 2), (2, 3)]


def test_untimed_actions_count_as_visits_but_not_as_steps(spark):
    records = walk([1, 2]) + [{"page_id": 1, "action_time": "bad"}, {"page_id": 2}]
    matches = funnel.page_flow_matches(actions(spark, records), [1, 2])
    assert tuples(matches, "pv", "previous_pv") == [(1, 2)]


def test_one_scan_and_one_full_shuffle(spark, tmp_path):
    actions(spark, walk([1, 2, 3])).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    matches = funnel.page_flow_matches(log, [1, 2])
    assert tuples(matches, "pv") == [(1,)]
    matches.collect()
    plan = matches._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    assert "ReusedExchange" in final
    assert "NestedLoop" not in plan


@pytest.mark.parametrize("minutes", [1, 200])
def test_hot_sessions_give_the_same_pairs(spark, minutes):
    """A third of all rows in one session, a third without a session id, equal times."""
    rng = random.Random(5)
    names = ["hot"] * 300 + [None] * 300 + [f"s{i % 40}" for i in range(300)]
    rng.shuffle(names)
    records = [
        {
            "session_id": name,
            "page_id": rng.randrange(4),
            "action_time": clock(rng.randrange(30) * 2 * minutes) if rng.random() > 0.05 else None,
        }
        for name in names
    ]
    log = actions(spark, records).repartition(6)
    pairs = funnel.page_pairs(log)
    assert tuples(pairs, "session_id", "from_page", "to_page") == brute_pairs(records)
    counts = {(a, b): 0 for a in range(4) for b in range(4)}
    for _, a, b in brute_pairs(records):
        counts[a, b] += 1
    matches = funnel.page_flow_matches(log, [0, 1, 2, 3])
    assert tuples(matches, "pv") == sorted([(counts[i, i + 1],) for i in range(3)])
    assert dict(
        ((row.from_page, row.to_page), row.pv)
        for row in funnel.page_pair_counts(pairs).collect()
    ) == {pair: n for pair, n in counts.items() if n}


@pytest.mark.parametrize("hours", [1, 5, 1000])
def test_results_do_not_depend_on_the_pieces(spark, hours):
    records = [{"page_id": i % 7, "action_time": clock(i * 37 % 20_000)} for i in range(300)]
    log = actions(spark, records)
    found = with_previous(log, "session_id", "action_time", ["event_id"], {"p": "page_id"}, hours)
    pairs = found.where("p is not null").selectExpr("session_id", "p", "page_id")
    assert tuples(pairs) == brute_pairs(records)


def test_hot_session_is_spread_over_tasks(spark):
    records = [
        {"session_id": "hot", "page_id": i % 5, "action_time": clock(i * 20)} for i in range(4000)
    ]
    log = actions(spark, records)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = funnel.page_pairs(log).rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 3999
    assert max(sizes) < 2500
