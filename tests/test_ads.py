from __future__ import annotations

import random
from collections import Counter

import pytest

from tests.frames import table, tuples
from trailmark.operators import ads
from trailmark.schemas import CLICK_LOG_LINE
from trailmark.sources.click_log import malformed_lines, parse_click_log, valid_clicks

CLICKS = "event_id long, day string, user_id long, ad_id long, batch long"


def replay(clicks, threshold):
    """Batch after batch with plain dictionaries: (totals, listed since, kept ids)."""
    totals, listed, kept = Counter(), {}, []
    for batch in sorted({click[4] for click in clicks}):
        rows = [c for c in clicks if c[4] == batch and c[2] not in listed]
        kept += [row[0] for row in rows]
        totals.update((day, user, ad) for _, day, user, ad, _ in rows)
        for _, day, user, ad, _ in rows:
            if totals[day, user, ad] > threshold:
                listed.setdefault(user, batch)
    return totals, listed, sorted(kept)


def check(spark, clicks, threshold):
    totals, listed, kept = replay(clicks, threshold)
    df = table(spark, CLICKS, *clicks)
    assert dict(tuples(ads.ad_blacklist(df, threshold))) == listed
    found = ads.without_blacklisted(df, ads.ad_blacklist(df, threshold))
    assert [i for (i,) in tuples(found, "event_id")] == kept
    counts = {row[:3]: row[3] for row in tuples(ads.ad_daily_counts(df, threshold))}
    assert counts == dict(totals)
    return listed


def numbered(*clicks):
    return [(i, *click) for i, click in enumerate(clicks)]


D1, D2 = "2024-01-01", "2024-01-02"


@pytest.mark.parametrize(
    ("clicks", "listed"),
    [
        # reaching the threshold is not enough
        ([(D1, 1, 1, 0)] * 2, {}),
        # passing it inside one batch keeps that batch whole and drops the next day
        ([(D1, 1, 1, 0)] * 5 + [(D2, 1, 2, 1)], {1: 0}),
        # passing it over two batches
        ([(D1, 1, 1, 0)] * 2 + [(D1, 1, 1, 3), (D1, 1, 2, 4)], {1: 3}),
        # two ads at once, another user untouched
        ([(D1, 1, 1, 0), (D1, 1, 2, 0), (D1, 2, 1, 0)] * 3 + [(D1, 2, 1, 1)], {1: 0, 2: 0}),
        # days are counted apart
        ([(D1, 1, 1, 0)] * 2 + [(D2, 1, 1, 1)] * 2, {}),
    ],
)
def test_edges(spark, clicks, listed):
    assert check(spark, numbered(*clicks), 2) == listed


def test_random_clicks_with_one_busy_user(spark):
    rng = random.Random(3)
    clicks = numbered(
        *(
            (rng.choice([D1, D2]), rng.choice([7, rng.randrange(40)]), rng.randrange(2), batch)
            for batch in range(12)
            for _ in range(60)
        )
    )
    assert 7 in check(spark, clicks, 5)


def test_default_threshold_is_more_than_100(spark):
    df = table(spark, CLICKS, *numbered(*[(D1, 1, 1, 0)] * 100, *[(D1, 2, 1, 0)] * 101))
    assert tuples(ads.ad_blacklist(df)) == [(2, 0)]


def test_log_lines(spark):
    lines = [
        "1704067200000 p c 5 9",
        "1704067200000 p c 5",
        "1704067200000 p c 5 9 x",
        "soon p c 5 9",
        "1704067200000 p c five 9",
        "",
        None,
    ]
    parsed = parse_click_log(table(spark, CLICK_LOG_LINE, *((line,) for line in lines)))
    assert tuples(valid_clicks(parsed)) == [("2024-01-01", "p", "c", 5, 9)]
    assert tuples(malformed_lines(parsed)) == sorted(
        [(line,) for line in lines[1:]], key=lambda row: (row[0] is not None, row)
    )
