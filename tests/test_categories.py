from __future__ import annotations

from tests.frames import actions, tuples
from trailmark.operators import categories

VISITS = [
    {"session_id": "a", "click_category_id": 1},
    {"session_id": "a", "click_category_id": 1},
    {"session_id": "b", "click_category_id": 12},
    {"session_id": "b", "order_category_ids": "1,2", "pay_category_ids": "12"},
    {"session_id": "c", "order_category_ids": "2,x,, 3", "order_product_ids": "99"},
    {"session_id": "c", "pay_category_ids": "2,2", "pay_product_ids": "98"},
    {"session_id": "c"},
]


def test_counts_by_kind(spark):
    """Payments are read from the pay column, not from ordered products."""
    log = actions(spark, VISITS)
    assert tuples(categories.category_counts(categories.category_touches(log))) == [
        (1, 2, 1, 0),
        (2, 0, 2, 2),
        (3, 0, 1, 0),
        (12, 1, 0, 1),
    ]
    assert tuples(categories.category_click_counts(log)) == [(1, 2), (12, 1)]
    assert tuples(categories.category_order_counts(log)) == [(1, 1), (2, 2), (3, 1)]
    assert tuples(categories.category_pay_counts(log)) == [(2, 2), (12, 1)]
    assert tuples(categories.category_distinct(log)) == [(1,), (2,), (3,), (12,)]


def test_counting_per_session_first_changes_nothing(spark):
    log = actions(spark, VISITS)
    direct = categories.category_counts(categories.category_touches(log))
    staged = categories.category_counts(categories.session_category_counts(log))
    assert tuples(direct) == tuples(staged)


def test_ranking_goes_by_clicks_orders_payments_then_id(spark):
    schema = "category_id long, click_count long, order_count long, pay_count long"
    rows = [(5, 1, 1, 1), (4, 1, 1, 1), (3, 1, 1, 2), (2, 1, 2, 0), (1, 2, 0, 0), (0, 0, 9, 9)]
    counts = spark.createDataFrame(rows, schema)
    ranked = [row.category_id for row in categories.category_ranked(counts).collect()]
    assert ranked == [1, 2, 3, 4, 5, 0]
    top = [row.category_id for row in categories.category_top(counts, 1, 2).collect()]
    assert top == [1, 2]


def test_top_sessions_and_a_session_in_two_lists(spark):
    log = actions(
        spark,
        [
            {"session_id": name, "click_category_id": category}
            for name, category, clicks in [
                ("a", 1, 2),
                ("b", 1, 3),
                ("c", 1, 2),
                ("b", 2, 1),
                ("d", 3, 1),
            ]
            for _ in range(clicks)
        ],
    )
    touched = categories.session_category_counts(log)
    top = categories.category_top(categories.category_counts(touched), 7, 2)
    best = categories.category_top_sessions(touched, top, 7, 2)
    assert tuples(best) == [(7, 1, "a", 2), (7, 1, "b", 3), (7, 2, "b", 1)]

    clicks = categories.session_category_clicks(log)
    assert tuples(categories.category_top_sessions(clicks, top, 7, 2)) == tuples(best)

    detail = categories.category_top_session_detail(log, best)
    record = categories.detail_record(detail, 7, "top_category", "top_category_id")
    per_list = record.groupBy("session_id", "top_category_id").count()
    assert tuples(per_list) == [("a", 1, 2), ("b", 1, 4), ("b", 2, 4)]


def test_detail_record_writes_zero_for_absent_clicks(spark):
    record = categories.detail_record(actions(spark, [{"search_keyword": "tea"}]), 1, "sample")
    row = record.first()
    assert (row.click_category_id, row.click_product_id, row.search_keyword) == (0, 0, "tea")
    assert row.top_category_id is None
