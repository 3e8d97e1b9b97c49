from __future__ import annotations

from tests.frames import actions, table, tuples
from trailmark.functions.labels import SELF_OPERATED, THIRD_PARTY
from trailmark.operators import regions
from trailmark.params import JobParams
from trailmark.plans.area_top_products import area_top_products
from trailmark.schemas import CITY_INFO, PRODUCT_INFO
from trailmark.sources.actions import scan_actions, scan_clicks, with_action_time, within_days


def click(city, product, time="2020-05-01 9:00:00"):
    return {"city_id": city, "click_product_id": product, "action_time": time}


def cities(spark):
    return table(
        spark, CITY_INFO, (1, "x", "华北"), (11, "x", "华北"), (2, "y", "华南"), (3, None, "华南")
    )


def products(spark):
    rows = [(n, f"p{n}", f'{{"product_status": {n % 2}}}') for n in range(1, 7)]
    return table(spark, PRODUCT_INFO, *rows)


def test_click_bounds_include_the_whole_end_day(spark):
    times = [
        "2020-04-30 23:59:59",
        "2020-05-01 0:00:00",
        "2020-05-02 23:59:59",
        "2020-05-03 0:00:00",
        None,
    ]
    log = actions(spark, [click(1, n, time) for n, time in enumerate(times)] + [{"city_id": 1}])

    def found(*bounds):
        return [n for (n,) in tuples(scan_clicks(log, *bounds), "product_id")]

    assert found("2020-05-01", "2020-05-02") == [1, 2]
    assert found("2020-05-01", "2020-05-02 23:59:59") == [1, 2]
    assert found("2020-05-01", "2020-05-02 23:59:58") == [1]
    assert found(None, "2020-05-02") == [0, 1, 2]
    assert found("2020-05-02") == [2, 3]
    assert found() == [0, 1, 2, 3, 4]


def test_days_of_text_times_are_compared_in_the_files(spark, tmp_path):
    times = ["2020-04-30 23:59:59", "2020-05-01 0:00:00", "2020-05-02 9:00:00", "bad", None]
    log = actions(spark, [click(1, n, time) for n, time in enumerate(times)], parse=False)
    log.write.parquet(str(tmp_path / "log"))
    kept = within_days(spark.read.parquet(str(tmp_path / "log")), "2020-05-01", "2020-05-02")
    assert tuples(kept, "event_id") == [(1,), (2,)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(action_time,2020-05-01)" in plan

    stored = spark.read.parquet(str(tmp_path / "log"))
    assert tuples(within_days(stored, "2020-05-02", None), "event_id") == [(2,), (3,)]
    assert tuples(within_days(stored, None, "2020-04-30"), "event_id") == [(0,)]
    for bounds in (("2020-05-02", None), ("2020-5-1", "2020-05-02")):
        plan = within_days(stored, *bounds)._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(action_time), " in plan
    assert within_days(log, "2020-5-1", None) is log
    parsed = with_action_time(log)
    assert within_days(parsed, "2020-05-01", "2020-05-02") is parsed


def test_date_scan_has_open_sides(spark):
    log = actions(spark, [{"update_date": f"2020-05-0{n}"} for n in (1, 2, 3)])

    def found(*bounds):
        return [n for (n,) in tuples(scan_actions(log, *bounds), "event_id")]

    assert found("2020-05-02", "2020-05-03") == [1, 2]
    assert found("2020-05-02") == [1, 2]
    assert found(None, "2020-05-02") == [0, 1]
    assert found() == [0, 1, 2]


def test_cities_with_overlapping_names_are_both_listed(spark):
    log = actions(spark, [click(11, 1), click(1, 1), click(1, 1), click(9, 1), click(3, 1)])
    clicks = scan_clicks(log)
    located = cities(spark).selectExpr("bigint(city_id) AS city_id", "city_name", "area")
    assert regions.click_city_join(clicks, located).count() == 4
    assert tuples(regions.area_product_counts(clicks, located)) == [
        ("华北", 1, 3, "11:x,1:x"),
        ("华南", 1, 1, ""),
    ]


def test_top_products_per_area(spark):
    records = [click(1, n) for n in (1, 1, 1, 2, 2, 3, 4, 99, 99, 99, 99)] + [click(2, 5)]
    found = area_top_products(
        actions(spark, records, parse=False),
        cities(spark),
        products(spark),
        JobParams(task_id=8, start_date="2020-05-01", end_date="2020-05-01"),
    )
    assert tuples(found) == [
        (8, "华北", "A级", 1, "1:x", 3, "p1", THIRD_PARTY),
        (8, "华北", "A级", 2, "1:x", 2, "p2", SELF_OPERATED),
        (8, "华北", "A级", 3, "1:x", 1, "p3", THIRD_PARTY),
        (8, "华南", "B级", 5, "2:y", 1, "p5", THIRD_PARTY),
    ]
