"""Most clicked products per area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from trailmark.functions.labels import AREA_LEVELS, OTHER_AREA_LEVEL
from trailmark.operators import regions
from trailmark.params import JobParams
from trailmark.sinks import results
from trailmark.sources.actions import scan_actions, scan_clicks, with_action_time, within_days
from trailmark.sources.dimensions import city_dimension


def area_top_products(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    params: JobParams,
    levels: Mapping[str, str] = AREA_LEVELS,
    other_level: str = OTHER_AREA_LEVEL,
    by_day: bool = False,
) -> DataFrame:
    """``by_day``: each action's ``update_date`` is the day of its time, so a log stored by
    day is read for the days asked for only."""
    start, end = params.start_date, params.end_date
    if by_day:
        actions = scan_actions(actions, start and start[:10], end and end[:10])
    clicks = scan_clicks(with_action_time(within_days(actions, start, end)), start, end)
    counts = regions.area_product_counts(clicks, city_dimension(cities))
    enriched = regions.area_product_enriched(counts, products)
    return regions.area_top_products(
        enriched, params.task_id, levels=levels, other_level=other_level
    )


def run(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    params: JobParams,
    target: results.Target,
    mode: str = "replace",
    by_day: bool = False,
) -> None:
    report = area_top_products(actions, cities, products, params, by_day=by_day)
    reports = [(results.AREA_TOP3_PRODUCT, report)]
    results.write_reports(reports, target, params.task_id, mode)
