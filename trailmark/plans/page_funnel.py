"""Page flow conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trailmark.operators import funnel
from trailmark.params import JobParams
from trailmark.sinks import results
from trailmark.sources.actions import scan_actions, with_action_time


def page_convert_rates(actions: DataFrame, params: JobParams) -> DataFrame:
    flow = params.required_page_flow()
    log = with_action_time(scan_actions(actions, params.start_date, params.end_date))
    return funnel.page_convert_rate(funnel.page_flow_matches(log, flow))


def run(
    actions: DataFrame, params: JobParams, target: results.Target, mode: str = "replace"
) -> None:
    rates = page_convert_rates(actions, params)
    report = funnel.page_convert_text(rates, params.task_id)
    reports = [(results.PAGE_SPLIT_CONVERT_RATE, report)]
    results.write_reports(reports, target, params.task_id, mode)
