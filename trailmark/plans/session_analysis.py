"""Session analysis: length report, sample, top categories and their top sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation

from trailmark.operators import categories, sampling, sessions
from trailmark.params import JobParams
from trailmark.sinks import results, staging
from trailmark.sources.actions import scan_actions, with_action_time

Stage = Callable[[DataFrame, str], DataFrame]


def _lazy(df: DataFrame, name: str) -> DataFrame:
    return df


def session_reports(
    actions: DataFrame,
    users: DataFrame,
    params: JobParams,
    total: int = sampling.DEFAULT_TOTAL,
    seed: str = "0",
    stage: Stage = _lazy,
    told: bool = True,
    staged: bool = False,
) -> list[tuple[str, DataFrame]]:
    """(result table, rows) pairs of the whole analysis.

    ``stage`` is applied to what several reports read; ``staged`` says that it writes
    there and then. The lengths are then counted while the sessions pass to their table,
    and the few sessions whose detail is kept are looked up in the log by name, for all
    reports at once. The log itself is read three times: for the rollup, for the counts
    per session and category, and for that lookup. ``told``: see ``detail_record``.
    """
    task = params.task_id
    log = with_action_time(scan_actions(actions, params.start_date, params.end_date))
    chosen = sessions.selected_sessions(log, users, params)
    if staged:
        lengths = Observation("session lengths")
        chosen = stage(sessions.observed_lengths(chosen, lengths), "sessions")
        ratios = sessions.length_ratios(actions.sparkSession, lengths.get, task)
    else:
        chosen = stage(chosen, "sessions")
        ratios = sessions.session_stat_ratios(chosen, task)

    touched = categories.session_category_counts(log)
    touched = stage(sessions.session_detail(touched, chosen), "session_categories")

    sample = stage(sampling.sample_sessions(chosen, total, seed), "sample")
    top_categories = stage(
        categories.category_top(categories.category_counts(touched), task), "top_categories"
    )
    top_sessions = stage(
        categories.category_top_sessions(touched, top_categories, task), "top_sessions"
    )
    if staged:
        named = sample.select("session_id").union(top_sessions.select("session_id"))
        most = total + categories.TOP_CATEGORIES * categories.TOP_SESSIONS
        log = stage(sessions.named_sessions(log, named, most), "named_sessions")
    return [
        (results.SESSION_AGGR_STAT, ratios),
        (results.SESSION_RANDOM_EXTRACT, sampling.sample_report(log, sample, task)),
        (
            results.SESSION_DETAIL,
            categories.detail_record(
                sampling.sample_detail(log, sample), task, "sample", told=told
            ),
        ),
        (results.TOP10_CATEGORY, top_categories),
        (results.TOP10_CATEGORY_SESSION, top_sessions),
        (
            results.SESSION_DETAIL,
            categories.detail_record(
                categories.category_top_session_detail(log, top_sessions),
                task,
                "top_category",
                "top_category_id",
                told,
            ),
        ),
    ]


def run(
    actions: DataFrame,
    users: DataFrame,
    params: JobParams,
    target: results.Target,
    total: int = sampling.DEFAULT_TOTAL,
    seed: str = "0",
    mode: str = "replace",
    told: bool = True,
) -> None:
    """Writes all reports; what they share is kept in the cluster's shared folder meanwhile.

    ``mode``: see ``write_reports``. Both detail reports go to one table.
    """
    spark = actions.sparkSession
    folder = staging.run_folder(spark, "session-analysis")
    try:
        reports = session_reports(
            actions,
            users,
            params,
            total,
            seed,
            stage=lambda df, name: staging.staged(df, folder, name),
            told=told,
            staged=True,
        )
        results.write_reports(reports, target, params.task_id, mode)
    finally:
        staging.drop_folder(spark, folder)
