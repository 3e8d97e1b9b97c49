"""Page flow: consecutive page pairs and step-over-step conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.numeric import half_up_ratio
from trailmark.functions.texts import pair_label
from trailmark.operators.ordering import with_previous

_TIE_BREAKS = ("event_id", "page_id")


def _with_previous_page(actions: DataFrame) -> DataFrame:
    """Actions with ``from_page``; null for a session's first action and without a time.

    Equal times are ordered by ``event_id``, or by page where the log has no such id.
    """
    tie_break = next(name for name in _TIE_BREAKS if name in actions.columns)
    needed = dict.fromkeys(["session_id", "action_time", tie_break, "page_id"])
    return with_previous(
        actions.select(*needed), "session_id", "action_time", [tie_break], {"from_page": "page_id"}
    )


def page_pairs(actions: DataFrame) -> DataFrame:
    """One row per step from one page to the next within a session, in time order."""
    paged = _with_previous_page(actions).withColumnRenamed("page_id", "to_page")
    return paged.where(F.col("from_page").isNotNull() & F.col("to_page").isNotNull())


def page_pair_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("from_page", "to_page").agg(F.count(F.lit(1)).alias("pv"))


def start_page_pv(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """All visits of the flow's first page, whether or not the session goes on."""
    first = F.col("page_id") == flow[0]
    return actions.agg(F.count_if(first).alias("start_pv"))


def page_flow_matches(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Per step of the flow: how often it was taken, and the count it is measured against.

    A pair that occurs twice in the flow is counted once per position, so its visits
    count double at both. One pass over the actions yields all counts, the first
    page's visits included.
    """
    pairs = [(int(a), int(b)) for a, b in zip(flow, flow[1:])]
    if not pairs:
        return start_page_pv(actions, flow).selectExpr(
            "inline(cast(array() AS array<struct<step: int, from_page: bigint,"
            " to_page: bigint, pv: bigint, previous_pv: bigint>>))"
        )
    visits = [
        f"count_if(from_page = {a} AND page_id = {b}) * {pairs.count((a, b))} AS pv_{i}"
        for i, (a, b) in enumerate(pairs, 1)
    ]
    steps = [
        f"named_struct('step', {i}, 'from_page', {a}L, 'to_page', {b}L,"
        f" 'pv', pv_{i}, 'previous_pv', pv_{i - 1})"
        for i, (a, b) in enumerate(pairs, 1)
    ]
    counts = _with_previous_page(actions).agg(
        F.expr(f"count_if(page_id = {int(flow[0])}) AS pv_0"), *map(F.expr, visits)
    )
    return counts.selectExpr(f"inline(array({', '.join(steps)}))")


def page_convert_rate(matches: DataFrame) -> DataFrame:
    """Rate of each step against the one before; null where that was never taken."""
    return matches.select(
        "step",
        pair_label(F.col("from_page"), F.col("to_page")).alias("page_pair"),
        "pv",
        half_up_ratio("pv", "previous_pv").alias("convert_rate"),
    )


def page_convert_text(rates: DataFrame, task_id: int = 0) -> DataFrame:
    """The rates as one ``a_b=rate|…`` text, in flow order, each pair once.

    A step without a rate leaves its value out.
    """
    rate = F.coalesce(F.col("convert_rate").cast("string"), F.lit(""))
    entries = rates.groupBy("page_pair").agg(
        F.min("step").alias("step"),
        F.max_by(F.concat("page_pair", F.lit("="), rate), "step").alias("entry"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("step", "entry")))
    return entries.agg(ordered.alias("entries")).select(
        F.lit(task_id).cast("long").alias("task_id"),
        F.array_join(F.transform("entries", lambda e: e["entry"]), "|").alias("convert_rate"),
    )
