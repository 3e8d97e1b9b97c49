"""Category counts, the top categories and the sessions most active in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.texts import LISTED_ID, listed_ids
from trailmark.functions.times import format_time
from trailmark.operators.ranking import top_per_group

TOP_CATEGORIES = 10
TOP_SESSIONS = 10

_COUNTS = ("click_count", "order_count", "pay_count")


def category_touches(actions: DataFrame) -> DataFrame:
    """One row per category clicked, ordered or paid for by an action, marked by kind."""
    by_kind = actions.selectExpr(
        "session_id",
        """stack(3,
            'click', string(click_category_id),
            'order', order_category_ids,
            'pay', pay_category_ids) AS (kind, ids)""",
    ).where("ids IS NOT NULL")
    touches = by_kind.select("session_id", "kind", listed_ids("ids").alias("id"))
    return touches.selectExpr(
        "session_id",
        f"{LISTED_ID} AS category_id",
        "if(kind = 'click', 1L, 0L) AS click_count",
        "if(kind = 'order', 1L, 0L) AS order_count",
        "if(kind = 'pay', 1L, 0L) AS pay_count",
    ).where("category_id IS NOT NULL")


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in _COUNTS]


def category_counts(touches: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category, in one aggregation."""
    return touches.groupBy("category_id").agg(*_sums())


def session_category_counts(actions: DataFrame) -> DataFrame:
    """The same per session and category: small even for a session of any length."""
    return category_touches(actions).groupBy("session_id", "category_id").agg(*_sums())


def category_distinct(actions: DataFrame) -> DataFrame:
    return category_touches(actions).select("category_id").distinct()


def category_click_counts(actions: DataFrame) -> DataFrame:
    clicks = actions.where(F.col("click_category_id").isNotNull())
    return clicks.groupBy(F.col("click_category_id").alias("category_id")).agg(
        F.count(F.lit(1)).alias("click_count")
    )


def _listed_counts(actions: DataFrame, column: str, count: str) -> DataFrame:
    listed = actions.select(listed_ids(column).alias("id"))
    listed = listed.selectExpr(f"{LISTED_ID} AS category_id").where("category_id IS NOT NULL")
    return listed.groupBy("category_id").agg(F.count(F.lit(1)).alias(count))


def category_order_counts(actions: DataFrame) -> DataFrame:
    return _listed_counts(actions, "order_category_ids", "order_count")


def category_pay_counts(actions: DataFrame) -> DataFrame:
    return _listed_counts(actions, "pay_category_ids", "pay_count")


def _by_counts() -> list[Column]:
    return [F.desc(name) for name in _COUNTS] + [F.asc("category_id")]


def category_ranked(counts: DataFrame) -> DataFrame:
    """Sorted by clicks, then orders, then payments; equal categories by id."""
    return counts.orderBy(*_by_counts())


def category_top(counts: DataFrame, task_id: int = 0, limit: int = TOP_CATEGORIES) -> DataFrame:
    top = category_ranked(counts).limit(limit)
    return top.select(F.lit(task_id).cast("long").alias("task_id"), "category_id", *_COUNTS)


def session_category_clicks(actions: DataFrame) -> DataFrame:
    clicks = actions.where(F.col("click_category_id").isNotNull())
    return clicks.groupBy("session_id", F.col("click_category_id").alias("category_id")).agg(
        F.count(F.lit(1)).alias("click_count")
    )


def category_top_sessions(
    session_clicks: DataFrame,
    top_categories: DataFrame,
    task_id: int = 0,
    limit: int = TOP_SESSIONS,
) -> DataFrame:
    """The sessions with most clicks in each top category; ties by session id.

    Both joins with top rows are broadcast by their measured size.
    """
    wanted = top_categories.select("category_id")
    clicks = session_clicks.where(F.col("click_count") > 0).select(
        "category_id", "session_id", "click_count"
    )
    top = top_per_group(
        clicks.join(wanted, "category_id"),
        ["category_id"],
        [F.desc("click_count"), F.asc("session_id")],
        limit,
    )
    return top.select(
        F.lit(task_id).cast("long").alias("task_id"),
        "category_id",
        "session_id",
        "click_count",
    )


def category_top_session_detail(actions: DataFrame, top_sessions: DataFrame) -> DataFrame:
    """Actions of the top sessions, once per category whose list a session is in."""
    listed = top_sessions.select("session_id", F.col("category_id").alias("top_category_id"))
    return actions.join(listed, "session_id")


def detail_record(
    detail: DataFrame,
    task_id: int,
    source: str,
    category: str | None = None,
    told: bool = True,
) -> DataFrame:
    """Actions in the shape of the session detail table; absent click ids become 0.

    ``source`` tells which report a row belongs to, ``category`` names the column
    holding the top category it was listed for. Without ``told`` these two columns are
    left out, for tables that hold the task and the eleven columns of an action.
    """
    zero = F.lit(0).cast("long")
    listed_for = F.col(category) if category else F.lit(None).cast("long")
    record = detail.select(
        F.lit(task_id).cast("long").alias("task_id"),
        "user_id",
        "session_id",
        "page_id",
        format_time(F.col("action_time")).alias("action_time"),
        "search_keyword",
        F.coalesce("click_category_id", zero).alias("click_category_id"),
        F.coalesce("click_product_id", zero).alias("click_product_id"),
        "order_category_ids",
        "order_product_ids",
        "pay_category_ids",
        "pay_product_ids",
        F.lit(source).alias("source"),
        listed_for.alias("top_category_id"),
    )
    return record if told else record.drop("source", "top_category_id")
