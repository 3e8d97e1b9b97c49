"""Session rollup, user join, criteria and the visit/step length report."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trailmark.functions.numeric import half_up_ratio
from trailmark.functions.texts import is_not_empty
from trailmark.functions.times import seconds_between
from trailmark.params import JobParams

# Report buckets as (name, lowest, highest), both ends inclusive.
# A visit of 0 seconds is in no bucket.
VISIT_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)
STEP_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

USER_COLUMNS = ("age", "professional", "city", "sex")


def _keyword() -> Column:
    return F.when(is_not_empty(F.col("search_keyword")), F.col("search_keyword"))


def _any_of(column: Column, values: tuple) -> Column:
    """Whether some row of the group holds one of ``values``."""
    hit = column.isin(*values) if values else F.lit(False)
    return F.coalesce(F.bool_or(hit), F.lit(False))


def session_rollup(
    actions: DataFrame, params: JobParams | None = None, lists: bool = False
) -> DataFrame:
    """One row per session: user, first and last time, steps and seconds.

    Keyword and category criteria of ``params`` become two flags inside the same
    aggregation, so the usual path shuffles a few fixed-width values per session.
    ``lists`` adds the distinct keywords and clicked categories as arrays, which a
    session must be able to hold; repeats go before they are gathered.
    """
    params = params or JobParams()
    measures = [
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    ]
    if params.keywords is not None:
        measures.append(_any_of(_keyword(), params.keywords).alias("keyword_hit"))
    if params.category_ids is not None:
        measures.append(
            _any_of(F.col("click_category_id"), params.category_ids).alias("category_hit")
        )
    seconds = seconds_between(F.col("start_time"), F.col("end_time"))
    rollup = (
        actions.groupBy("session_id")
        .agg(*measures)
        .withColumn("visit_length", F.coalesce(seconds, F.lit(0).cast("long")))
    )
    return _with_lists(rollup, actions) if lists else rollup


def _with_lists(rollup: DataFrame, actions: DataFrame) -> DataFrame:
    values = actions.select(
        "session_id", _keyword().alias("search_keyword"), "click_category_id"
    ).distinct()
    gathered = values.groupBy(F.col("session_id").alias("_session")).agg(
        F.collect_set("search_keyword").alias("search_keywords"),
        F.collect_set("click_category_id").alias("click_category_ids"),
    )
    same = rollup["session_id"].eqNullSafe(gathered["_session"])
    return rollup.join(gathered, same).drop("_session")


def join_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Adds the user's attributes; sessions of unknown users drop out."""
    return sessions.join(users.select("user_id", *USER_COLUMNS), "user_id", "inner")


def between_or_absent(column: Column, low: int | None, high: int | None) -> Column | None:
    """A range applies only when both its bounds are given."""
    return None if low is None or high is None else column.between(low, high)


def any_match(column: Column, values: tuple | None, is_array: bool = False) -> Column | None:
    """Whether the value, or one of an array's values, is among ``values``."""
    if values is None:
        return None
    if not values:
        return F.lit(False)
    if is_array:
        wanted = F.array(*(F.lit(value) for value in values))
        return F.coalesce(F.arrays_overlap(column, wanted), F.lit(False))
    return column.isin(*values)


def session_criteria(sessions: DataFrame, params: JobParams) -> list[Column]:
    """The criteria present in ``params``, against flags or lists in ``sessions``."""

    def listed(flag: str, array: str, values: tuple | None) -> Column | None:
        if values is not None and flag in sessions.columns:
            return F.col(flag)
        return any_match(F.col(array), values, is_array=True)

    wanted = [
        between_or_absent(F.col("age"), params.start_age, params.end_age),
        any_match(F.col("professional"), params.professionals),
        any_match(F.col("city"), params.cities),
        None if params.sex is None else F.col("sex") == params.sex,
        listed("keyword_hit", "search_keywords", params.keywords),
        listed("category_hit", "click_category_ids", params.category_ids),
    ]
    return [criterion for criterion in wanted if criterion is not None]


def filter_sessions(sessions: DataFrame, params: JobParams) -> DataFrame:
    criteria = session_criteria(sessions, params)
    return sessions.where(reduce(and_, criteria)) if criteria else sessions


def selected_sessions(
    actions: DataFrame, users: DataFrame, params: JobParams, lists: bool = False
) -> DataFrame:
    """Rollup, user join and criteria: the sessions every session report is about."""
    rollup = session_rollup(actions, params, lists)
    return filter_sessions(join_users(rollup, users), params)


def session_detail(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """All actions of the given sessions."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def _bucket_counts(column: str, prefix: str, buckets: tuple) -> list[Column]:
    return [
        F.expr(
            f"count_if({column} >= {low}{'' if high is None else f' AND {column} <= {high}'})"
            f" AS {prefix}_{name}"
        )
        for name, low, high in buckets
    ]


# More names than this are joined with, not put into the filter that scans are given.
MOST_NAMED = 10_000


def named_sessions(actions: DataFrame, named: DataFrame, most: int) -> DataFrame:
    """All actions of few sessions: ``named`` holds ``most`` session ids at most, such as a
    sample of given size.

    The ids become part of the scan's filter, where an index by session answers it. Beyond
    ``MOST_NAMED`` the rows are joined instead.
    """
    if most > MOST_NAMED:
        return session_detail(actions, named.distinct())
    ids = sorted(row.session_id for row in named.distinct().collect())
    return actions.where(F.col("session_id").isin(ids) if ids else F.lit(False))


def visit_length_histogram(sessions: DataFrame) -> DataFrame:
    counts = _bucket_counts("visit_length", "visit_length", VISIT_BUCKETS)
    return sessions.agg(F.count(F.lit(1)).alias("session_count"), *counts)


def step_length_histogram(sessions: DataFrame) -> DataFrame:
    counts = _bucket_counts("step_length", "step_length", STEP_BUCKETS)
    return sessions.agg(F.count(F.lit(1)).alias("session_count"), *counts)


def _length_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("session_count"),
        *_bucket_counts("visit_length", "visit_length", VISIT_BUCKETS),
        *_bucket_counts("step_length", "step_length", STEP_BUCKETS),
    ]


def _ratios(counts: DataFrame, task_id: int) -> DataFrame:
    names = [name for name in counts.columns if name != "session_count"]
    return counts.select(
        F.lit(task_id).cast("long").alias("task_id"),
        "session_count",
        *(half_up_ratio(name, "session_count").alias(f"{name}_ratio") for name in names),
    )


def session_stat_ratios(sessions: DataFrame, task_id: int = 0) -> DataFrame:
    """The one-row report: share of sessions per bucket, null when there are none."""
    return _ratios(sessions.agg(*_length_counts()), task_id)


def observed_lengths(sessions: DataFrame, observation: Observation) -> DataFrame:
    """``sessions``, whose lengths are counted as they pass to wherever they are written.

    Counts are of the tasks that wrote the rows, each once, as long as no shuffle comes
    between this and the write.
    """
    return sessions.observe(observation, *_length_counts())


def length_ratios(spark: SparkSession, counts: dict[str, int], task_id: int = 0) -> DataFrame:
    """The report of ``session_stat_ratios`` from observed counts."""
    names = [name for name, _ in counts.items()]
    schema = ", ".join(f"{name} long" for name in names)
    return _ratios(spark.createDataFrame([tuple(counts[name] for name in names)], schema), task_id)
