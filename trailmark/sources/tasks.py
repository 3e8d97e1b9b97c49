"""Task table: one row per submitted job, parameters as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.params import PARAM_FIELDS, JobParams, ParamError


def task_params(tasks: DataFrame) -> DataFrame:
    """One column per parameter: the first element of its array, null when absent or empty."""
    first = {
        ours: F.nullif(F.get_json_object("task_param", f"$.{theirs}[0]"), F.lit(""))
        for ours, theirs in PARAM_FIELDS.items()
    }
    return tasks.select("task_id", *(value.alias(name) for name, value in first.items()))


def find_task(tasks: DataFrame, task_id: int) -> JobParams:
    """Parameters of one task. The filter reaches the source; at most one row comes back."""
    rows = tasks.where(F.col("task_id") == task_id).select("task_param").limit(1).collect()
    if not rows:
        raise ParamError(f"task {task_id} does not exist")
    return JobParams.from_task_json(rows[0].task_param, task_id)
