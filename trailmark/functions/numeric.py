"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_ratio(num: str, den: str, scale: int = 2) -> Column:
    """Ratio of two count columns, rounded half up to ``scale`` places without float error.

    Null where ``den`` is 0.
    """
    unit = 10**scale
    return F.expr(f"(({2 * unit}L * {num} + {den}) div nullif(2L * {den}, 0L)) / {unit}D")
