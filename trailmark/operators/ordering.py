"""Previous row within a group, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows without a time yield no predecessor; they only have to be spread.
_UNTIMED_PIECES = 1024


def with_previous(
    df: DataFrame,
    key: str,
    time: str,
    ties: Sequence[str],
    columns: dict[str, str],
    piece_hours: int = 1,
) -> DataFrame:
    """Adds each row's predecessor values within ``key``; ``columns`` maps output to input.

    Rows are ordered by ``time`` (a timestamp_ntz), then ``ties``, which make the order
    total. A group is cut into pieces of ``piece_hours`` hours, which are dealt out and
    sorted one by one. Only the first and last row of each piece meet again, to give a
    piece's first row its predecessor in the piece before. So a group of any length is
    spread over its hours; results do not depend on ``piece_hours``. Values are null for
    a group's first row and for rows without a time.
    """
    ascending = [F.asc(time), *(F.asc_nulls_last(name) for name in ties)]
    timed = F.col(time).isNotNull()
    hour = F.expr(f"timestampdiff(HOUR, timestamp_ntz'1970-01-01 00:00:00', {time})")
    spread = F.pmod(F.xxhash64(*ties), F.lit(_UNTIMED_PIECES))
    pieces = df.withColumns(
        {
            "_timed": timed,
            "_piece": F.when(timed, F.floor(hour / piece_hours)).otherwise(spread),
        }
    )
    piece = W.partitionBy(key, "_timed", "_piece").orderBy(*ascending)
    within = pieces.select(
        "*",
        *(F.lag(source).over(piece).alias(name) for name, source in columns.items()),
        (F.row_number().over(piece) == 1).alias("_first"),
        F.lead(F.lit(True)).over(piece).isNull().alias("_last"),
    )
    group = W.partitionBy(key).orderBy(*ascending)
    # One predicate that does not come apart: half of it would reach this branch's scan
    # alone, and the branches would no longer share the scan and the shuffle.
    edges = within.where("int(_timed) + int(_first OR _last) = 2").select(
        *df.columns,
        "_first",
        *(F.lag(source).over(group).alias(name) for name, source in columns.items()),
    )
    inside = within.where("NOT _timed OR NOT _first").select(
        *df.columns,
        *(F.when(F.col("_timed"), F.col(name)).alias(name) for name in columns),
    )
    return inside.unionByName(edges.where("_first").drop("_first"))
