"""Labels of the regional product report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Area to level, and the level of every other area.
AREA_LEVELS = {
    "华北": "A级",
    "华东": "A级",
    "华南": "B级",
    "华中": "B级",
    "西北": "C级",
    "西南": "C级",
}
OTHER_AREA_LEVEL = "D级"

# Product status 0 and anything else.
SELF_OPERATED = "自营商品"
THIRD_PARTY = "第三方商品"


def json_field(text: Column, field: str) -> Column:
    """Top-level field of a JSON object as text, null on unreadable JSON."""
    return F.get_json_object(text, f"$.{field}")


def product_status(
    extend_info: Column, own: str = SELF_OPERATED, other: str = THIRD_PARTY
) -> Column:
    status = json_field(extend_info, "product_status").try_cast("int")
    return F.when(status == 0, F.lit(own)).otherwise(F.lit(other))


def area_level(
    area: Column,
    levels: Mapping[str, str] = AREA_LEVELS,
    other: str = OTHER_AREA_LEVEL,
) -> Column:
    by_level: dict[str, list[str]] = {}
    for name, level in levels.items():
        by_level.setdefault(level, []).append(name)
    label = F
    for level, names in by_level.items():
        label = label.when(area.isin(names), F.lit(level))
    return label.otherwise(F.lit(other)) if by_level else F.lit(other)
