"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_TEXT, _LONG, _INT, _DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

USER_VISIT_ACTION = _schema(
    ("update_date", _TEXT),
    ("user_id", _LONG),
    ("session_id", _TEXT),
    ("page_id", _LONG),
    ("action_time", _TEXT),
    ("search_keyword", _TEXT),
    ("click_category_id", _LONG),
    ("click_product_id", _LONG),
    ("order_category_ids", _TEXT),
    ("order_product_ids", _TEXT),
    ("pay_category_ids", _TEXT),
    ("pay_product_ids", _TEXT),
    ("city_id", _LONG),
)

USER_INFO = _schema(
    ("user_id", _LONG),
    ("username", _TEXT),
    ("name", _TEXT),
    ("age", _INT),
    ("professional", _TEXT),
    ("city", _TEXT),
    ("sex", _TEXT),
)

PRODUCT_INFO = _schema(
    ("product_id", _LONG),
    ("product_name", _TEXT),
    ("extend_info", _TEXT),
)

CITY_INFO = _schema(("city_id", _INT), ("city_name", _TEXT), ("area", _TEXT))

TASK = _schema(
    ("task_id", _LONG),
    ("task_name", _TEXT),
    ("create_time", _TEXT),
    ("start_time", _TEXT),
    ("finish_time", _TEXT),
    ("task_type", _TEXT),
    ("task_status", _TEXT),
    ("task_param", _TEXT),
)

CLICK_LOG_LINE = _schema(("value", _TEXT))

AD_CLICK_COUNT = _schema(
    ("day", _TEXT),
    ("user_id", _LONG),
    ("ad_id", _LONG),
    ("click_count", _LONG),
)

AD_BLACKLIST = _schema(("user_id", _LONG), ("since_batch", _LONG))
