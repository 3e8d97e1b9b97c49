"""Small hand-built input frames."""

from __future__ import annotations

from pyspark.sql import types as T

from trailmark import schemas
from trailmark.sources.actions import with_action_time

_EVENT = T.StructField("event_id", T.LongType(), True)
ACTIONS = T.StructType([_EVENT, *schemas.USER_VISIT_ACTION.fields])


def _rows(schema, records):
    return [tuple(record.get(name) for name in schema.names) for record in records]


def actions(spark, records, parse=True):
    """Actions from partial records; ids count up and the session defaults to ``s``."""
    defaults = {"session_id": "s", "user_id": 1, "update_date": "2020-05-01", "page_id": 1}
    records = [{**defaults, "event_id": i, **record} for i, record in enumerate(records)]
    df = spark.createDataFrame(_rows(ACTIONS, records), ACTIONS)
    return with_action_time(df) if parse else df


def users(spark, records):
    defaults = {"age": 30, "professional": "teacher", "city": "Here", "sex": "female"}
    records = [{**defaults, **record} for record in records]
    return spark.createDataFrame(_rows(schemas.USER_INFO, records), schemas.USER_INFO)


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def tuples(df, *columns):
    """Sorted rows as plain tuples; nulls first."""
    found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda row: tuple((v is not None, v) for v in row))


def clock(seconds, day="2020-05-01"):
    return f"{day} {seconds // 3600}:{seconds // 60 % 60:02}:{seconds % 60:02}"
