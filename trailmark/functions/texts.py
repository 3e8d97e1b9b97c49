"""Text helpers: comma lists, id labels and ``key=value|…`` records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def is_not_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def trim_comma(text: Column) -> Column:
    """Drops one comma at either end."""
    return F.regexp_replace(text, "^,|,\\z", "")


def pad_two(text: Column) -> Column:
    """Two-character text unchanged, anything else with a leading zero."""
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def listed_ids(column: str) -> Column:
    """One row per item of a comma text; read the item as a number with LISTED_ID."""
    return F.explode(F.split(column, ","))


# The number in an item called ``id``, null if it is none. Splitting rows first and
# converting after keeps both steps in generated code, which array lambdas leave.
LISTED_ID = "try_cast(trim(id) AS bigint)"


def list_text(items: Column) -> Column:
    """Sorted comma text of an array, null when it is empty."""
    return F.nullif(F.array_join(F.array_sort(items), ","), F.lit(""))


def id_list_text(items: Column) -> Column:
    """Like :func:`list_text`, sorted as numbers."""
    texts = F.transform(F.array_sort(items), lambda item: item.cast("string"))
    return F.nullif(F.array_join(texts, ","), F.lit(""))


def id_name(identifier: Column, name: Column, separator: str = ":") -> Column:
    """``id:name``; null when either part is null, so aggregates skip it."""
    return F.concat(identifier.cast("string"), F.lit(separator), name)


def pair_label(first: Column, second: Column) -> Column:
    return F.concat_ws("_", first.cast("string"), second.cast("string"))


def _quoted(text: str) -> str:
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in text)


def _part_pattern(field: str, value: str, delimiter: str) -> str:
    """A whole part of a record, from the delimiter before it to the one after it."""
    mark = _quoted(delimiter)
    return f"(?:^|{mark}){_quoted(field)}{value}(?={mark}|\\z)"


def record_field(record: Column, field: str, delimiter: str = "|") -> Column:
    """Value of ``field`` in ``a=1|b=2`` text.

    The first well-formed match wins; parts without exactly one key and one
    non-empty value are passed over.
    """
    value = f"=([^={_quoted(delimiter)}]+)=*"
    found = F.regexp_extract(record, _part_pattern(field, value, delimiter), 1)
    return F.nullif(found, F.lit(""))


def with_record_field(record: Column, field: str, value: str, delimiter: str = "|") -> Column:
    """``record`` with the first occurrence of ``field`` set; unchanged if it has none.

    Delimiters at the end are dropped.
    """
    mark = _quoted(delimiter)
    record = F.regexp_replace(record, f"{mark}+\\z", "")
    # The shortest text before a whole part of that name: the first such part.
    part = f"(?s)\\A((?:.*?{mark})??){_quoted(field)}(?:=[^{mark}]*)?(?={mark}|\\z)"
    new = "".join(ch if ch.isalnum() else "\\" + ch for ch in f"{field}={value}")
    return F.regexp_replace(record, part, f"$1{new}")
