"""Time parsing and formatting on columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the log and of the result tables. One H also
# reads a zero-padded hour.
TIME_INPUT = "yyyy-MM-dd H:mm:ss"
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"
DATE_TEXT = "yyyy-MM-dd"
DATE_KEY = "yyyyMMdd"
MINUTE_KEY = "yyyyMMddHHmm"
DATE_HOUR = "yyyy-MM-dd_HH"
HOUR = "HH"


# The fields of a time as they may be written: any number of digits a count can have, blanks
# before them, anything after the seconds.
_FIELDS = r"^\s*(\d{1,9})-\s*(\d{1,9})-\s*(\d{1,9}) \s*(\d{1,9}):\s*(\d{1,9}):\s*(\d{1,9})"
_FIRST_SECOND, _LAST_SECOND = -62_135_596_800, 253_402_300_799  # of the years 1 to 9999


# A time as it should be written. Spark's own parser sees nothing else, as a text it cannot
# read costs it an exception.
_EXACT = (
    r"^(?!0000)\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01]) 0*(1?\d|2[0-3]):[0-5]\d:[0-5]\d\z"
)


def parse_time(text: Column) -> Column:
    """Wall-clock timestamp, null for text that is no time.

    Lenient: fields need no padding, and what is too much for one rolls over into the next
    larger one, so ``2024-02-31 25:61:00`` is 2024-03-03 02:01. Text after the seconds is
    ignored. Times outside the years 1 to 9999 are null.
    """
    exact = F.try_to_timestamp(text, F.lit(TIME_INPUT)).cast("timestamp_ntz")
    return F.coalesce(F.when(text.rlike(_EXACT), exact), _rolled_over(text))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _rolled_over(text: Column) -> Column:
    """A time by calendar arithmetic on its fields; looked at only where text is unusual."""
    found = F.regexp_extract_all(text, F.lit(_FIELDS), F.lit(0))

    def time(fields: Column) -> Column:
        numbers = (F.get(fields, F.lit(i)).try_cast("long") for i in range(6))
        year, month, day, hour, minute, second = numbers
        years = year + F.floor((month - 1) / 12)
        first = F.make_date(
            F.when(years.between(1, 9999), years).cast("int"),
            (F.pmod(month - 1, F.lit(12)) + 1).cast("int"),
            F.lit(1),
        )
        seconds = (F.unix_date(first) + day - 1) * 86_400 + hour * 3_600 + minute * 60 + second
        return _bound(seconds, at)

    def at(seconds: Column) -> Column:
        in_reach = F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), seconds)
        return F.timestamp_add("SECOND", in_reach, F.lit("1970-01-01").cast("timestamp_ntz"))

    digits = F.lit(r"(\d+)")
    # One match at most, so one time.
    times = F.transform(found, lambda one: _bound(F.regexp_extract_all(one, digits), time))
    return F.get(times, F.lit(0))


def parse_date_key(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(DATE_KEY)).cast("date")


def format_time(time: Column) -> Column:
    return F.date_format(time, TIME_TEXT)


def format_date(time: Column) -> Column:
    return F.date_format(time, DATE_TEXT)


def format_date_key(time: Column) -> Column:
    return F.date_format(time, DATE_KEY)


def format_minute(time: Column) -> Column:
    return F.date_format(time, MINUTE_KEY)


def date_hour(time: Column) -> Column:
    return F.date_format(time, DATE_HOUR)


def hour_text(time: Column) -> Column:
    return F.date_format(time, HOUR)


def is_before(first: Column, second: Column) -> Column:
    """Compares time texts; false when either is unreadable."""
    return F.coalesce(parse_time(first) < parse_time(second), F.lit(False))


def is_after(first: Column, second: Column) -> Column:
    return F.coalesce(parse_time(first) > parse_time(second), F.lit(False))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end`` (timestamps)."""
    return F.timestamp_diff("SECOND", start, end)


def text_seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds between two time texts; 0 when either is unreadable."""
    return F.coalesce(seconds_between(parse_time(start), parse_time(end)), F.lit(0).cast("long"))


def today() -> Column:
    return F.date_format(F.current_date(), DATE_TEXT)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_TEXT)
