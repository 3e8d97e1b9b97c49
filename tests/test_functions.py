from __future__ import annotations

import datetime as dt
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.frames import table, tuples
from trailmark.functions import labels, numeric, texts, times


def values(spark, column, rows, kind="string"):
    df = table(spark, f"i int, x {kind}", *enumerate(rows))
    return [row[0] for row in df.orderBy("i").select(column).collect()]


def test_parse_time_takes_padded_and_unpadded_hours_and_nulls_the_rest(spark):
    rows = [None, "", "bad", "2020-05-01 9:05:07", "2020-05-01 09:05:07"]
    nine = dt.datetime(2020, 5, 1, 9, 5, 7)
    assert values(spark, times.parse_time(F.col("x")), rows) == [None, None, None, nine, nine]


def test_time_formats(spark):
    time = times.parse_time(F.col("x"))
    formats = F.array(
        times.format_time(time),
        times.format_date(time),
        times.format_date_key(time),
        times.format_minute(time),
        times.date_hour(time),
    )
    assert values(spark, formats, ["2020-05-01 9:05:07"]) == [
        ["2020-05-01 09:05:07", "2020-05-01", "20200501", "202005010905", "2020-05-01_09"]
    ]
    assert values(spark, times.parse_date_key(F.col("x")), ["20200501", "x"]) == [
        dt.date(2020, 5, 1),
        None,
    ]


def test_time_comparison_of_texts(spark):
    df = table(
        spark,
        "a string, b string",
        ("2020-05-01 9:00:00", "2020-05-01 10:00:01"),
        ("2020-05-01 10:00:01", "2020-05-01 9:00:00"),
        ("bad", "2020-05-01 9:00:00"),
    )
    a, b = F.col("a"), F.col("b")
    found = df.select(
        times.is_before(a, b), times.is_after(a, b), times.text_seconds_between(b, a)
    ).collect()
    assert [tuple(row) for row in found] == [
        (True, False, -3601),
        (False, True, 3601),
        (False, False, 0),
    ]


def test_today_and_yesterday(spark):
    today, yesterday = values(spark, F.array(times.today(), times.yesterday()), ["x"])[0]
    one_day = dt.timedelta(days=1)
    assert dt.date.fromisoformat(today) - dt.date.fromisoformat(yesterday) == one_day


def test_half_up_ratio_is_exact(spark):
    pairs = [(29, 200), (1, 3), (2, 3), (1, 8), (0, 5), (5, 5), (7, 0), (145, 1000)]
    df = table(spark, "n long, d long", *pairs)
    found = [row[0] for row in df.select(numeric.half_up_ratio("n", "d")).collect()]
    wanted = [
        None if d == 0 else int(Fraction(100 * n, d) + Fraction(1, 2)) / 100 for n, d in pairs
    ]
    assert found == wanted
    assert found[0] == 0.15


def test_empty_tests(spark):
    both = F.array(texts.is_empty(F.col("x")), texts.is_not_empty(F.col("x")))
    assert values(spark, both, [None, "", "a"]) == [[True, False], [True, False], [False, True]]


def test_trim_comma_takes_one_comma_per_side(spark):
    assert values(spark, texts.trim_comma(F.col("x")), [",a,", ",,a,,", ",", "a"]) == [
        "a",
        ",a,",
        "",
        "a",
    ]


def test_pad_two_does_not_truncate(spark):
    assert values(spark, texts.pad_two(F.col("x")), ["1", "12", "123", ""]) == [
        "01",
        "12",
        "0123",
        "0",
    ]


def test_listed_ids_skips_what_is_no_number(spark):
    df = table(spark, "i int, x string", (0, "1, 2,x,,3"), (1, None), (2, ""))
    listed = df.select("i", texts.listed_ids("x").alias("id"))
    numbers = listed.selectExpr("i", f"{texts.LISTED_ID} AS n").where("n IS NOT NULL")
    assert tuples(numbers) == [(0, 1), (0, 2), (0, 3)]


@pytest.mark.parametrize(
    ("record", "value"),
    [
        ("a=1|b=2", "2"),
        ("b=2|b=3", "2"),
        ("b=|b=3", "3"),
        ("b=1=2|b=3", "3"),
        ("b=4=|b=3", "4"),
        ("ab=1", None),
        ("a=b|c=1", None),
        ("b", None),
        ("x.b=1|b=7|", "7"),
        ("", None),
        (None, None),
    ],
)
def test_record_field(spark, record, value):
    assert values(spark, texts.record_field(F.col("x"), "b"), [record]) == [value]


@pytest.mark.parametrize(
    ("record", "changed"),
    [
        ("a=1|b=2|c=3", "a=1|b=new|c=3"),
        ("b=1|b=2", "b=new|b=2"),
        ("a=1|b", "a=1|b=new"),
        ("b=", "b=new"),
        ("ab=1|cb=2", "ab=1|cb=2"),
        ("a=1|b=2||", "a=1|b=new"),
        ("b=1=2|c=3", "b=new|c=3"),
        ("", ""),
        (None, None),
    ],
)
def test_with_record_field(spark, record, changed):
    assert values(spark, texts.with_record_field(F.col("x"), "b", "new"), [record]) == [changed]


def test_record_delimiter_is_taken_literally(spark):
    assert values(spark, texts.record_field(F.col("x"), "b", "."), ["a=1.b=2"]) == ["2"]


def test_id_name_is_null_when_a_part_is(spark):
    df = table(spark, "i long, n string", (1, "x"), (None, "y"), (2, None))
    found = [row[0] for row in df.select(texts.id_name(F.col("i"), F.col("n"))).collect()]
    assert found == ["1:x", None, None]


def test_product_status(spark):
    rows = [
        None,
        "bad",
        "{}",
        '{"product_status": 0}',
        '{"product_status": 1}',
        '{"product_status": "x"}',
        '{"product_status": "0"}',
    ]
    own, other = labels.SELF_OPERATED, labels.THIRD_PARTY
    assert values(spark, labels.product_status(F.col("x")), rows) == [
        other,
        other,
        other,
        own,
        other,
        other,
        own,
    ]


def test_area_level(spark):
    rows = ["华北", "华东", "华南", "华中", "西北", "西南", "东北", None]
    assert values(spark, labels.area_level(F.col("x")), rows) == [
        "A级",
        "A级",
        "B级",
        "B级",
        "C级",
        "C级",
        "D级",
        "D级",
    ]
    assert values(spark, labels.area_level(F.col("x"), {}, "z"), ["华北"]) == ["z"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-02-31 25:61:00", "2024-03-03 02:01:00"),
        ("2024-1-5 9:5:7", "2024-01-05 09:05:07"),
        ("2024-01-05 09:05:07.250 and more", "2024-01-05 09:05:07"),
        ("2024-13-01 00:00:00", "2025-01-01 00:00:00"),
        ("2024-00-00 00:00:00", "2023-11-30 00:00:00"),
        ("  2024- 01-05  09:05:07", "2024-01-05 09:05:07"),
        ("2024-01-05 09:05:86400", "2024-01-06 09:05:00"),
        ("2023-02-29 00:00:00", "2023-03-01 00:00:00"),
        ("0000-01-01 00:00:00", None),
        ("9999-12-31 23:59:60", None),
        ("2024-01-05 09:05", None),
        ("2024-01-05", None),
        ("-2024-01-05 09:05:07", None),
        ("2024-01-05 09:05:x", None),
        ("99999999999-01-05 09:05:07", None),
        ("999999999-999999999-999999999 999999999:999999999:999999999", None),
        ("", None),
        (None, None),
    ],
)
def test_times_are_read_leniently(spark, text, expected):
    row = table(spark, "text string", (text,)).select(times.format_time(times.parse_time(F.col("text"))))
    assert row.first()[0] == expected


def test_texts_that_are_no_exact_time_do_not_reach_the_exact_parser(spark):
    """Each text that Spark's parser refuses would cost an exception."""
    df = spark.range(400).selectExpr(
        "CASE id % 4 WHEN 0 THEN 'bad' WHEN 1 THEN concat('2023-14-40 25:61:', id)"
        " WHEN 2 THEN concat('0000-01-01 9:05:', 10 + id % 50)"
        " ELSE concat('2024-01-15 9:05:', 10 + id % 50) END AS text",
        "id",
    )
    made = df.select("id", "text", times.format_time(times.parse_time(F.col("text"))).alias("time"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RLIKE") < plan.index("gettimestamp")
    for row in made.collect():
        if row.id % 4 == 1:
            start = dt.datetime(2024, 2, 1) + dt.timedelta(days=39, hours=25, minutes=61, seconds=row.id)
            assert row.time == start.strftime("%Y-%m-%d %H:%M:%S")
        elif row.id % 4 == 3:
            assert row.time == row.text.replace(" 9", " 09")
        else:
            assert row.time is None
