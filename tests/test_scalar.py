"""Expressions where SQL engines differ, one literal row at a time."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardmart.functions import scalar


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def texts(spark, column, items):
    return values(spark, column, [(x,) for x in items], "x string")


def test_round_half_scales(spark):
    rows = [(1.005,), (2.345,), (-1.005,), (0.125,), (None,)]
    got = values(spark, scalar.round_half(F.col("x"), 2), rows, "x double")
    assert got == [1.0, 2.35, -1.0, 0.13, None]


def test_percent_is_double_and_guards_zero(spark):
    got = values(
        spark, scalar.percent(F.col("a"), F.col("b"), 1), [(1, 3), (1, 0), (None, 2)], "a long, b long"
    )
    assert got == [33.3, None, None]


def test_hours_keep_fractions(spark):
    rows = [
        (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 20)),
        (datetime(2024, 1, 2), datetime(2024, 1, 1)),
        (datetime(2024, 1, 1), None),
        (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 18, 400)),
    ]
    column = scalar.hours_between(F.col("a"), F.col("b"))
    got = values(spark, column, rows, "a timestamp_ntz, b timestamp_ntz")
    assert got == [0.33, -24.0, None, 0.01]


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = spark.sql(
            "select timestamp_ntz'2024-03-10 02:30:00' a, timestamp_ntz'2024-03-11 02:30:00' b"
        )
        row = gap.select(
            scalar.time_of_day(F.col("a")), scalar.elapsed_seconds(F.col("a"), F.col("b"))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert list(row) == ["02:30:00", Decimal("86400.000000")]


def test_time_of_day_prints_a_fraction_only_when_there_is_one(spark):
    column = scalar.time_of_day(F.col("x").cast("timestamp_ntz"))
    got = texts(spark, column, ["2024-01-01 09:05:00", "2024-01-01 23:59:59.500", None])
    assert got == ["09:05:00", "23:59:59.5", None]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-31", date(2024, 1, 31)),
        (" 2024-1-5 ", date(2024, 1, 5)),
        ("2024/01/01", date(2024, 1, 1)),
        ("2024-01-01 10:00:00", date(2024, 1, 1)),
        ("99-01-01", date(99, 1, 1)),
        ("2024", None),
        ("2024-05", None),
        ("2024-02-30", None),
        ("+2024-01-01", None),
        ("open", None),
        ("", None),
        (None, None),
    ],
)
def test_dates_need_year_month_and_day(spark, text, expected):
    assert texts(spark, scalar.date_or_null(F.col("x")), [text]) == [expected]


def test_integers_from_text_are_rounded(spark):
    items = ["7", "1.7", "2.5", "-2.5", "1e3", " 5 ", "abc", "99999999999", None]
    got = texts(spark, scalar.int_or_null(F.col("x")), items)
    assert got == [7, 2, 3, -3, 1000, 5, None, None, None]


def test_money_rounds_and_drops_bad_text(spark):
    got = texts(spark, scalar.money_or_null(F.col("x")), ["12.345", "7", "x"])
    assert got == [Decimal("12.35"), Decimal("7.00"), None]


def test_month_number_and_label(spark):
    rows = [(2026, 8), (2026, 12)]
    y, m = F.col("y"), F.col("m")
    assert values(spark, scalar.month_number(y, m), rows, "y int, m int") == [202608, 202612]
    assert values(spark, scalar.month_label(y, m), rows, "y int, m int") == ["2026-08", "2026-12"]


def test_months_before_keeps_the_day(spark):
    got = texts(spark, scalar.months_before(F.col("x").cast("date"), 12), ["2024-02-29", "2026-08-01"])
    assert got == [date(2023, 2, 28), date(2025, 8, 1)]


def test_count_where_ignores_null(spark):
    rows = [(True,), (False,), (None,)]
    frame = spark.createDataFrame(rows, "x boolean")
    column = F.col("x")
    got = frame.agg(scalar.count_where(column), scalar.count_where(~column)).first()
    assert list(got) == [1, 1]
