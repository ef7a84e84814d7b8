"""Dates, keys and coercion."""

from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockside.functions.coerce import to_day, to_integer, to_text
from dockside.functions.dates import DateWindow, date_window, utc_day
from dockside.functions.keys import strict_key, tolerant_key
from dockside.operators.filters import non_blank


def values(spark, kind, inputs, function):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r["out"] for r in rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_rolling_window_ignores_given_dates():
    assert date_window("2024-03-01", start="2020-01-01") == DateWindow(date(2024, 1, 31), date(2024, 4, 30))


def test_given_window_defaults():
    today = date(2024, 3, 1)
    assert date_window(today, rolling=False) == DateWindow(today, today)
    one_day = DateWindow(date(2024, 2, 1), date(2024, 2, 1))
    assert date_window(today, rolling=False, start="2024-02-01") == one_day
    assert date_window(today, rolling=False, start="2024-02-01", end="2024-02-09").end == date(2024, 2, 9)


def test_utc_day_does_not_depend_on_the_session_zone(spark):
    late = datetime(2024, 1, 30, 23, 30, tzinfo=timezone.utc)
    before = datetime(1969, 12, 31, 23, 0, tzinfo=timezone.utc)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            row = spark.range(1).select(utc_day(F.lit(late)).alias("a"), utc_day(F.lit(before)).alias("b")).first()
            assert (row["a"], row["b"]) == (date(2024, 1, 30), date(1969, 12, 31))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_keys(spark):
    rows = spark.createDataFrame(
        [("P", "S", date(2024, 1, 2)), ("P", "S", None), (None, "S", date(2024, 1, 2)), (None, None, None)],
        "po string, sku string, d date",
    )
    parts = (F.col("po"), F.col("sku"), F.col("d"))
    got = rows.select(strict_key(*parts).alias("strict"), tolerant_key(*parts).alias("tolerant")).collect()
    assert [r["strict"] for r in got] == ["P_S_20240102", None, None, None]
    assert [r["tolerant"] for r in got] == ["P_S_20240102", "P_S_NULL", "None_S_20240102", "None_None_NULL"]


def test_integers_from_text(spark):
    inputs = ["7", "1e3", "", "abc", None, "12.0", " 8 ", "-3", "12d", "9007199254740993", ".5e1", "NaN"]
    got = values(spark, "string", inputs, to_integer)
    assert got == [7, 1000, 0, 0, 0, 12, 8, -3, 0, 9007199254740993, 5, 0]


def test_integers_from_numbers(spark):
    as_double = lambda c: to_integer(c, T.DoubleType())
    assert values(spark, "double", [3.0, None, float("nan")], as_double) == [3, 0, 0]
    assert values(spark, "int", [5, None], lambda c: to_integer(c, T.IntegerType())) == [5, 0]
    assert values(spark, "decimal(10,2)", [None], to_integer) == [0]


@pytest.mark.parametrize("text", ["12.7", "1e30", "-0.5", "inf", "-Infinity"])
def test_a_number_that_would_change_fails(spark, text):
    with pytest.raises(PySparkException, match="not a whole number"):
        values(spark, "string", [text], to_integer)


def test_days_from_text(spark):
    inputs = ["2025-01-02", "20250102", "2025-13-01", "9999-12-31", None, "", "1677-09-21", "2262-04-11"]
    day = date(2025, 1, 2)
    assert values(spark, "string", inputs, to_day) == [day, day, None, None, None, None, None, date(2262, 4, 11)]


def test_days_from_dates(spark):
    got = values(spark, "date", [date(2025, 1, 2), date(9999, 12, 31), None], lambda c: to_day(c, T.DateType()))
    assert got == [date(2025, 1, 2), None, None]


def test_texts(spark):
    assert values(spark, "string", [None, "None", "x", " "], to_text) == ["", "", "x", " "]
    assert values(spark, "int", [7, None], to_text) == ["7", ""]


def test_blank_texts(spark):
    assert values(spark, "string", [None, "", "   ", " x "], non_blank) == [False, False, False, True]
