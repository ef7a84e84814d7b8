"""Latest row, upsert and deletes on hand-made frames."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from dockside.operators.filters import recent_batches
from dockside.operators.latest import latest_per_key
from dockside.operators.retention import delete_out_of_window, delete_stale
from dockside.operators.reports import in_order, newest_days, rows_per_day, total_rows
from dockside.operators.upsert import upsert, upsert_newest
from pyspark.sql import functions as F

TODAY = date(2024, 1, 30)


def test_retention_bounds_and_missing_dates(spark):
    days = [-31, -30, 0, 60, 61]
    rows = spark.createDataFrame([(n, TODAY + timedelta(n)) for n in days] + [(None, None)], "n int, d date")
    kept = delete_out_of_window(rows, "d", TODAY).collect()
    assert [r["n"] for r in kept] == [-30, 0, 60, None]


def test_recency_is_inclusive(spark):
    rows = spark.createDataFrame([(n, TODAY - timedelta(n)) for n in (0, 14, 15)], "n int, load_date date")
    assert [r["n"] for r in recent_batches(rows, TODAY).collect()] == [0, 14]


@pytest.mark.parametrize("small", [False, True])
def test_upsert_with_missing_keys(spark, small):
    old = spark.createDataFrame([("a", "T"), ("b", "T"), (None, "T"), (None, "T")], "k string, v string")
    new = spark.createDataFrame([("b", "S"), ("c", None), (None, "S")], "k string, v string")
    got = sorted(upsert(old, new, "k", small).collect(), key=str)
    expected = [("a", "T"), ("b", "S"), ("c", None), (None, "T"), (None, "T"), (None, "S")]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_upsert_of_the_newest_rows(spark):
    old = spark.createDataFrame(
        [("a", 9, "T"), ("b", 9, "T"), (None, 1, "T"), (None, 1, "T")], "k string, t int, v string"
    )
    new = spark.createDataFrame(
        [("b", 1, "S1"), ("b", 2, "S2"), ("c", 1, "S"), (None, 1, "S1"), (None, 2, "S2")], "k string, t int, v string"
    )
    expected = [("a", "T"), ("b", "S2"), ("c", "S"), (None, "T"), (None, "T"), (None, "S2")]
    got = [(r["k"], r["v"]) for r in upsert_newest(old, new, "k", ("t",)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    two_steps = upsert(old, latest_per_key(new, "k", ("t",)), "k").collect()
    assert sorted(got, key=str) == sorted([(r["k"], r["v"]) for r in two_steps], key=str)


def test_ties_are_settled_by_the_other_columns(spark):
    rows = [("k", 1, "a", 5), ("k", 1, "b", 2), ("k", 1, None, 9), ("k", 0, "z", 9)]
    rows += [(None, 1, "n", 0), (None, 2, "m", 0)]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "k string, ts int, x string, y int").repartition(3)
        got = {tuple(r) for r in latest_per_key(frame, "k", ("ts",)).collect()}
        assert got == {("k", 1, "b", 2), (None, 2, "m", 0)}


def test_missing_order_values_come_last(spark):
    frame = spark.createDataFrame([("k", None, 9), ("k", 1, 1)], "k string, ts int, y int")
    assert latest_per_key(frame, "k", ("ts",)).first()["ts"] == 1


def test_stale_rows(spark):
    stamps = [datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3), None]
    rows = spark.createDataFrame([(t,) for t in stamps], "load_timestamp timestamp")
    staged = spark.createDataFrame([(datetime(2024, 1, 2),), (None,)], "load_timestamp timestamp")
    assert {r[0] for r in delete_stale(rows, staged).collect()} == set(stamps[1:])
    assert delete_stale(rows, staged.limit(0)).count() == 4


def test_reports(spark):
    days = [TODAY - timedelta(i % 12) for i in range(30)]
    rows = spark.createDataFrame([(d,) for d in days] + [(None,)], "d date")
    assert total_rows(rows).first()["total"] == 31
    assert rows_per_day(rows, F.col("d")).count() == 13
    top = newest_days(rows, F.col("d")).collect()
    assert len(top) == 10 and top[0] == (TODAY, 3)
    ordered = [r["d"] for r in in_order(rows, "d").collect()]
    assert ordered[-1] is None and ordered[:-1] == sorted(days)
