"""Row predicates shared by the plans."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockside.functions.dates import DateWindow, as_day, in_window
from dockside.rules import RECENT_DAYS


def listed(value: Column, allowed: tuple) -> Column:
    return value.isin(*allowed)


def non_blank(value: Column) -> Column:
    """Something other than NULL or spaces; the value itself stays untrimmed."""
    return value.isNotNull() & (F.trim(value) != "")


def within(rows: DataFrame, day: str, window: DateWindow) -> DataFrame:
    """Rows whose day lies in the window; reaches the scan as a pushed filter."""
    return rows.where(in_window(F.col(day), window))


def recent_batches(
    staging: DataFrame, as_of: date | str, days: int = RECENT_DAYS, load_day: str = "load_date"
) -> DataFrame:
    """Batches loaded at most ``days`` days before ``as_of``.

    ``load_date`` is the partition column of staging: old batches are not read.
    """
    oldest = as_day(as_of) - timedelta(days=days)
    return staging.where(F.col(load_day) >= F.lit(oldest))
