"""Date windows and date columns.  "Today" is always an argument."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockside.rules import DAYS_BACK, DAYS_FORWARD


@dataclass(frozen=True)
class DateWindow:
    """Closed range of calendar days."""

    start: date
    end: date


def as_day(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def date_window(
    as_of: date | str,
    rolling: bool = True,
    start: date | str | None = None,
    end: date | str | None = None,
    back: int = DAYS_BACK,
    forward: int = DAYS_FORWARD,
) -> DateWindow:
    """The days a run covers.

    Rolling: ``back`` days before to ``forward`` days after ``as_of``, whatever
    dates are given.  Otherwise the given dates; a missing start is ``as_of``
    and a missing end is the start.
    """
    today = as_day(as_of)
    if rolling:
        return DateWindow(today - timedelta(days=back), today + timedelta(days=forward))
    first = as_day(start) if start else today
    return DateWindow(first, as_day(end) if end else first)


def in_window(day: Column, window: DateWindow) -> Column:
    """Inclusive on both ends; a NULL day is outside."""
    return day.between(F.lit(window.start), F.lit(window.end))


def utc_day(instant: Column) -> Column:
    """UTC calendar day of a timestamp, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def compact_day(day: Column) -> Column:
    """yyyymmdd text of a date."""
    return F.date_format(day, "yyyyMMdd")
