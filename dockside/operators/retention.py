"""Deletes, written as the rows that stay.

A delete whose condition is NULL does not fire, so rows without a date or
timestamp stay.  The predicates are plain comparisons and reach the scan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockside.functions.dates import date_window, in_window
from dockside.rules import DAYS_BACK, DAYS_FORWARD


def inside_window(day: Column, as_of: date | str, back: int = DAYS_BACK, forward: int = DAYS_FORWARD) -> Column:
    return day.isNull() | in_window(day, date_window(as_of, back=back, forward=forward))


def delete_out_of_window(
    rows: DataFrame, day: str, as_of: date | str, back: int = DAYS_BACK, forward: int = DAYS_FORWARD
) -> DataFrame:
    return rows.where(inside_window(F.col(day), as_of, back, forward))


def delete_stale(rows: DataFrame, staging: DataFrame, stamp: str = "load_timestamp") -> DataFrame:
    """Rows older than the newest staged batch go; with nothing staged, none do.

    The newest stamp is a scalar subquery, so it is known before ``rows`` are
    scanned and prunes their row groups.
    """
    kind = staging.schema[stamp].dataType
    beginning = F.lit("0001-01-02 00:00:00").cast(kind)
    newest = staging.agg(F.coalesce(F.max(stamp), beginning).alias("newest")).scalar()
    return rows.where(F.col(stamp).isNull() | (F.col(stamp) >= newest))
