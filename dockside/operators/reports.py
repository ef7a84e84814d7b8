"""Reads that watch the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total_rows(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total"))


def rows_per_day(rows: DataFrame, day: Column, name: str = "date") -> DataFrame:
    return rows.groupBy(day.alias(name)).agg(F.count(F.lit(1)).alias("records"))


def newest_days(rows: DataFrame, day: Column, name: str = "date", top: int = 10) -> DataFrame:
    """The report itself is the newest ``top`` days with their counts."""
    return rows_per_day(rows, day, name).orderBy(F.col(name).desc_nulls_last()).limit(top)


def in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """Ascending with NULLs at the end, for people; pointless before a write."""
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in columns])
