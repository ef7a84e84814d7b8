"""Joins whose physical form depends on a measured size.

A side offered for broadcast is measured first, in one aggregate over its own
columns or while it is written.  What fits the budget is broadcast, and the big
side never shuffles for it.  A side that does not fit whole may fit by its keys:
then the big side is cut down where it is read and only what is left shuffles.
Beyond that the join is an ordinary shuffle join, where AQE splits a hot key at
run time (see ``session.RUNTIME_SETTINGS``).

The range of a measured key comes for free and is always applied to the big
side: order numbers tend to grow with time, so row groups of old orders are
skipped unread.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockside.session import written


@dataclass(frozen=True)
class JoinBudget:
    """Most bytes a broadcast side may take in an executor's memory."""

    broadcast_bytes: int = 128 * 1024 * 1024


DEFAULT_BUDGET = JoinBudget()

# Rough cost of one row in a broadcast hash table: key, pointers, null bits.
ROW_OVERHEAD = 40


@dataclass(frozen=True)
class Sized:
    """Rows with their measured number, text bytes per column, and key ranges."""

    rows: DataFrame
    count: int
    text_bytes: Mapping[str, int]
    ranges: Mapping[str, tuple[Any, Any]]
    budget: JoinBudget

    @property
    def columns(self) -> list[str]:
        return self.rows.columns

    def bytes_of(self, *columns: str) -> int:
        """In-memory size of the columns: a word each per row, plus the text."""
        text = sum(self.text_bytes.get(name, 0) for name in columns)
        return self.count * (8 * len(columns) + ROW_OVERHEAD) + text

    def small(self, *columns: str) -> bool:
        """Whether the columns (all by default) may be broadcast."""
        return self.bytes_of(*(columns or self.columns)) <= self.budget.broadcast_bytes

    def with_rows(self, rows: DataFrame) -> Sized:
        """The same rows with columns added that are not text."""
        return replace(self, rows=rows)


def text_columns(rows: DataFrame) -> list[str]:
    return [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]


def measures(rows: DataFrame, keys: tuple[str, ...]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        *[F.coalesce(F.sum(F.octet_length(F.col(c))), F.lit(0)).alias(f"bytes of {c}") for c in text_columns(rows)],
        *[F.min(c).alias(f"least {c}") for c in keys],
        *[F.max(c).alias(f"greatest {c}") for c in keys],
    ]


def as_sized(rows: DataFrame, found: Mapping[str, Any], keys: tuple[str, ...], budget: JoinBudget) -> Sized:
    text_bytes = {c: found[f"bytes of {c}"] for c in text_columns(rows)}
    ranges = {c: (found[f"least {c}"], found[f"greatest {c}"]) for c in keys}
    return Sized(rows, found["rows"], text_bytes, ranges, budget)


def sized(rows: DataFrame, *keys: str, budget: JoinBudget = DEFAULT_BUDGET) -> Sized:
    """Measure ``rows`` where they are; ``keys`` name the columns to know the range of."""
    return as_sized(rows, rows.agg(*measures(rows, keys)).first().asDict(), keys, budget)


def once(rows: DataFrame, label: str, *keys: str, budget: JoinBudget = DEFAULT_BUDGET) -> Sized:
    """``rows`` as a scratch table, measured as it is written.

    For a side that several joins use: it is computed one time in all.
    """
    seen = Observation()
    table = written(rows.observe(seen, *measures(rows, keys)), label)
    return as_sized(table, seen.get, keys, budget)


def in_reach(rows: DataFrame, on: str, *sides: Sized) -> DataFrame:
    """Rows whose ``on`` lies in the range of any side; all rows if a range is unknown."""
    if any(on not in side.ranges for side in sides):
        return rows
    ranges = [side.ranges[on] for side in sides if side.ranges[on][0] is not None]
    if not ranges:
        return rows.where(F.lit(False))
    return rows.where(F.col(on).between(min(low for low, _ in ranges), max(high for _, high in ranges)))


def narrow(rows: DataFrame, keys: Sized, on: str) -> DataFrame:
    """Drop rows that a later join on ``on`` would not use anyway.

    By the range of the keys, and by the keys themselves where they can be
    broadcast: then irrelevant rows never reach a shuffle.  Beyond that a semi
    join would move as many bytes as the aggregation that follows.
    """
    return keep_matching(rows, keys, on) if keys.small(on) else in_reach(rows, on, keys)


def keep_matching(rows: DataFrame, keys: Sized, on: str) -> DataFrame:
    """Rows whose ``on`` occurs among the keys."""
    wanted = keys.rows.select(on)
    return in_reach(rows, on, keys).join(
        F.broadcast(wanted) if keys.small(on) else wanted.distinct(), on, "left_semi"
    )


def attach(rows: DataFrame, side: Sized | DataFrame, on: str) -> DataFrame:
    """Inner join of ``side`` to the bigger ``rows``; an unmeasured side is left to Spark."""
    if isinstance(side, DataFrame):
        return rows.join(side, on)
    if side.small():
        return in_reach(rows, on, side).join(F.broadcast(side.rows), on)
    return narrow(rows, side, on).join(side.rows, on)
