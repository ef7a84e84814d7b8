"""Scratch tables have an owner, and what owners leave behind is swept."""

from __future__ import annotations

import time
from datetime import date, datetime, timedelta, timezone

import pytest

from dockside import session
from dockside.functions.dates import date_window
from dockside.plans.po_inbound import po_inbound
from dockside.plans.runs import run
from dockside.session import SCRATCH_DATABASE, scratch_tables, side_by_side, sweep_scratch, written

TODAY = date(2024, 1, 30)


def names(spark):
    if not spark.catalog.databaseExists(SCRATCH_DATABASE):
        return set()
    return {t.name for t in spark.catalog.listTables(SCRATCH_DATABASE)}


def test_a_block_leaves_nothing(spark, tables):
    before = names(spark)
    with scratch_tables(spark):
        assert po_inbound(tables(), date_window(TODAY)).count() >= 0
        assert len(names(spark)) > len(before)
    assert names(spark) == before


def test_a_failing_block_leaves_nothing(spark):
    before = names(spark)

    def broken():
        written(spark.range(3), "part")
        raise RuntimeError("no more")

    with pytest.raises(RuntimeError), scratch_tables(spark):
        side_by_side(broken, lambda: written(spark.range(2), "other"))
    assert names(spark) == before


def test_old_tables_are_swept_and_new_ones_stay(spark, monkeypatch):
    now = time.time_ns()
    monkeypatch.setattr(session.time, "time_ns", lambda: now - 8 * 24 * 3600 * 10**9)
    written(spark.range(3), "old_part")
    monkeypatch.setattr(session.time, "time_ns", lambda: now)
    fresh = written(spark.range(4), "new_part")
    assert sweep_scratch(spark) == 1
    assert not any(n.startswith("old_part") for n in names(spark)) and fresh.count() == 4
    assert sweep_scratch(spark, timedelta(days=365)) == 0


def test_a_run_sweeps_and_stands_if_that_fails(spark, database, monkeypatch):
    stamp = datetime(2024, 1, 30, 2, tzinfo=timezone.utc)
    monkeypatch.setattr("dockside.plans.runs.sweep_scratch", lambda spark: 1 / 0)
    report = run(spark, database, None, TODAY, names=["po"], samples=True, stamp=stamp)
    assert report["status"] == "success"
