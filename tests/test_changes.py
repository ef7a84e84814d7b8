"""Counts of what a load did to the rows of a final table, against counts in plain Python."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone
from random import Random

import pytest

from dockside.plans import refresh
from dockside.plans.datasets import DatasetSpec
from dockside.plans.refresh import load_batch
from dockside.plans.runs import run
from dockside.schemas import table_schema
from dockside.sinks import changes
from dockside.sinks.changes import CHANGES, counted_changes
from dockside.sinks.states import current_state, merge_arrivals, of_parts
from dockside.sinks.tables import create_tables, publish, read_final

TODAY = date(2024, 1, 30)
NOW = datetime(2024, 1, 30, 2, tzinfo=timezone.utc)
WINDOW = (date(2023, 12, 31), date(2024, 3, 30))

SPEC = DatasetSpec(
    name="small",
    staging_table="small_staging",
    final_table="small_final",
    schema=table_schema("record_key string, d date, n bigint, load_timestamp timestamp"),
    date_column="d",
    newest_first=("load_timestamp", "n"),
)


def plain(before, after, spec=SPEC):
    """Rows as (key, day, load time) of both states."""
    found = Counter({c: 0 for c in CHANGES})
    old, new = ({k: (d, t) for k, d, t in rows if k is not None} for rows in (before, after))
    bare_old, bare_new = (Counter((d, t) for k, d, t in rows if k is None) for rows in (before, after))
    found["unchanged"] += (bare_old & bare_new).total()
    found["added"] += (bare_new - bare_old).total()
    gone = list((bare_old - bare_new).elements())
    for key, (day, when) in old.items():
        if key in new:
            found["unchanged" if new[key][1] == when else "replaced"] += 1
        else:
            gone.append((day, when))
    found["added"] += len(new.keys() - old.keys())
    for day, _ in gone:
        outside = spec.cleanup_final and day is not None and not WINDOW[0] <= day <= WINDOW[1]
        found["out_of_window" if outside else "stale"] += 1
    return dict(found)


def held(spark, database, spec=SPEC):
    return [(r["record_key"], r["d"], r["load_timestamp"]) for r in read_final(spark, database, spec).collect()]


def some_rows(random, keys, count):
    days = [-40, -30, 0, 60, 61, None]
    return {
        key: (key, None if (day := random.choice(days)) is None else TODAY + timedelta(day), random.randrange(3))
        for key in random.sample(keys, count)
    }.values()


@pytest.mark.parametrize("stale", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_loads_report_what_they_changed(spark, database, seed, stale):
    random, spec = Random(seed), replace(SPEC, cleanup_stale=stale)
    create_tables(spark, database, spec)
    keys = [f"k{n}" for n in range(30)]
    old = [(*row, NOW - timedelta(1)) for row in some_rows(random, keys, 20)]
    old += [(None, TODAY, 1, NOW - timedelta(1))] * 3 + [(None, TODAY - timedelta(50), 1, None)] * 2
    publish(spark, database, spec, spark.createDataFrame(old, spec.schema))
    for day in range(2):
        before, notes = held(spark, database), {}
        rows = spark.createDataFrame(list(some_rows(random, keys, 15)), "record_key string, d date, n bigint")
        load_batch(spark, database, spec, rows, TODAY, NOW + timedelta(hours=day), notes=notes)
        after = held(spark, database)
        assert notes["final_rows"] == plain(before, after, spec)
        counts = Counter(notes["final_rows"])
        assert counts["unchanged"] + counts["replaced"] + counts["added"] == len(after)
        assert counts.total() - counts["added"] == len(before)


def test_untouched_parts_are_not_opened(spark, database, monkeypatch):
    spec = replace(SPEC, buckets=16)
    create_tables(spark, database, spec)
    old = [(f"k{n}", TODAY - timedelta(n % 40), n, NOW - timedelta(1)) for n in range(400)]
    publish(spark, database, spec, spark.createDataFrame(old, spec.schema))
    inside = spark.createDataFrame([(k, max(d, WINDOW[0]), n, t) for k, d, n, t in old], spec.schema)
    publish(spark, database, spec, inside)
    before, rows = current_state(spark, database, spec), held(spark, database)
    arrivals = [("k7", TODAY, 1, NOW), ("new", TODAY, 1, NOW), ("k8", TODAY + timedelta(90), 1, NOW)]
    merge_arrivals(spark, database, spec, spark.createDataFrame(arrivals, spec.schema), TODAY)
    opened = []
    monkeypatch.setattr(changes, "of_parts", lambda parts: opened.append(len(parts)) or of_parts(parts))
    found = counted_changes(spark, database, spec, before, current_state(spark, database, spec), TODAY)
    assert found == plain(rows, held(spark, database))
    assert found == {"unchanged": 398, "replaced": 1, "added": 1, "out_of_window": 0, "stale": 1}
    assert max(opened) <= 3


def test_a_floor_that_moves_counts_rows_it_hides(spark, database):
    create_tables(spark, database, SPEC)
    old = [(f"k{n}", TODAY - timedelta(n), n, NOW) for n in range(60)]
    publish(spark, database, SPEC, spark.createDataFrame(old, SPEC.schema))
    before, rows = current_state(spark, database, SPEC), held(spark, database)
    merge_arrivals(spark, database, SPEC, spark.createDataFrame([("k1", TODAY, 5, NOW + timedelta(hours=1))], SPEC.schema), TODAY)
    found = counted_changes(spark, database, SPEC, before, current_state(spark, database, SPEC), TODAY)
    assert found == plain(rows, held(spark, database)) and found["out_of_window"] == 29 and found["replaced"] == 1


def test_nothing_before_nothing_after(spark, database):
    create_tables(spark, database, SPEC)
    empty = current_state(spark, database, SPEC)
    assert counted_changes(spark, database, SPEC, empty, empty, TODAY) == {c: 0 for c in CHANGES}


def test_runs_report_it_and_stand_without_it(spark, database, monkeypatch):
    report = run(spark, database, None, TODAY, names=["po"], samples=True, stamp=NOW)["results"]["po"]
    assert report["final_rows"] == {"unchanged": 0, "replaced": 0, "added": 3, "out_of_window": 0, "stale": 0}
    again = run(spark, database, None, TODAY, names=["po"], samples=True, stamp=NOW + timedelta(hours=1))["results"]["po"]
    assert again["final_rows"]["replaced"] == 3 and again["staging_rows_deleted"] == 0

    def broken(*_):
        raise RuntimeError("no count")

    monkeypatch.setattr(refresh, "counted_changes", broken)
    last = run(spark, database, None, TODAY, names=["po"], samples=True, stamp=NOW + timedelta(hours=2))["results"]["po"]
    assert last["status"] == "success" and last["final_rows"] == "failed: no count"
