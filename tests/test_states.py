"""Key buckets, their states, and the ledger of staged batches."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta
from random import Random

import pytest

import dockside.sinks.states as states
import dockside.sinks.tables as tables
import dockside.streaming.incremental as incremental
from dockside.plans.refresh import newest_stamp, prepared
from dockside.sinks.states import BUCKET, VERSION, current_state, data_name, merge_arrivals, partitions_of, publish, sweep_final
from dockside.sinks.tables import append_batch, batches, create_tables, newest_staged, read_final, read_staging, trim_staging
from test_loads import NOW, SPEC, TODAY, batch, final_rows

MANY = replace(SPEC, buckets=16)


def rows_of(spark, *rows):
    """Rows of (key, days from today or None, n, load days before now)."""
    data = [(k, None if d is None else TODAY + timedelta(d), n, NOW - timedelta(days=age)) for k, d, n, age in rows]
    return spark.createDataFrame(data, SPEC.schema)


def files_by_bucket(spark, database, spec):
    files = read_final(spark, database, spec).inputFiles()
    return {f.split(f"{BUCKET}=")[1].split("/")[0]: f for f in files}


def test_untouched_buckets_keep_their_files(spark, database):
    create_tables(spark, database, MANY)
    publish(spark, database, MANY, rows_of(spark, *[(f"k{i}", 0, 1, 1) for i in range(200)]))
    before = files_by_bucket(spark, database, MANY)
    assert len(before) == 16
    merge_arrivals(spark, database, MANY, rows_of(spark, ("k7", 0, 2, 0), ("k8", 0, 0, 3)), TODAY)
    after = files_by_bucket(spark, database, MANY)
    changed = {b for b in before if before[b] != after[b]}
    assert 1 <= len(changed) <= 2 and len(after) == 16
    found = dict(final_rows(spark, database, MANY))
    assert len(found) == 200 and found["k7"] == 2 and found["k8"] == 1


@pytest.mark.parametrize("cleanup", [True, False])
def test_arrivals_win_or_lose_as_over_all_staged_rows(spark, database, cleanup):
    """Random batches, late ones and ones outside the window among them, over a window that moves."""
    random = Random(7)
    spec = replace(MANY, buckets=3, cleanup_final=cleanup)
    create_tables(spark, database, spec)
    staged, final = [], {}
    for step in range(7):
        as_of = TODAY + timedelta(step * 6 - (9 if step == 5 else 0))
        now = NOW + timedelta(step * 6)
        got = {}
        for _ in range(12):
            day = random.choice([-34, -25, 0, 55, 64, None])
            row = (random.choice("abcdefg"), None if day is None else TODAY + timedelta(step * 6 + day), random.randrange(3), now - timedelta(days=random.choice([0, 1, 3, 9, 20]), seconds=random.randrange(3)))
            got[row] = row
        arrived = list(got)
        staged += arrived
        merge_arrivals(spark, database, spec, spark.createDataFrame(arrived, spec.schema), as_of)
        recent = [r for r in staged if r[3].date() >= as_of - timedelta(spec.recent_days)]
        for key in {r[0] for r in arrived if r[3].date() >= as_of - timedelta(spec.recent_days)}:
            final[key] = max((r for r in recent if r[0] == key), key=lambda r: (r[3], r[2], r[1] or date.min))
        if cleanup:
            final = {k: r for k, r in final.items() if r[1] is None or as_of - timedelta(30) <= r[1] <= as_of + timedelta(60)}
        found = sorted((r["record_key"], r["d"], r["n"]) for r in read_final(spark, database, spec).collect())
        assert [tuple(map(str, r)) for r in found] == [tuple(map(str, r[:3])) for _, r in sorted(final.items())], step


def test_a_reader_finishes_while_states_are_published(spark, database):
    spec = replace(MANY, buckets=2, keep_states=3)
    create_tables(spark, database, spec)
    publish(spark, database, spec, rows_of(spark, ("a", 0, 1, 1), ("b", 0, 1, 1)))
    reader = read_final(spark, database, spec)
    for n in (2, 3):
        merge_arrivals(spark, database, spec, rows_of(spark, ("a", 0, n, 0)), TODAY)
    assert sorted((r["record_key"], r["n"]) for r in reader.collect()) == [("a", 1), ("b", 1)]
    assert final_rows(spark, database, spec) == [("a", 3), ("b", 1)]
    merge_arrivals(spark, database, spec, rows_of(spark, ("a", 0, 4, 0)), TODAY)
    assert len(current_state(spark, database, spec).kept) == 3
    assert len({p["state"] for p in partitions_of(spark, states.states_name(database, spec))}) == 3


def test_a_job_that_dies_before_the_switch_leaves_the_old_state(spark, database, monkeypatch):
    create_tables(spark, database, SPEC)
    publish(spark, database, SPEC, rows_of(spark, ("a", 0, 1, 1)))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(states, "show", dies)
        with pytest.raises(OSError):
            merge_arrivals(spark, database, SPEC, rows_of(spark, ("a", 0, 2, 0)), TODAY)
    assert final_rows(spark, database) == [("a", 1)]
    assert sweep_final(spark, database, SPEC) == 0  # it may still be at work
    assert sweep_final(spark, database, replace(SPEC, orphan_age=timedelta(0))) == 2
    assert final_rows(spark, database) == [("a", 1)]
    assert len({p[VERSION] for p in partitions_of(spark, data_name(database, SPEC))}) == 1


def staged_days(spark, database, *parts):
    """A batch per list of days."""
    create_tables(spark, database, SPEC)
    for number, (age, days) in enumerate(parts):
        rows = batch(spark, *[(f"k{i}", d, i) for i, d in enumerate(days)])
        append_batch(spark, database, SPEC, prepared(rows, SPEC, NOW - timedelta(days=age)), f"part {number}")


def test_the_newest_batch_is_found_without_opening_settled_ones(spark, database, monkeypatch):
    staged_days(spark, database, (9, [0, 3]), (5, [1, None]), (3, [-40, 2]), (2, [90]), (1, [-31, 61]))
    wanted = newest_stamp(read_staging(spark, database, SPEC), SPEC, TODAY)
    opened = []
    look = tables.of_batches
    monkeypatch.setattr(tables, "of_batches", lambda s, d, p, w: opened.append(sorted(b.batch_id for b in w)) or look(s, d, p, w))
    assert newest_staged(spark, database, SPEC, TODAY) == wanted
    # Whole batches need no look, nor those wholly outside; only mixed ones newer than the newest whole one.
    assert opened == [["part 2", "part 4"]]
    plan = look(spark, database, SPEC, [b for b in batches(spark, database, SPEC) if b.batch_id == "part 2"])
    assert len({f.rsplit("/", 1)[0] for f in plan.inputFiles()}) == 1


def test_a_trim_opens_mixed_batches_only(spark, database, monkeypatch):
    staged_days(spark, database, (9, [0, 3]), (3, [-40, 2, None]), (2, [90]))
    kept = [f for f in read_staging(spark, database, SPEC).inputFiles() if "part%200" in f or "part 0" in f]
    opened = []
    look = tables.of_batches
    monkeypatch.setattr(tables, "of_batches", lambda s, d, p, w: opened.append([b.batch_id for b in w]) or look(s, d, p, w))
    assert trim_staging(spark, database, SPEC, TODAY) == 2
    assert opened == [["part 1"]]
    monkeypatch.undo()
    assert set(kept) <= set(read_staging(spark, database, SPEC).inputFiles())
    assert {b.batch_id: b.rows for b in batches(spark, database, SPEC)} == {"part 0": 2, "part 1": 2}


def test_a_trim_that_dies_leaves_every_row_once(spark, database, monkeypatch):
    staged_days(spark, database, (3, [-40, 2, None]), (2, [90]), (1, [0]))
    before = sorted(map(str, read_staging(spark, database, SPEC).collect()))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "note", dies)
        with pytest.raises(OSError):
            trim_staging(spark, database, SPEC, TODAY)
    assert sorted(map(str, read_staging(spark, database, SPEC).collect())) == before
    assert trim_staging(spark, database, SPEC, TODAY) == 2
    assert read_staging(spark, database, SPEC).count() == 3
    tables.sweep_staging(spark, database, replace(SPEC, orphan_age=timedelta(0)))
    assert len(partitions_of(spark, tables.staging_name(database, SPEC))) == 2
    assert read_staging(spark, database, SPEC).count() == 3


def test_micro_batches_read_no_staging_but_their_own(spark, database, monkeypatch):
    staged_days(spark, database, (9, [0, 3]), (3, [1, 2]))
    opened = []
    look = incremental.of_batches
    monkeypatch.setattr(incremental, "of_batches", lambda s, d, p, w: opened.append([b.batch_id for b in w]) or look(s, d, p, w))
    late = rows_of(spark, ("k0", 0, 5, 1), ("z", 0, 1, 40))
    incremental.apply_arrivals(late, "own", database, SPEC, TODAY)
    assert opened == [["own"]]
    assert final_rows(spark, database) == [("k0", 5)]
