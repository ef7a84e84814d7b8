"""Tables, loads, runs and micro-batches."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone
from random import Random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dockside.functions.dates import date_window
from dockside.operators.filters import recent_batches
from dockside.operators.latest import latest_per_key
from dockside.operators.retention import delete_out_of_window, delete_stale
from dockside.operators.upsert import upsert
from dockside.plans.datasets import DatasetSpec, breakout_spec, default_datasets, extract, inbound_spec
from dockside.plans.misfits import MisfitError, rejected_name
from dockside.plans.refresh import load_batch, next_final, prepared
from dockside.plans.runs import create_all, run
from dockside.schemas import BREAKOUT_SCHEMA, INBOUND_SCHEMA, table_schema
from dockside.session import SCRATCH_DATABASE, scratch_path
from dockside.sinks.states import current_state, partitions_of
from dockside.sinks.tables import (
    append_batch,
    create_tables,
    publish,
    read_final,
    read_staging,
    trim_staging,
)
from dockside.streaming.incremental import upsert_stream

TODAY = date(2024, 1, 30)
NOW = datetime(2024, 1, 30, 2, tzinfo=timezone.utc)

SPEC = DatasetSpec(
    name="small",
    staging_table="small_staging",
    final_table="small_final",
    schema=table_schema("record_key string, d date, n bigint, load_timestamp timestamp"),
    date_column="d",
    newest_first=("load_timestamp", "n"),
)


def batch(spark, *rows):
    """Rows of (key, days from today or None, n)."""
    dated = [(k, None if offset is None else TODAY + timedelta(offset), n) for k, offset, n in rows]
    return spark.createDataFrame(dated, "record_key string, d date, n bigint")


def final_rows(spark, database, spec=SPEC):
    return sorted(((r["record_key"], r["n"]) for r in read_final(spark, database, spec).collect()), key=str)


def staged_count(spark, database, spec=SPEC):
    return read_staging(spark, database, spec).count()


def load(spark, database, rows, day=0, spec=SPEC, **more):
    when = NOW + timedelta(day)
    return load_batch(spark, database, spec, rows, TODAY + timedelta(day), when, **more)


def test_declared_schemas():
    assert len(INBOUND_SCHEMA.fields) == 23 and len(BREAKOUT_SCHEMA.fields) == 53
    assert len(inbound_spec().columns_of(type(INBOUND_SCHEMA["po"].dataType))) == 12


def test_tables_are_created_once_and_empty(spark, database):
    made = create_all(spark, database)
    assert len(made) == 4 and create_all(spark, database) == []
    for spec in default_datasets().values():
        final = read_final(spark, database, spec)
        assert final.columns == spec.schema.names and final.isEmpty()
        assert [f.dataType for f in final.schema] == [f.dataType for f in spec.schema]


def test_a_repeated_batch_replaces_itself(spark, database):
    create_tables(spark, database, SPEC)
    rows = prepared(batch(spark, ("a", 0, 1), ("b", 1, 2)), SPEC, NOW)
    assert append_batch(spark, database, SPEC, rows, "one") == 2
    assert append_batch(spark, database, SPEC, rows, "one") == 2
    assert staged_count(spark, database) == 2
    assert append_batch(spark, database, SPEC, rows, "two") == 2
    assert staged_count(spark, database) == 4


def test_rows_without_a_load_time_are_refused(spark, database):
    create_tables(spark, database, SPEC)
    rows = spark.createDataFrame([("a", TODAY, 1, NOW), ("b", TODAY, 1, None)], SPEC.schema)
    with pytest.raises(PySparkException, match="needs a load time"):
        append_batch(spark, database, SPEC, rows, "one")
    assert staged_count(spark, database) == 0


def test_publishing_keeps_one_state_back(spark, database):
    create_tables(spark, database, SPEC)
    names = [publish(spark, database, SPEC, prepared(batch(spark, ("a", 0, n)), SPEC, NOW)) for n in range(3)]
    assert final_rows(spark, database) == [("a", 2)]
    assert current_state(spark, database, SPEC).kept == (names[2], names[1])
    assert len({p["version"] for p in partitions_of(spark, f"{database}.{SPEC.final_table}__buckets")}) == 2


def test_a_failed_state_leaves_the_old_one(spark, database):
    load(spark, database, batch(spark, ("a", 0, 1)))
    broken = read_final(spark, database, SPEC).withColumn("n", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(PySparkException):
        publish(spark, database, SPEC, broken)
    assert final_rows(spark, database) == [("a", 1)]


def test_trimming_rewrites_and_drops_partitions(spark, database):
    create_tables(spark, database, SPEC)
    for name, rows in {
        "mixed": batch(spark, ("a", -31, 1), ("b", -30, 2), ("c", None, 3)),
        "old": batch(spark, ("d", -40, 4), ("e", 61, 5)),
        "good": batch(spark, ("f", 60, 6)),
    }.items():
        append_batch(spark, database, SPEC, prepared(rows, SPEC, NOW), name)
    assert trim_staging(spark, database, replace(SPEC, orphan_age=timedelta(0)), TODAY) == 3
    left = read_staging(spark, database, SPEC).collect()
    assert sorted(r["record_key"] for r in left) == ["b", "c", "f"]
    assert spark.sql(f"SHOW PARTITIONS {database}.{SPEC.staging_table}").count() == 2


def test_newer_batches_win_and_gone_rows_go(spark, database):
    assert load(spark, database, batch(spark, ("a", 0, 1), ("b", 0, 1))) == 2
    load(spark, database, batch(spark, ("b", 0, 2), ("c", 0, 2)), day=1)
    assert final_rows(spark, database) == [("b", 2), ("c", 2)]
    assert staged_count(spark, database) == 4


def test_without_stale_removal_old_rows_stay(spark, database):
    spec = replace(SPEC, cleanup_stale=False)
    load(spark, database, batch(spark, ("a", 0, 1), ("b", 0, 1)), spec=spec)
    load(spark, database, batch(spark, ("b", 0, 2), ("c", 0, 2)), day=1, spec=spec)
    assert final_rows(spark, database) == [("a", 1), ("b", 2), ("c", 2)]


def test_the_same_load_twice(spark, database):
    rows = batch(spark, ("a", 0, 1), ("a", 0, 3), ("b", None, 2), ("old", -31, 9), (None, 0, 4), ("None", 0, 5))
    load(spark, database, rows)
    first = final_rows(spark, database)
    load(spark, database, rows)
    assert final_rows(spark, database) == first == [("", 5), ("a", 3), ("b", 2)]


def test_toggles(spark, database):
    spec = replace(SPEC, cleanup_staging=False, cleanup_final=False, cleanup_stale=False)
    load(spark, database, batch(spark, ("old", -31, 9)), spec=spec)
    assert final_rows(spark, database) == [("old", 9)] and staged_count(spark, database) == 1


def test_append_only(spark, database):
    assert load(spark, database, batch(spark, ("a", 0, 1), ("old", -99, 1)), use_merge=False) == 2
    assert staged_count(spark, database) == 2 and final_rows(spark, database) == []


def test_an_empty_batch_changes_nothing(spark, database):
    load(spark, database, batch(spark, ("a", 0, 1)))
    assert load(spark, database, batch(spark, ("a", 0, 1)).limit(0), day=1) == 0
    assert final_rows(spark, database) == [("a", 1)] and staged_count(spark, database) == 1


def test_backfill_outside_the_window(spark, database):
    load(spark, database, batch(spark, ("a", 0, 1)))
    # Every row of the backfill leaves staging again, so nothing counts as stale.
    load(spark, database, batch(spark, ("x", -90, 1)), day=1)
    assert final_rows(spark, database) == [("a", 1)] and staged_count(spark, database) == 1
    # A backfill inside the window is the newest batch: the rest is stale.
    load(spark, database, batch(spark, ("y", -3, 1)), day=2)
    assert final_rows(spark, database) == [("y", 1)]


def test_batches_older_than_the_recency_limit_are_not_merged(spark, database):
    spec = replace(SPEC, cleanup_stale=False)
    load(spark, database, batch(spark, ("a", 10, 1)), spec=spec, use_merge=False)
    load(spark, database, batch(spark, ("b", 10, 1)), day=15, spec=spec)
    assert final_rows(spark, database) == [("b", 1)]


def test_a_fraction_fails_the_load(spark, database):
    load(spark, database, batch(spark, ("a", 0, 1)))
    bad = spark.createDataFrame([("b", TODAY, "1.5")], "record_key string, d date, n string")
    with pytest.raises(PySparkException, match="n: not a whole number"):
        load(spark, database, bad, day=1)
    assert final_rows(spark, database) == [("a", 1)] and staged_count(spark, database) == 1


def test_misfits_are_counted_and_their_rows_kept(spark, database):
    spec = replace(SPEC, schema=table_schema("record_key string, d date, n bigint, m bigint, load_timestamp timestamp"))
    load(spark, database, batch(spark, ("a", 0, 1)), spec=spec)
    raw = spark.createDataFrame(
        [("b", "1", 2.0), ("c", "1.5", 2.5), ("d", "x", float("inf")), ("e", None, None), ("f", "1e30", 3.0)],
        "record_key string, n string, m double",
    ).withColumn("d", F.lit(TODAY))
    for _ in range(2):  # the same batch again replaces its rejected rows
        notes = {}
        with pytest.raises(MisfitError) as refused:
            load(spark, database, raw, 1, spec, notes=notes)
        assert refused.value.counts == notes["violations"] == {"m": 2, "n": 2}
        kept = spark.table(rejected_name(database, spec)).collect()
        found = {json.loads(r["raw"])["record_key"]: sorted(r["columns"]) for r in kept}
        assert len(kept) == 3 and found == {"c": ["m", "n"], "d": ["m"], "f": ["n"]}
    assert final_rows(spark, database, spec) == [("a", 1)] and staged_count(spark, database, spec) == 1
    load(spark, database, raw.where("record_key IN ('b', 'e')"), 1, spec)
    assert final_rows(spark, database, spec) == [("b", 1), ("e", 0)]
    assert load(spark, database, raw.limit(0), 2, spec) == 0


def test_a_run_reports_misfits(spark, database):
    broken = lambda spark, day: batch(spark, ("a", 0, 1)).withColumn("n", F.lit(0.5))
    report = run(spark, database, None, TODAY, datasets={"small": replace(SPEC, sample=broken)}, samples=True)
    assert report["status"] == "error" and report["results"]["small"]["violations"] == {"n": 1}


def test_raw_text_is_typed_and_keyed(spark, database):
    spec = inbound_spec()
    raw = spark.createDataFrame(
        [("P1", "S1", "20240201", "5.0", None), (None, "S1", "x", "", "None")],
        "po string, sku string, expected_date string, ooqty string, vendor string",
    )
    rows = prepared(raw, spec, NOW).orderBy("ooqty").collect()
    assert [r["record_key"] for r in rows] == ["_S1_NULL", "P1_S1_20240201"]
    assert [(r["ooqty"], r["vendor"], r["expected_date"]) for r in rows] == [(0, "", None), (5, "", date(2024, 2, 1))]


def test_sample_run(spark, database):
    report = run(spark, database, None, TODAY, samples=True, stamp=NOW)
    assert report["status"] == "success" and report["start_date"] == "2023-12-31" and report["end_date"] == "2024-03-30"
    assert {n: r["rows_loaded"] for n, r in report["results"].items()} == {"po": 3, "breakout": 3}
    keys = [r["record_key"] for r in read_final(spark, database, breakout_spec()).orderBy("record_key").collect()]
    assert keys == ["A-7000_lamp-05_20240202", "B-7000_rug-11_20240204", "C-7000_chair-2_20240207"]
    first = read_final(spark, database, breakout_spec()).orderBy("record_key").first()
    assert (first["SD"], first["FFC"], first["IP_WEB"], first["parent_stores"]) == (32, 0, 0, "22, 110")


def test_run_over_sources(spark, database, tables):
    src = tables(
        pohdr=[
            ("A", "M1", "O", 110, TODAY, TODAY, TODAY),
            ("c", "M1", "O", 6, TODAY, TODAY, TODAY),
        ],
        potype=[("A", "P"), ("c", "C")],
        podtl=[("A", "k1", 10, 4), ("c", "k1", 3, 0)],
    )
    create_all(spark, database)
    extract(inbound_spec(), src, date_window(TODAY))
    before = len(spark.catalog.listTables(SCRATCH_DATABASE))
    report = run(spark, database, src, TODAY, stamp=NOW)
    assert report["status"] == "success"
    assert len(spark.catalog.listTables(SCRATCH_DATABASE)) == before
    row = read_final(spark, database, inbound_spec()).first()
    assert (row["store"], row["breakoutqty"], row["shipped_sku"], row["record_key"]) == ("110", 3, "", "A_k1_20240130")
    pivot = read_final(spark, database, breakout_spec()).first()
    assert (pivot["DS"], pivot["SH"], pivot["record_key"]) == (3, 0, "M1_k1_20240130")
    empty = run(spark, database, src, TODAY, rolling=False, stamp=NOW + timedelta(1))
    assert empty["start_date"] == empty["end_date"] == "2024-01-29"
    assert {r["status"] for r in empty["results"].values()} == {"no_data"} and empty["status"] == "success"
    assert read_final(spark, database, inbound_spec()).count() == 1


def failing(spec):
    def broken(src, window):
        raise RuntimeError("source is down")

    return replace(spec, query=broken)


def test_run_status(spark, database, tables):
    src = tables()
    both = default_datasets()
    one = {**both, "po": failing(both["po"])}
    report = run(spark, database, src, TODAY, datasets=one, stamp=NOW)
    assert report["status"] == "partial_failure" and report["results"]["po"]["error"] == "source is down"
    none = {name: failing(spec) for name, spec in both.items()}
    assert run(spark, database, src, TODAY, datasets=none, stamp=NOW)["status"] == "error"
    assert run(spark, database, src, TODAY, names=["po"], datasets=one, stamp=NOW)["status"] == "error"
    for names in (["nope"], []):
        with pytest.raises(ValueError):
            run(spark, database, src, TODAY, names=names)


def test_a_further_dataset(spark, database, tables):
    spec = replace(SPEC, query=lambda src, window: batch(spark, ("a", 0, 1)), record_key=None)
    report = run(spark, database, tables(), TODAY, datasets={"small": spec}, stamp=NOW)
    assert report["results"]["small"]["rows_loaded"] == 1 and final_rows(spark, database) == [("a", 1)]


def stamped(spark, *rows):
    """Rows of (key, days from today, n, load hours before now)."""
    data = [(k, TODAY + timedelta(o), n, NOW - timedelta(hours=h)) for k, o, n, h in rows]
    return spark.createDataFrame(data, SPEC.schema)


def test_micro_batches_end_where_one_batch_does(spark, database):
    landing, progress = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    arrivals = [
        stamped(spark, ("a", 0, 1, 9), ("b", 0, 1, 9), ("w", 0, 1, 9)),
        stamped(spark, ("a", 0, 3, 1), ("w", 70, 2, 8), ("old", 0, 1, 24 * 20)),
        stamped(spark, ("a", 0, 2, 5), ("c", 0, 1, 5), (None, 0, 8, 3)),
    ]
    for arrival in arrivals:
        arrival.coalesce(1).write.mode("append").parquet(landing)
    stream = lambda: upsert_stream(
        spark, database, SPEC, landing, progress, TODAY, files_per_batch=1
    ).awaitTermination()
    stream()
    expected = [("", 8), ("a", 3), ("b", 1), ("c", 1)]
    assert final_rows(spark, database) == expected
    # A late row of an older batch does not replace a newer one.
    stamped(spark, ("a", 0, 9, 7), ("d", 0, 1, 7)).write.mode("append").parquet(landing)
    stream()
    assert final_rows(spark, database) == sorted(expected + [("d", 1)], key=str)
    # Worked through again from the start, the same batches change nothing.
    progress = scratch_path(spark, "progress")
    stream()
    assert final_rows(spark, database) == sorted(expected + [("d", 1)], key=str)


def step_by_step(final, staging, spec):
    """The same state, one step after the other as the steps are defined."""
    latest = latest_per_key(
        recent_batches(staging, TODAY, spec.recent_days).select(*spec.schema.names), "record_key", spec.newest_first
    )
    rows = upsert(final, latest, "record_key")
    left = delete_out_of_window(staging, "d", TODAY) if spec.cleanup_staging else staging
    if spec.cleanup_final:
        rows = delete_out_of_window(rows, "d", TODAY)
    return delete_stale(rows, left) if spec.cleanup_stale else rows


@pytest.mark.parametrize("seed", range(6))
def test_next_state_equals_the_steps(spark, seed):
    random = Random(seed)
    days = [-31, -30, 0, 5, 60, 61, None]

    def rows(count, keys, oldest, newest):
        return [
            (
                random.choice(keys),
                None if (day := random.choice(days)) is None else TODAY + timedelta(day),
                random.randrange(3),
                NOW - timedelta(days=random.randint(newest, oldest)),
            )
            for _ in range(count)
        ]

    staged = rows(40, "abcdefgh", 16, seed % 3)
    if seed % 2:
        # The newest batch lies outside the window and leaves staging again.
        staged += [(k, TODAY + timedelta(90), 1, NOW) for k in "abc"]
    staging = spark.createDataFrame(staged, SPEC.schema).withColumn("load_date", F.to_date("load_timestamp"))
    old = {key: (key, *rest) for key, *rest in rows(12, "defghxyz", 3, 0)}
    final = spark.createDataFrame([*old.values(), ("w", TODAY, 1, None)], SPEC.schema)
    for spec in (
        SPEC,
        replace(SPEC, cleanup_staging=False),
        replace(SPEC, cleanup_final=False),
        replace(SPEC, cleanup_stale=False),
    ):
        for state in (staging, staging.limit(0)):
            got = next_final(final, state, spec, TODAY).collect()
            assert sorted(map(str, got)) == sorted(map(str, step_by_step(final, state, spec).collect()))
