"""Physical plans: what is pushed, what is split, what must not appear."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from dockside_checks.fixtures import EVENTS, EVENTS_AS_OF, RULES, WINDOW, sources, staging
from dockside_checks.queries import QUERIES
from dockside.operators.filters import recent_batches
from dockside.operators.joins import JoinBudget, attach, in_reach, keep_matching, narrow, once, sized
from dockside.operators.latest import latest_per_key
from dockside.operators.retention import delete_stale
from dockside.operators.upsert import upsert
from dockside.plans import po_inbound as inb
from dockside.plans.refresh import next_final
from dockside.session import cluster_settings, tune
from dockside.sinks.tables import append_batch, create_tables, read_staging

SF = "/root/testdata/sf0.001"


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    values = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_window_filter_reaches_the_scan(spark):
    plan = plan_of(inb.tracked_headers(sources(spark, SF).pohdr, WINDOW, RULES))
    assert "GreaterThanOrEqual(o_orderdate,1997-07-01" in plan and "o_totalprice" not in plan


def test_old_batches_are_not_read(spark, database):
    create_tables(spark, database, EVENTS)
    append_batch(spark, database, EVENTS, staging(spark, SF), "all")
    rows = read_staging(spark, database, EVENTS, with_load_day=True)
    plan = plan_of(recent_batches(rows, EVENTS_AS_OF))
    assert "PartitionFilters: [isnotnull(load_date" in plan and "(load_date#" in plan
    stale = plan_of(delete_stale(rows, rows))
    assert "GreaterThanOrEqual(load_timestamp,ScalarSubquery" in stale


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    plan = plan_of(latest_per_key(staging(spark, SF), "record_key", EVENTS.newest_first))
    shuffle = plan.index("Exchange hashpartitioning(record_key")
    assert "WindowGroupLimit" in plan[:shuffle] and "Partial" in plan[shuffle:]


def test_the_size_of_a_side_decides_its_join(spark):
    src = sources(spark, SF)
    whole, keys, none = (sized(src.pohdr, budget=JoinBudget(limit)) for limit in (10_000_000, 100_000, 1000))
    assert (whole.small(), keys.small(), keys.small("po"), none.small("po")) == (True, False, True, False)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plans = [plan_of(attach(src.podtl, side, "po")) for side in (whole, keys, none)]
        assert ["SortMergeJoin" in p for p in plans] == [False, True, True]
        assert ["BroadcastHashJoin" in p for p in plans] == [True, True, False]
    assert narrow(src.podtl, none, "po") is src.podtl


def test_types_meet_measured_headers_without_a_shuffle(spark):
    src = sources(spark, SF)
    headers = once(inb.tracked_headers(src.pohdr, WINDOW, RULES), "headers", "po")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        typed = inb.typed_headers(headers, src.potype, RULES.inbound_types)
        plan = plan_of(typed)
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert "GreaterThanOrEqual(o_orderkey" in plan
        plain = inb.typed_headers(headers.rows, src.potype, RULES.inbound_types)
        assert "hashpartitioning" in plan_of(plain)
    assert sorted(typed.select("po", "type").collect()) == sorted(plain.select("po", "type").collect())


def test_the_range_of_the_keys_reaches_the_scan(spark):
    src = sources(spark, SF)
    for limit in (10_000_000, 0):
        side = sized(src.pohdr.where("po BETWEEN 100 AND 120"), "po", budget=JoinBudget(limit))
        for join in (attach, narrow, keep_matching):
            plan = plan_of(join(src.podtl, side, "po"))
            assert "GreaterThanOrEqual(l_orderkey,100)" in plan and "LessThanOrEqual(l_orderkey,120)" in plan
    empty = sized(src.pohdr.limit(0), "po")
    assert "FileScan" not in plan_of(in_reach(src.podtl, "po", empty))
    assert in_reach(src.podtl, "po", sized(src.pohdr)) is src.podtl
    both = in_reach(src.podtl, "po", empty, side)
    assert "GreaterThanOrEqual(l_orderkey,100)" in plan_of(both)


def test_measured_size_counts_rows_and_text(spark):
    side = sized(spark.createDataFrame([("abc", 1), ("abcdef", 1), (None, 2), ("é", 3)], "s string, n int"))
    assert (side.count, side.text_bytes) == (4, {"s": 11})
    assert side.bytes_of("s", "n") - side.bytes_of("n") == 4 * 8 + 11
    empty = sized(spark.createDataFrame([], "s string"))
    assert (empty.count, empty.text_bytes) == (0, {"s": 0})


def test_a_hot_order_is_split(spark):
    """One order holds a third of all details and no side can be broadcast."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    details = spark.range(0, 300_000, 1, 16).select(
        hot.alias("po"), (F.col("id") % 1000).alias("sku"), F.lit(1).alias("oounit"), F.lit(0).alias("rcunit")
    )
    orders = spark.range(5000).select(
        F.col("id").alias("po"), F.lit("O").alias("pocode"), F.lit(date(2024, 1, 1)).alias("latest_datercv")
    )
    known = spark.range(1000).select(F.col("id").alias("sku"), F.lit("x").alias("style"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    ):
        lines = inb.order_lines(orders, details, known)
        rows = lines.agg(F.sum("ooqty"), F.count(F.lit(1)))
        assert tuple(rows.collect()[0]) == (300_000, details.select("po", "sku").distinct().count())
        assert "SortMergeJoin(skew=true)" in plan_of(rows)


@pytest.mark.parametrize("name", ["po_inbound_dedup", "breakout_pivot", "mrg_upsert", "del_stale", "typ_int_coerce"])
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
        assert word not in plan


def test_a_filter_on_the_type_turns_the_outer_join_inner(spark):
    plan = plan_of(QUERIES["fil_outer_to_inner"](spark, SF))
    assert "Inner" in plan and "LeftOuter" not in plan


def test_top_dates_are_not_sorted_in_full(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["topk_recent_dates"](spark, SF))


def test_cluster_sizes_grow_with_the_cores():
    assert cluster_settings(8000)["spark.sql.shuffle.partitions"] == "64000"
    assert cluster_settings(4)["spark.sql.shuffle.partitions"] == "200"


def test_what_the_caller_set_stays(spark):
    with settings(spark, spark__sql__adaptive__forceOptimizeSkewedJoin="false"):
        tune(spark)
        assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"


def test_a_nightly_run_reads_the_newest_batch(spark, database):
    create_tables(spark, database, EVENTS)
    append_batch(spark, database, EVENTS, staging(spark, SF), "all")
    rows = read_staging(spark, database, EVENTS, with_load_day=True)
    plan = plan_of(next_final(rows.limit(0).select(*EVENTS.schema.names), rows, EVENTS, EVENTS_AS_OF))
    assert plan.count("FileScan") == 1 and "(load_date#" in plan and ">= 2024-01-30)" in plan
    assert "Join" not in plan


def test_rows_without_a_key_are_spread(spark):
    rows = staging(spark, SF).drop("load_date")
    plan = plan_of(upsert(rows, rows, "record_key"))
    assert plan.count("Exchange hashpartitioning(record_key") == 2 and plan.count(", _spread#") >= 4
    hashed = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("_spread#" in line for line in hashed)
