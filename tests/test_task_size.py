"""A task's share of a shuffle is bounded, however few cores there are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dockside.plans import breakout as br
from dockside.plans import po_inbound as inb
from dockside.rules import OrderRules

ROWS = 1_000_000
STORES = OrderRules(store_columns=tuple((store, f"s{store}") for store in range(25)))


@pytest.fixture
def many_partitions(spark):
    """More shuffle partitions than cores, as on a cluster; AQE merges them."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "60")
    yield spark
    spark.conf.set(name, before)


def keyed(spark, **columns):
    """Rows whose keys are spread over all 64 bits, so that they stay their size when shuffled."""
    key = [F.xxhash64("id").alias("po_man"), F.xxhash64("id", F.lit(1)).alias("sku")]
    return spark.range(ROWS).select(*key, *[column.alias(name) for name, column in columns.items()])


def tasks_and_total(found, quantity):
    """Tasks that made the rows, and what they hold."""
    by_task = found.groupBy(F.spark_partition_id().alias("task")).agg(F.sum(quantity).alias("total")).collect()
    return len(by_task), sum(r["total"] for r in by_task)


def test_a_join_of_sums_is_dealt_to_small_tasks(many_partitions):
    """Some 40 MB of shuffled rows; four cores would take a quarter each."""
    children = keyed(many_partitions, ooqty=F.col("id") % 9)
    allocated = keyed(many_partitions, qty=F.col("id") % 7)
    found = inb.breakout_and_allocated(children, allocated)
    tasks, total = tasks_and_total(found, F.col("breakoutqty") + F.col("allocated"))
    assert total == sum(i % 9 + i % 7 for i in range(ROWS))
    assert tasks >= 8


def test_a_pivot_is_dealt_to_small_tasks(many_partitions):
    rows = keyed(many_partitions, dateexp=F.lit("1998-01-01").cast("date"), postr=F.col("id") % 25, oounit=F.col("id") % 9)
    found = br.store_pivot(rows, [F.col("po_man"), F.col("sku"), F.col("dateexp")], STORES)
    tasks, total = tasks_and_total(found, sum((F.col(f"s{store}") for store in range(25)), F.lit(0)))
    assert total == sum(i % 9 for i in range(ROWS))
    assert tasks >= 6
