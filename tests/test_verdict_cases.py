"""Cases that earlier rounds got wrong."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

import dockside.plans.refresh as refresh
from dockside.plans.datasets import KEY, breakout_spec
from dockside.plans.po_inbound import child_units, with_child_types
from dockside.plans.runs import run
from dockside.rules import OrderRules
from dockside.session import scratch_path
from dockside.sinks.tables import read_final, read_staging
from dockside.sources.samples import breakout_sample
from dockside.streaming.incremental import upsert_stream

TODAY = date(2024, 1, 30)
NOW = datetime(2024, 1, 30, 2, tzinfo=timezone.utc)


def test_arriving_rows_without_a_key_get_one(spark, database):
    spec = breakout_spec()
    rows = breakout_sample(spark, TODAY).withColumn("load_timestamp", F.lit(NOW))
    late = rows.withColumn("exp_date", F.date_add("exp_date", 400)).drop(KEY)
    old = late.withColumn("load_timestamp", F.lit(datetime(2023, 12, 1, 2, tzinfo=timezone.utc)))
    landing = scratch_path(spark, "landing")
    rows.drop(KEY).unionByName(late).unionByName(old).write.parquet(landing)
    upsert_stream(spark, database, spec, landing, scratch_path(spark, "progress"), TODAY).awaitTermination()
    keys = sorted(r[KEY] for r in read_final(spark, database, spec).collect())
    assert keys == ["A-7000_lamp-05_20240202", "B-7000_rug-11_20240204", "C-7000_chair-2_20240207"]
    # Rows outside the window have left staging where their batch is no longer recent.
    assert read_staging(spark, database, spec).count() == 6


def test_missing_units_next_to_another_type_sum_to_zero(spark):
    headers = spark.createDataFrame([("A", "M"), ("B", "N")], "po string, po_man string")
    types = spark.createDataFrame([("A", "C"), ("A", "P"), ("B", "C")], "po string, type string")
    details = spark.createDataFrame([("A", "k", None), ("B", "k", None)], "po string, sku string, oounit long")
    typed = with_child_types(headers, types, OrderRules())
    assert {r["po_man"]: r["ooqty"] for r in child_units(typed, details).collect()} == {"M": 0, "N": None}


def test_a_failed_trim_leaves_the_load_standing(spark, database, monkeypatch):
    def fails(*_):
        raise OSError("no space")

    monkeypatch.setattr(refresh, "trim_staging", fails)
    report = run(spark, database, None, TODAY, samples=True, stamp=NOW, names=["breakout"])
    assert report["status"] == "success"
    assert report["results"]["breakout"]["cleanup"] == "failed: no space"
    assert read_final(spark, database, breakout_spec()).count() == 3
