"""Opening and naming of source tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from dockside.functions.dates import DateWindow
from dockside.plans import po_inbound as inb
from dockside.plans.breakout import parent_orders, parent_summary
from dockside.plans.datasets import extract, inbound_spec
from dockside.rules import OrderRules
from dockside.session import scratch_path
from dockside.sources.inputs import TABLE_COLUMNS, TableRef, jdbc_options, open_sources, open_table, run_sql
from dockside.sources.naming import BREAKOUT_NAMES, plain_names

WINDOW = DateWindow(date(2024, 1, 1), date(2024, 1, 31))


def test_special_names(spark):
    raw = spark.range(1).selectExpr("1 AS `PO#`", "2 AS `PO#MAN`", "3 AS `SKU#`", "4 AS STYLE", "5 AS `VEND#1`")
    assert plain_names(raw).columns == ["po", "po_man", "sku", "style", "vend"]
    report = spark.range(1).selectExpr("1 AS `PO#MAN`", "2 AS `SS#`", "3 AS SS", "4 AS `FFC WEB`", "5 AS SIDNEY")
    assert plain_names(report, BREAKOUT_NAMES).columns == ["po_man", "ss_num", "SS", "FFC_WEB", "Sidney"]


def test_files_and_catalog_tables(spark, tables, database):
    src = tables()
    expected = inb.po_inbound(src, WINDOW).collect()
    refs = {}
    for i, name in enumerate(TABLE_COLUMNS):
        rows = getattr(src, name)
        raw = rows.toDF(*[{"po": "PO#", "sku": "SKU#"}.get(c, c.upper()) for c in rows.columns])
        if i % 2:
            path = scratch_path(spark, "raw")
            raw.write.parquet(path)
            refs[name] = TableRef("parquet", path)
        else:
            raw.write.saveAsTable(f"{database}.{name}")
            refs[name] = TableRef("table", f"{database}.{name}")
    opened = open_sources(spark, refs)
    assert inb.po_inbound(opened, WINDOW).collect() == expected
    with pytest.raises(ValueError, match="unknown source"):
        open_sources(spark, {**refs, "other": refs["wim"]})
    with pytest.raises(ValueError, match="unknown kind"):
        open_table(spark, TableRef("cards", "x"))


def test_second_names(tables, spark):
    src = tables()
    assert src.family_hdr.columns == src.pohdr.columns
    other = replace(src, family_hdr=src.pohdr.limit(0))
    assert other.family_hdr.isEmpty() and not other.pohdr.isEmpty()


def test_split_reads():
    options = jdbc_options("jdbc:x:y", "d.Driver", '"PO#"', 1, 900, 32, user="u")
    assert options["partitionColumn"] == '"PO#"' and options["numPartitions"] == "32"
    assert options["upperBound"] == "900" and options["pushDownPredicate"] == "true" and options["user"] == "u"


def test_dates_are_bound_as_dates(spark):
    text = "SELECT d, :start_date AS s FROM {rows} WHERE d BETWEEN :start_date AND :end_date"
    rows = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 31)] + [(date(2024, 2, 1),), (None,)], "d date")
    got = run_sql(spark, text, WINDOW, rows=rows)
    assert dict(got.dtypes) == {"d": "date", "s": "date"} and got.count() == 2
    assert run_sql(spark, "SELECT count(*) AS n FROM {rows}", rows=rows).first()["n"] == 4


def test_extract_adds_a_missing_key(tables):
    spec = inbound_spec()
    bare = replace(spec, query=lambda src, window: spec.query(src, window).drop("record_key"))
    assert extract(bare, tables(), WINDOW).first()["record_key"] == "A_k1_20240120"


def test_stores_and_days_of_other_types(tables):
    headers = [
        (po, "M1", "O", store, date(2024, 1, 20), date(2024, 2, 20), date(2024, 1, 15))
        for po, store in (("A", 9), ("B", 22), ("C", 110))
    ]
    src = tables(pohdr=headers, potype=[(po, "P") for po in "ABC"], podtl=[(po, "k1", 10, 4) for po in "ABC"])
    text = src.pohdr.withColumns(
        {
            "postr": F.col("postr").cast("string"),
            "dateexp": F.timestamp_add("HOUR", F.lit(23), F.col("dateexp").cast("timestamp")),
            "datecanc": F.date_format("datecanc", "yyyyMMdd"),
            "dateship": F.lit("soon"),
        }
    )
    unreadable = text.where("po = 'A'").withColumns({"po": F.lit("D"), "postr": F.lit("HQ")})
    typed = replace(src, pohdr=text.unionByName(unreadable))
    assert dict(typed.pohdr.dtypes) == dict(src.pohdr.dtypes)
    rows = {r["po"]: r for r in typed.pohdr.collect()}
    assert [rows[po]["postr"] for po in "ABCD"] == [9, 22, 110, None]
    assert rows["A"]["dateexp"] == date(2024, 1, 20) and rows["A"]["datecanc"] == date(2024, 2, 20)
    assert rows["A"]["dateship"] is None
    last_day = DateWindow(date(2024, 1, 1), date(2024, 1, 20))
    rules = OrderRules(dc_stores=(9, 22, 110))
    summary = parent_summary(parent_orders(typed, last_day, rules)).first()
    assert summary["parent_stores"] == "9, 22, 110"
