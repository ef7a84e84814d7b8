"""The two views on hand-made tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from dockside.functions.dates import DateWindow
from dockside.operators.joins import JoinBudget
from dockside.plans import breakout as br
from dockside.plans import po_inbound as inb
from dockside.rules import STORE_COLUMNS, OrderRules

WINDOW = DateWindow(date(2024, 1, 1), date(2024, 1, 31))
DUE, CANCEL, SHIP = date(2024, 1, 20), date(2024, 2, 20), date(2024, 1, 15)


def header(po, manager="M1", code="O", store=110, due=DUE, ship=SHIP):
    return (po, manager, code, store, due, CANCEL, ship)


def inbound(src, **more):
    return inb.po_inbound_sorted(src, WINDOW, **more).collect()


def test_one_plain_order(tables):
    src = tables(
        purhst=[("A", 110, date(2024, 1, 3)), ("A", 114, date(2024, 1, 5)), ("A", 7, date(2024, 1, 9))],
        invdtl=[("A", "k1", 3), ("A", "k1", 4), ("B", "k1", 50)],
    )
    (row,) = inbound(src)
    assert row.asDict() == {
        "store": 110,
        "vendor": "ACME",
        "ss": "s1",
        "type": "P",
        "po_code": "O",
        "po": "A",
        "po_man": "M1",
        "sku": "k1",
        "style": "st",
        "skudesc1": "desc",
        "expected_date": DUE,
        "cancel_date": CANCEL,
        "ooqty": 10,
        "rcvdqty": 4,
        "breakoutqty": 0,
        "allocated": 0,
        "unitinvc_per_sku": 7,
        "shipped_sku": None,
        "shipped_qty": 0,
        "latest_datercv": date(2024, 1, 5),
        "shipnotice_date": None,
        "record_key": "A_k1_20240120",
    }


def test_what_is_not_tracked(tables):
    src = tables(
        pohdr=[
            header("A"),
            header("store", store=7),
            header("code", code="X"),
            header("early", due=date(2023, 12, 31)),
            header("late", due=date(2024, 2, 1)),
            header("undated", due=None),
            header("child"),
            header("untyped"),
            header("first", due=date(2024, 1, 1)),
            header("last", due=date(2024, 1, 31)),
            header("return"),
        ],
        potype=[(po, "P") for po in ("A", "store", "code", "early", "late", "undated", "first", "last")]
        + [("child", "C"), ("return", "R")],
        podtl=[
            (po, "k1", 1, 0)
            for po in (
                "A", "store", "code", "early", "late", "undated", "child", "untyped", "first", "last", "return",
            )
        ]
        + [("A", "unknown item", 1, 0)],
    )
    assert [r["po"] for r in inbound(src)] == ["A", "first", "last", "return"]


def test_shipments_fan_out_and_dedup_keeps_the_newest(tables):
    src = tables(
        asnhdr=[(1, "A", 110, date(2024, 1, 8)), (2, "A", 110, date(2024, 1, 9)), (3, "A", 7, date(2024, 1, 10))],
        asndtl=[(1, "k1", 2), (1, "k1", 3), (2, "k1", 4), (3, "k1", 9), (1, "k2", 1)],
    )
    rows = inbound(src)
    shown = [(r["shipnotice_date"].day, r["shipped_qty"], r["shipped_sku"]) for r in rows]
    assert shown == [(8, 5, "k1"), (9, 4, "k1")]
    (kept,) = inb.po_inbound_dedup(src, WINDOW).collect()
    assert kept["shipped_qty"] == 4


def test_ship_date_splits_rows_it_does_not_show(tables):
    src = tables(pohdr=[header("A"), header("A", ship=date(2024, 1, 16))])
    rows = inbound(src)
    assert len(rows) == 2 and rows[0] == rows[1]


def test_repeated_items_repeat_their_units(tables):
    family = [header("A"), header("c1", due=date(2020, 1, 1))]
    more = {
        "pohdr": family,
        "potype": [("A", "P"), ("c1", "C")],
        "podtl": [("A", "k1", 10, 4), ("c1", "k1", 3, 0)],
        "asndtl": [(9, "k1", 6)],
        "wim": [(9, "c1")],
    }
    (once,) = inbound(tables(**more))
    assert (once["ooqty"], once["breakoutqty"], once["allocated"]) == (10, 3, 6)
    (twice,) = inbound(tables(skufile=[("k1", "st", "desc", "s1", 1)] * 2, **more))
    assert (twice["ooqty"], twice["breakoutqty"], twice["allocated"]) == (20, 6, 12)


def test_breakouts_and_allocations(tables):
    src = tables(
        pohdr=[header("A"), header("c1", due=date(2020, 1, 1)), header("c2", due=None), header("other", "M2")],
        potype=[("A", "P"), ("c1", "C"), ("c2", "C"), ("other", "C")],
        podtl=[("A", "k1", 10, 4), ("c1", "k1", 3, 0), ("c2", "k1", 2, 0), ("c2", "k2", 50, 0), ("other", "k1", 70, 0)],
        # Notice 9 has two history rows in the family, so its units count twice.
        wim=[(9, "c1"), (9, "A"), (8, "c2"), (7, "other")],
        asndtl=[(9, "k1", 6), (9, "k1", 1), (8, "k1", 5), (7, "k1", 100), (6, "k1", 100)],
    )
    row = next(r for r in inbound(src) if r["po"] == "A")
    assert (row["breakoutqty"], row["allocated"]) == (5, 19)


@pytest.mark.parametrize("manager", [None, "", "   "])
def test_blank_managers_have_no_family(tables, manager):
    src = tables(
        pohdr=[header("A", manager), header("c1", manager)],
        potype=[("A", "P"), ("c1", "C")],
        podtl=[("A", "k1", 10, 4), ("c1", "k1", 3, 0)],
        wim=[(9, "c1")],
        asndtl=[(9, "k1", 6)],
    )
    (row,) = inbound(src)
    assert (row["po_man"], row["breakoutqty"], row["allocated"]) == (manager, 0, 0)
    assert br.breakout(src, WINDOW).isEmpty()


def breakout_tables(tables, children, stores=(110,)):
    """Parents of M1 at the given stores, and children (po, store, units)."""
    parents = [header(f"P{s}", store=s) for s in stores]
    return tables(
        pohdr=parents + [header(po, store=store) for po, store, _ in children],
        potype=[(p[0], "P") for p in parents] + [(po, "C") for po, _, _ in children],
        podtl=[(p[0], "k1", 1, 0) for p in parents] + [(po, "k1", units, 0) for po, _, units in children],
    )


def test_a_cell_is_the_largest_child(tables):
    src = breakout_tables(tables, [("c1", 6, 5), ("c2", 6, 7), ("c3", 618, 2)])
    (row,) = br.breakout(src, WINDOW).collect()
    assert (row["DS"], row["Sidney_WEB"], row["SH"]) == (7, 2, 0)
    (summed,) = br.breakout(src, WINDOW, cell="sum").collect()
    assert summed["DS"] == 12


def test_unlisted_stores_leave_zeros(tables):
    (row,) = br.breakout(breakout_tables(tables, [("c1", 999, 5)]), WINDOW).collect()
    assert all(row[column] == 0 for _, column in STORE_COLUMNS)


def test_parent_stores_in_numeric_order(tables):
    rules = OrderRules(dc_stores=(22, 110, 9))
    src = breakout_tables(tables, [("c1", 6, 5)], stores=(110, 22, 9))
    (row,) = br.breakout(src, WINDOW, rules).collect()
    assert (row["parent_stores"], row["parent_exp_date"]) == ("9, 22, 110", DUE)
    parents = br.parent_orders(src, WINDOW, rules)
    listed = br.store_list(parents.union(parents), "po_man", "postr", "stores").collect()
    assert [r["stores"] for r in listed] == ["9, 22, 110"]


def test_parents_need_details_and_children_need_parents(tables):
    src = breakout_tables(tables, [("c1", 6, 5)])
    assert br.breakout(src, WINDOW).count() == 1
    bare = replace(src, podtl=src.podtl.where(F.col("po") != "P110"), child_dtl=src.podtl)
    assert br.breakout(bare, WINDOW).count() == 0
    late = DateWindow(date(2025, 1, 1), date(2025, 2, 1))
    assert br.breakout(src, late).count() == 0


def test_broadcast_and_shuffle_plans_agree(tables):
    days = [date(2024, 1, d) for d in (3, 12, 25)]
    orders = [f"o{i}" for i in range(40)]
    src = tables(
        pohdr=[
            header(po, (None, " ", "M1", "M2", "M3")[i % 5], "ODX"[i % 3], (110, 114, 6, 16)[i % 4], days[i % 3])
            for i, po in enumerate(orders)
        ],
        potype=[(po, "PRC"[i % 3]) for i, po in enumerate(orders) if i % 7],
        podtl=[(po, f"k{j % 3}", i + j, j) for i, po in enumerate(orders) for j in range(4)],
        purhst=[(po, (110, 6)[i % 2], days[i % 3]) for i, po in enumerate(orders)],
        invdtl=[(po, "k1", i) for i, po in enumerate(orders)] * 2,
        asnhdr=[(i, po, (110, 6)[i % 2], days[i % 3]) for i, po in enumerate(orders)]
        + [(100 + i, po, 110, days[(i + 1) % 3]) for i, po in enumerate(orders)],
        asndtl=[(i, f"k{i % 3}", i) for i in range(140)] * 2,
        wim=[(i, po) for i, po in enumerate(orders)] * 2,
    )
    for view in (inb.po_inbound, br.breakout):
        results = [
            sorted(map(str, view(src, WINDOW, budget=JoinBudget(limit)).collect())) for limit in (10**8, 700, 400, 0)
        ]
        assert results[0] and all(result == results[0] for result in results)
