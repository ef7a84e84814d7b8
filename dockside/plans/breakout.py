"""Breakout view: child orders of the tracked parents, pivoted over stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockside.functions.dates import DateWindow
from dockside.operators.filters import non_blank
from dockside.operators.joins import DEFAULT_BUDGET, JoinBudget, Sized, attach, narrow, once
from dockside.operators.reports import in_order
from dockside.plans.po_inbound import items, tracked_headers, typed_headers
from dockside.rules import OrderRules
from dockside.session import side_by_side
from dockside.sources.inputs import SourceTables

PARENT_COLUMNS = ("po", "po_man", "pocode", "type", "dateexp", "postr")


def with_details(orders: Sized, details: DataFrame) -> DataFrame:
    """Orders that have at least one detail row."""
    present = narrow(details.select("po"), orders, "po").distinct()
    return orders.rows.join(present, "po", "left_semi")


def parent_orders(
    src: SourceTables, window: DateWindow, rules: OrderRules, budget: JoinBudget = DEFAULT_BUDGET
) -> DataFrame:
    """Tracked orders of the parent type that name a managing order."""
    headers = tracked_headers(src.pohdr, window, rules).where(non_blank(F.col("po_man")))
    named = once(headers, "named", "po", budget=budget)
    typed = typed_headers(named, src.potype, (rules.parent_type,)).select(*PARENT_COLUMNS)
    return with_details(once(typed, "parents", "po", budget=budget), src.podtl)


def store_list(stores: DataFrame, group: str, store: str, name: str) -> DataFrame:
    """Distinct stores of each group as text, in numeric order."""
    return (
        stores.select(group, store)
        .distinct()
        .groupBy(group)
        .agg(F.expr(f"listagg(cast({store} as string), ', ') within group (order by {store})").alias(name))
    )


def parent_summary(parents: DataFrame) -> DataFrame:
    """Latest expected date and store list per managing order, in one grouping.

    The set of stores is bounded by the distribution-centre list that the
    parents were filtered with.
    """
    stores = F.array_sort(F.collect_set("postr"))
    return parents.groupBy("po_man").agg(
        F.max("dateexp").alias("parent_exp_date"),
        F.array_join(F.transform(stores, lambda s: s.cast("string")), ", ").alias("parent_stores"),
    )


CHILD_COLUMNS = ("po", "po_man", "postr", "dateship", "dateexp")


def managed_headers(headers: DataFrame) -> DataFrame:
    """Orders that name a managing order; no date limit."""
    return headers.where(non_blank(F.col("po_man"))).select(*CHILD_COLUMNS)


def child_headers(headers: DataFrame, types: DataFrame, rules: OrderRules) -> DataFrame:
    """Child orders that name a managing order."""
    return typed_headers(managed_headers(headers), types, (rules.child_type,)).select(*CHILD_COLUMNS)


CHILD_GRAIN = ("po_man", "po", "postr", "ss", "vendname", "sku", "style", "skudesc1", "dateship", "dateexp")


def child_quantities(
    children: Sized | DataFrame,
    details: DataFrame,
    known_items: Sized | DataFrame,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Ordered units per child order, store and item.

    ``carried`` names columns that depend on the managing order alone.
    """
    per_child = (
        attach(details, children, "po")
        .groupBy("po_man", "po", "postr", "dateship", "dateexp", *carried, "sku")
        .agg(F.sum("oounit").alias("oounit"))
    )
    return (
        attach(per_child, known_items, "sku")
        .groupBy(*CHILD_GRAIN, *carried)
        .agg(F.sum("oounit").alias("oounit"))
    )


def store_pivot(rows: DataFrame, grain: list, rules: OrderRules, cell: str = "max") -> DataFrame:
    """One column per listed store, 0 where the store has nothing.

    A cell is the largest child order, not their sum, unless ``cell='sum'``.
    Rows of unlisted stores keep their group alive with zeros.  One aggregate
    over a known store list: no pass to find the values.
    """
    pick = {"max": F.max, "sum": F.sum}[cell]
    cells = [
        F.coalesce(pick(F.when(F.col("postr") == store, F.col("oounit"))), F.lit(0)).alias(column)
        for store, column in rules.store_columns
    ]
    return rows.groupBy(*grain).agg(*cells)


def breakout(
    src: SourceTables,
    window: DateWindow,
    rules: OrderRules = OrderRules(),
    budget: JoinBudget = DEFAULT_BUDGET,
    cell: str = "max",
) -> DataFrame:
    """The breakout view; call ``in_order`` on it for a sorted listing.

    The parent summary has one row per managing order, so one inner join with
    it at header grain both limits the children to tracked parents and adds the
    parent columns, before any detail row is touched.
    """
    summary, known_items = side_by_side(
        lambda: once(parent_summary(parent_orders(src, window, rules, budget)), "summary", budget=budget),
        lambda: once(items(src.child_sku, src.vendmain), "items", budget=budget),
    )
    carried = ("parent_exp_date", "parent_stores")
    # Headers meet the summary before their types: few of all times' headers have a tracked parent.
    tied = once(attach(managed_headers(src.pohdr), summary, "po_man"), "tied", "po", budget=budget)
    typed = typed_headers(tied, src.potype, (rules.child_type,)).select(*CHILD_COLUMNS, *carried)
    children = once(typed, "children", "po", budget=budget)
    quantities = child_quantities(children, src.child_dtl, known_items, carried)
    grain = [
        F.col("po_man"),
        F.col("ss").alias("ss_num"),
        F.col("vendname").alias("vendor"),
        F.col("sku").alias("sku_num"),
        F.col("style"),
        F.col("skudesc1").alias("skudesc"),
        F.col("dateship").alias("ship_date"),
        F.col("dateexp").alias("exp_date"),
        *[F.col(c) for c in carried],
    ]
    return store_pivot(quantities, grain, rules, cell)


def breakout_sorted(src: SourceTables, window: DateWindow, rules: OrderRules = OrderRules(), **more) -> DataFrame:
    return in_order(breakout(src, window, rules, **more), "po_man", "ss_num", "vendor", "sku_num")
