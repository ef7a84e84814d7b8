"""Purchase-order inbound view: one row per order, item and shipment notice date.

The tracked orders of a date window are few next to the fact tables.  Where
their keys are small enough to broadcast, each fact table is cut down to them
as it is read.  Where they are not, a fact table that serves two branches is
shuffled once, summed, written and reused.  Sums come before joins where they
can: a key that holds much of a fact table is combined in the map tasks.

``po_inbound`` runs jobs of its own before it returns: header-sized key sets are
written to scratch tables and measured on the way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockside.functions.dates import DateWindow
from dockside.functions.keys import strict_key
from dockside.operators.filters import listed, non_blank, within
from dockside.operators.joins import (
    DEFAULT_BUDGET,
    JoinBudget,
    Sized,
    attach,
    in_reach,
    keep_matching,
    narrow,
    once,
)
from dockside.operators.latest import latest_per_key
from dockside.operators.reports import in_order
from dockside.rules import MISSING_TYPE, OrderRules
from dockside.session import side_by_side, written
from dockside.sources.inputs import SourceTables

INBOUND_ORDER = ("shipnotice_date", "latest_datercv", "rcvdqty", "ooqty")


def typed_headers(headers: Sized | DataFrame, types: DataFrame, wanted: tuple) -> DataFrame:
    """Headers with their type, limited to the wanted types.

    The limit rejects headers without a type, hence a plain inner join.  Where
    the headers are measured, types of other orders are dropped as they are read.
    """
    limited = types.where(listed(F.col("type"), wanted))
    return attach(limited, headers, "po").withColumn("type", F.coalesce("type", F.lit(MISSING_TYPE)))


def with_child_types(headers: DataFrame, types: DataFrame, rules: OrderRules) -> DataFrame:
    """Headers and how often each is typed as a child order, and otherwise; one row per header."""
    child = F.col("type") == rules.child_type
    counted = types.groupBy("po").agg(
        F.count_if(child).alias("child_types"), F.count_if(~F.coalesce(child, F.lit(False))).alias("other_types")
    )
    return headers.join(counted, "po", "left")


def tracked_headers(headers: DataFrame, window: DateWindow, rules: OrderRules) -> DataFrame:
    """Headers of distribution-centre orders expected in the window."""
    return within(headers, "dateexp", window).where(
        listed(F.col("postr"), rules.dc_stores) & listed(F.col("pocode"), rules.order_codes)
    )


def tracked_orders(
    src: SourceTables, window: DateWindow, rules: OrderRules, budget: JoinBudget = DEFAULT_BUDGET
) -> DataFrame:
    """Tracked headers of the inbound types; headers of the window are few next to all types."""
    headers = once(tracked_headers(src.pohdr, window, rules), "headers", "po", budget=budget)
    return typed_headers(headers, src.potype, rules.inbound_types)


def items(skufile: DataFrame, vendmain: DataFrame) -> DataFrame:
    """Items with a known vendor."""
    return skufile.join(vendmain, "vend").select("sku", "style", "skudesc1", "ss", "vendname")


def latest_receipts(receipts: DataFrame, rules: OrderRules) -> DataFrame:
    """Newest receipt date per order at a distribution centre."""
    return (
        receipts.where(listed(F.col("str"), rules.dc_stores))
        .groupBy("po")
        .agg(F.max("datercv").alias("latest_datercv"))
    )


def invoiced_units(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("po", "sku").agg(F.sum("unitinvc").alias("unitinvc_per_sku"))


def tracked_notices(notices: DataFrame, rules: OrderRules) -> DataFrame:
    return notices.where(listed(F.col("str"), rules.dc_stores)).select("asn", "po", "shpnotcdt")


def shipped_units(notices: Sized | DataFrame, details: DataFrame) -> DataFrame:
    """Units per order, item and notice date."""
    return (
        attach(details, notices, "asn")
        .groupBy("po", F.col("shpnotcdt").alias("shipnotice_date"), "sku")
        .agg(F.sum("qty").alias("asn_qty"))
    )


def order_lines(orders: Sized | DataFrame, details: DataFrame, known_items: Sized | DataFrame) -> DataFrame:
    """Ordered and received units per order, item and header attributes.

    The ship date is part of the grain although the view does not show it.
    """
    header = [c for c in orders.columns if c != "latest_datercv"]
    item = [c for c in known_items.columns if c != "sku"]
    sums = (
        F.max("latest_datercv").alias("latest_datercv"),
        F.sum("ooqty").alias("ooqty"),
        F.sum("rcvdqty").alias("rcvdqty"),
    )
    per_order = (
        attach(details, orders, "po")
        .withColumnsRenamed({"oounit": "ooqty", "rcunit": "rcvdqty"})
        .groupBy(*header, "sku")
        .agg(*sums)
    )
    # The second grouping reuses the shuffle of the first: its key contains it.
    return attach(per_order, known_items, "sku").groupBy(*header, "sku", *item).agg(*sums)


def family_headers(headers: DataFrame) -> DataFrame:
    """Headers that name a managing order."""
    return headers.where(non_blank(F.col("po_man"))).select("po", "po_man")


def item_copies(skufile: DataFrame) -> DataFrame:
    """Known items, and how often each is listed (once, in a clean item file)."""
    return skufile.groupBy("sku").agg(F.count(F.lit(1)).alias("copies"))


def known_only(sums: DataFrame, copies: Sized | DataFrame, *quantities: str) -> DataFrame:
    """Sums of known items.

    Joining details to items before summing gives the same, but would move
    every detail row by item.
    """
    scaled = {q: F.col(q) * F.col("copies") for q in quantities}
    return attach(sums, copies, "sku").withColumns(scaled).drop("copies")


def child_units(family: Sized | DataFrame, details: DataFrame) -> DataFrame:
    """Units on child orders per managing order and item; other types count 0.

    Each other type adds its 0 to the sum, also where the units are missing.
    """
    ordered = F.col("oounit") * F.col("child_types")
    ordered = F.when(F.col("other_types") > 0, F.coalesce(ordered, F.lit(0))).otherwise(ordered)
    units = F.when(F.col("child_types") > 0, ordered).otherwise(0)
    return attach(details, family, "po").groupBy("po_man", "sku").agg(F.sum(units).alias("ooqty"))


def notice_repeats(history: DataFrame, family: Sized | DataFrame) -> DataFrame:
    """How often the warehouse history ties a notice to a managing order."""
    return (
        attach(history, family, "po")
        .groupBy(F.col("genasn").alias("asn"), "po_man")
        .agg(F.count(F.lit(1)).alias("repeats"))
    )


def allocated_units(notice_details: DataFrame, repeats: Sized | DataFrame) -> DataFrame:
    """Notice units reached through the warehouse history, per managing order and item.

    History meets notice details by notice alone, so every history row of a
    notice counts its units again.  The repeats are counted first and
    multiplied in; they are never spelled out as rows.
    """
    return (
        attach(notice_details, repeats, "asn")
        .groupBy("po_man", "sku")
        .agg(F.sum(F.col("qty") * F.col("repeats")).alias("qty"))
    )


def breakout_and_allocated(children: DataFrame, allocated: DataFrame) -> DataFrame:
    """Child units with their allocations.

    Both inputs hold one row per managing order and item, so the sums see one
    row per group; they stay for their NULL handling.
    """
    return (
        children.join(allocated, ["po_man", "sku"], "left")
        .groupBy("po_man", "sku")
        .agg(F.sum("ooqty").alias("breakoutqty"), F.coalesce(F.sum("qty"), F.lit(0)).alias("allocated"))
    )


def used_sums(facts: DataFrame, users: list[Sized], on: str, label: str) -> DataFrame:
    """Facts that any user joins by ``on``, summed per ``on`` and item, for all users at once."""
    keys = reduce(DataFrame.union, [user.rows.select(on) for user in users]).distinct()
    sums = [F.sum(c).alias(c) for c in facts.columns if c not in (on, "sku")]
    return written(in_reach(facts, on, *users).join(keys, on, "left_semi").groupBy(on, "sku").agg(*sums), label)


def or_zero(quantity: str | Column) -> Column:
    return F.coalesce(quantity, F.lit(0))


def po_inbound(
    src: SourceTables,
    window: DateWindow,
    rules: OrderRules = OrderRules(),
    budget: JoinBudget = DEFAULT_BUDGET,
) -> DataFrame:
    """The inbound view; call ``in_order`` on it for a sorted listing."""
    orders = once(tracked_orders(src, window, rules, budget), "orders", "po", budget=budget)

    # Headers managed together with tracked orders, and the notices that the
    # warehouse ties to them.
    def family_and_repeats() -> tuple[Sized, Sized]:
        managed = keep_matching(family_headers(src.family_hdr), orders, "po_man")
        family = once(managed, "family", "po", budget=budget)
        return family, once(notice_repeats(src.wim, family), "repeats", "asn", budget=budget)

    # Notices of tracked orders.
    noticed = keep_matching(tracked_notices(src.asnhdr, rules), orders, "po")
    known = items(src.skufile, src.vendmain).join(item_copies(src.skufile), "sku")
    (family, repeats), notices, known_items = side_by_side(
        family_and_repeats,
        lambda: once(noticed, "notices", "asn", budget=budget),
        lambda: once(known, "items", budget=budget),
    )

    details, notice_details = src.podtl, src.asndtl
    if not (orders.small("po") and family.small("po")):
        details = used_sums(details, [orders, family], "po", "details")
    if not (notices.small("asn") and repeats.small("asn")):
        notice_details = used_sums(notice_details, [notices, repeats], "asn", "notice_details")

    receipts = latest_receipts(narrow(src.purhst, orders, "po"), rules)
    lines = order_lines(orders.with_rows(orders.rows.join(receipts, "po", "left")), details, known_items)
    invoices = invoiced_units(narrow(src.invdtl, orders, "po"))
    shipments = shipped_units(notices, notice_details).withColumn("shipped_sku", F.col("sku"))
    # Lines hold known items only, so the breakouts need no look at the item file
    # beyond how often an item is listed.
    typed_family = with_child_types(family.rows, narrow(src.potype, family, "po"), rules)
    breakouts = breakout_and_allocated(
        child_units(family.with_rows(typed_family), details), allocated_units(notice_details, repeats)
    )
    return (
        lines.join(invoices, ["po", "sku"], "left")
        .join(shipments, ["po", "sku"], "left")
        .join(breakouts, ["po_man", "sku"], "left")
        .select(
            F.col("postr").alias("store"),
            F.col("vendname").alias("vendor"),
            "ss",
            "type",
            F.col("pocode").alias("po_code"),
            "po",
            "po_man",
            "sku",
            "style",
            "skudesc1",
            F.col("dateexp").alias("expected_date"),
            F.col("datecanc").alias("cancel_date"),
            "ooqty",
            "rcvdqty",
            or_zero(F.col("breakoutqty") * F.col("copies")).alias("breakoutqty"),
            or_zero(F.col("allocated") * F.col("copies")).alias("allocated"),
            or_zero("unitinvc_per_sku").alias("unitinvc_per_sku"),
            "shipped_sku",
            or_zero("asn_qty").alias("shipped_qty"),
            "latest_datercv",
            "shipnotice_date",
            strict_key(F.col("po"), F.col("sku"), F.col("dateexp")).alias("record_key"),
        )
    )


def po_inbound_sorted(src: SourceTables, window: DateWindow, rules: OrderRules = OrderRules(), **more) -> DataFrame:
    return in_order(po_inbound(src, window, rules, **more), "po", "sku", "shipnotice_date")


def po_inbound_dedup(src: SourceTables, window: DateWindow, rules: OrderRules = OrderRules(), **more) -> DataFrame:
    """One row per record key: the newest notice, receipt and quantities win."""
    return latest_per_key(po_inbound(src, window, rules, **more), "record_key", INBOUND_ORDER)
