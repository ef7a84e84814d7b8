"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import fields, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockside_checks.fixtures import (
    EVENTS,
    EVENTS_AS_OF,
    ORDERS_AS_OF,
    RULES,
    SEED_BEFORE,
    WINDOW,
    shown,
    sources,
    staging,
    table,
)
from dockside.functions.coerce import to_day, to_integer, to_text
from dockside.functions.dates import compact_day, date_window, utc_day
from dockside.functions.keys import strict_key, tolerant_key
from dockside.operators import reports
from dockside.operators.filters import listed, non_blank, recent_batches, within
from dockside.operators.joins import attach, keep_matching, once, sized
from dockside.operators.latest import latest_per_key
from dockside.operators.retention import delete_out_of_window, delete_stale
from dockside.operators.upsert import upsert
from dockside.plans import breakout as br
from dockside.plans import po_inbound as inb
from dockside.plans.datasets import KEY, DatasetSpec, extract, inbound_spec
from dockside.plans.misfits import violations
from dockside.plans.refresh import coerced, load_batch
from dockside.rules import MISSING_TYPE
from dockside.schemas import table_schema
from dockside.session import scratch_path, tune
from dockside.sinks.changes import state_changes
from dockside.sinks.states import current_state
from dockside.sinks.tables import append_batch, create_tables, ledger, publish, read_final, read_staging, trim_staging
from dockside.sources.inputs import SourceTables, TableRef, open_sources, run_sql
from dockside.sources.naming import plain_names
from dockside.streaming.incremental import upsert_stream

Query = Callable[[SparkSession, str], DataFrame]


def over_sources(build: Callable[[SourceTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(sources(tune(spark), sf_dir))


def over_staging(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(staging(tune(spark), sf_dir))


# --- sources -----------------------------------------------------------------


def src_windowed_extract(src: SourceTables) -> DataFrame:
    return within(src.pohdr, "dateexp", WINDOW)


def src_extract_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables as files, opened by name and run through the dataset's extract."""
    given, folder = sources(tune(spark), sf_dir), scratch_path(spark, "files")
    names = [f.name for f in fields(SourceTables) if getattr(given, f.name) is not None]
    for name in names:
        getattr(given, name).write.parquet(f"{folder}/{name}")
    opened = open_sources(spark, {name: TableRef("parquet", f"{folder}/{name}") for name in names})
    return extract(inbound_spec(RULES), opened, WINDOW)


def src_param_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT po, postr, dateexp FROM {headers} WHERE dateexp BETWEEN :start_date AND :end_date"
    return run_sql(tune(spark), text, WINDOW, headers=sources(spark, sf_dir).pohdr)


def src_rename_columns(src: SourceTables) -> DataFrame:
    raw = src.pohdr.toDF("PO#", "PO#MAN", "POCODE", "POSTR#", "DATEEXP", "DATECANC", "DATESHIP")
    return plain_names(raw)


def src_typed_inputs(src: SourceTables) -> DataFrame:
    """The breakout view over stores given as text, some unreadable, and days given as evening timestamps."""
    store = F.when(F.col("po") % 101 == 0, "HQ").otherwise(F.col("postr").cast("string"))
    evening = F.timestamp_add("HOUR", F.lit(18), F.col("dateexp").cast("timestamp"))
    return br.breakout(replace(src, pohdr=src.pohdr.withColumns({"postr": store, "dateexp": evening})), WINDOW, RULES)


# --- filters -----------------------------------------------------------------


def fil_in_list(src: SourceTables) -> DataFrame:
    return src.pohdr.where(
        listed(F.col("postr"), RULES.dc_stores) & listed(F.col("pocode"), RULES.order_codes)
    ).select("po", "postr", "pocode")


def fil_outer_to_inner(src: SourceTables) -> DataFrame:
    joined = src.pohdr.join(src.potype, "po", "left").where(listed(F.col("type"), RULES.inbound_types))
    return joined.select("po", F.coalesce("type", F.lit(MISSING_TYPE)).alias("type"))


def fil_rolling_window(src: SourceTables) -> DataFrame:
    return within(src.pohdr, "dateexp", date_window(ORDERS_AS_OF)).select("po", "dateexp")


# --- joins -------------------------------------------------------------------


def join_star_inner(src: SourceTables) -> DataFrame:
    orders = once(inb.tracked_orders(src, WINDOW, RULES), "orders", "po")
    known = once(inb.items(src.skufile, src.vendmain), "items", "sku")
    lines = attach(attach(src.podtl, orders, "po"), known, "sku")
    return lines.select("po", "type", "sku", "style", "vendname", "oounit", "rcunit")


def join_left_latest_receipt(src: SourceTables) -> DataFrame:
    return src.pohdr.join(inb.latest_receipts(src.purhst, RULES), "po", "left").select("po", "postr", "latest_datercv")


def detail_sums(src: SourceTables) -> DataFrame:
    return src.podtl.groupBy("po", "sku").agg(F.sum("oounit").alias("ooqty"))


def join_left_invoice(src: SourceTables) -> DataFrame:
    joined = detail_sums(src).join(inb.invoiced_units(src.invdtl), ["po", "sku"], "left")
    return joined.select("po", "sku", "ooqty", F.coalesce("unitinvc_per_sku", F.lit(0)).alias("unitinvc_per_sku"))


def join_left_shipments_fanout(src: SourceTables) -> DataFrame:
    shipped = inb.shipped_units(inb.tracked_notices(src.asnhdr, RULES), src.asndtl)
    joined = detail_sums(src).join(shipped, ["po", "sku"], "left")
    return joined.select("po", "sku", "ooqty", "shipnotice_date", F.coalesce("asn_qty", F.lit(0)).alias("shipped_qty"))


def children_of(src: SourceTables) -> DataFrame:
    family = inb.with_child_types(inb.family_headers(src.family_hdr), src.potype, RULES)
    return inb.known_only(inb.child_units(family, src.podtl), inb.item_copies(src.skufile), "ooqty")


def allocations_of(src: SourceTables) -> DataFrame:
    repeats = inb.notice_repeats(src.wim, inb.family_headers(src.family_hdr))
    allocated = inb.allocated_units(src.asndtl, once(repeats, "repeats", "asn"))
    return inb.known_only(allocated, inb.item_copies(src.skufile), "qty")


def join_agg_to_agg(src: SourceTables) -> DataFrame:
    return inb.breakout_and_allocated(children_of(src), allocations_of(src))


def join_left_breakout_alloc(src: SourceTables) -> DataFrame:
    lines = src.pohdr.select("po", "po_man").join(detail_sums(src), "po")
    joined = lines.join(join_agg_to_agg(src), ["po_man", "sku"], "left")
    return joined.select(
        "po",
        "po_man",
        "sku",
        "ooqty",
        F.coalesce("breakoutqty", F.lit(0)).alias("breakoutqty"),
        F.coalesce("allocated", F.lit(0)).alias("allocated"),
    )


def join_semi_exists(src: SourceTables) -> DataFrame:
    parents = once(br.parent_orders(src, WINDOW, RULES).select("po_man"), "parents", "po_man")
    children = keep_matching(br.child_headers(src.pohdr, src.potype, RULES), parents, "po_man")
    return children.select("po", "po_man", "postr", "dateexp")


def join_existence_distinct(src: SourceTables) -> DataFrame:
    headers = sized(inb.tracked_headers(src.pohdr, WINDOW, RULES))
    return br.with_details(headers, src.podtl).select("po", "po_man", "pocode", "dateexp", "postr").distinct()


def join_parent_summary(src: SourceTables) -> DataFrame:
    return br.parent_summary(br.parent_orders(src, WINDOW, RULES))


# --- aggregations ------------------------------------------------------------


def agg_sum_wide_key(src: SourceTables) -> DataFrame:
    orders = inb.tracked_orders(src, WINDOW, RULES)
    receipts = inb.latest_receipts(src.purhst, RULES)
    known = once(inb.items(src.skufile, src.vendmain), "items", "sku")
    return inb.order_lines(once(orders.join(receipts, "po", "left"), "orders", "po"), src.podtl, known)


def agg_distinct_parents(src: SourceTables) -> DataFrame:
    return br.parent_orders(src, WINDOW, RULES).distinct()


def agg_listagg_ordered(src: SourceTables) -> DataFrame:
    return br.store_list(br.parent_orders(src, WINDOW, RULES), "po_man", "postr", "parent_stores")


def agg_child_qty(src: SourceTables) -> DataFrame:
    parents = once(br.parent_orders(src, WINDOW, RULES).select("po_man"), "parents", "po_man")
    children = once(keep_matching(br.child_headers(src.pohdr, src.potype, RULES), parents, "po_man"), "children", "po")
    return br.child_quantities(children, src.child_dtl, once(inb.items(src.child_sku, src.vendmain), "items", "sku"))


def agg_pivot_store(src: SourceTables) -> DataFrame:
    children = br.child_headers(src.pohdr, src.potype, RULES)
    known = once(inb.items(src.child_sku, src.vendmain), "items", "sku")
    rows = br.child_quantities(once(children, "children", "po"), src.child_dtl, known)
    return br.store_pivot(rows, [F.col("po_man"), F.col("sku"), F.col("dateexp")], RULES)


def agg_daily_counts(rows: DataFrame) -> DataFrame:
    """All rows, rows per business date and rows per load date."""
    whole = reports.total_rows(rows).select(F.lit(None).cast("date").alias("date"), F.col("total").alias("records"))
    due = reports.rows_per_day(rows, F.col("business_date"))
    loaded = reports.rows_per_day(rows, utc_day(F.col("load_timestamp")))
    parts = {"total": whole, "business date": due, "load date": loaded}
    named = [part.withColumn("counted", F.lit(name)) for name, part in parts.items()]
    return reduce(DataFrame.unionByName, named)


# --- scalar functions --------------------------------------------------------


def fn_coalesce_case(src: SourceTables) -> DataFrame:
    joined = src.pohdr.join(src.potype, "po", "left")
    return joined.select(
        "po",
        F.coalesce("type", F.lit(MISSING_TYPE)).alias("type"),
        F.when(F.col("type") == RULES.child_type, F.lit(1)).otherwise(0).cast("bigint").alias("is_child"),
    )


def fn_string_ops(src: SourceTables) -> DataFrame:
    return src.pohdr.select(
        "po",
        F.col("postr").cast("string").alias("store_text"),
        F.trim("po_man").alias("po_man_trimmed"),
        non_blank(F.col("po_man")).cast("bigint").alias("has_po_man"),
    )


def fn_record_key_sql(src: SourceTables) -> DataFrame:
    joined = src.podtl.join(src.pohdr.select("po", "po_man", "dateexp"), "po")
    return joined.select(
        "po",
        "sku",
        compact_day(F.col("dateexp")).alias("day"),
        strict_key(F.col("po"), F.col("sku"), F.col("dateexp")).alias("record_key"),
        strict_key(F.col("po_man"), F.col("sku"), F.col("dateexp")).alias("manager_key"),
    )


def fn_date_arith(rows: DataFrame) -> DataFrame:
    loaded = utc_day(F.col("load_timestamp"))
    return rows.select(
        "event_id",
        loaded.alias("load_day"),
        F.date_sub(loaded, 14).alias("two_weeks_before"),
        F.date_add(loaded, 60).alias("sixty_days_after"),
    )


def fn_record_key_null_safe(src: SourceTables) -> DataFrame:
    headers = src.pohdr.select("po", "po_man", F.when(F.col("po") % 29 != 0, F.col("dateexp")).alias("dateexp"))
    joined = src.podtl.select("po", "sku").join(headers, "po")
    return joined.select(
        "po", "sku", tolerant_key(F.col("po_man"), F.col("sku"), F.col("dateexp")).alias("record_key")
    )


# --- type coercion -----------------------------------------------------------


def typ_int_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(tune(spark), sf_dir, "lineitem")
    whole = F.col("l_quantity").cast("bigint").cast("string")
    kind = F.col("l_orderkey") % 7
    raw = (
        F.when(kind == 0, None)
        .when(kind == 1, "")
        .when(kind == 2, "abc")
        .when(kind == 3, "1e3")
        .when(kind == 4, F.concat(whole, F.lit(".0")))
        .otherwise(whole)
    )
    return lines.select("l_orderkey", "l_linenumber", to_integer(raw, label="quantity").alias("quantity"))


MEASURES = DatasetSpec(
    name="measures",
    staging_table="measures_staging",
    final_table="measures_final",
    schema=table_schema("quantity bigint, price bigint, l_orderkey bigint"),
    date_column="",
)


def typ_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers per column that would not survive as integers."""
    lines = table(tune(spark), sf_dir, "lineitem")
    whole = F.col("l_quantity").cast("bigint").cast("string")
    kind = F.col("l_orderkey") % 7
    quantity = (
        F.when(kind == 0, None)
        .when(kind == 1, "")
        .when(kind == 2, "abc")
        .when(kind == 3, "1e3")
        .when(kind == 4, F.concat(whole, F.lit(".5")))
        .when(kind == 5, "1e30")
        .otherwise(whole)
    )
    price = F.when(kind > 1, F.col("l_extendedprice").cast("double"))
    return violations(lines.select("l_orderkey", quantity.alias("quantity"), price.alias("price")), MEASURES)


def typ_date_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(tune(spark), sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    kind = F.col("o_orderkey") % 5
    raw = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, compact_day(day))
        .when(kind == 2, "2025-13-01")
        .when(kind == 4, "9999-12-31")
    )
    return orders.select("o_orderkey", to_day(raw).alias("order_day"))


def typ_string_coerce(src: SourceTables) -> DataFrame:
    raw = F.when(F.col("po") % 23 == 0, "None").otherwise(F.col("po_man"))
    return src.pohdr.select("po", to_text(raw).alias("po_man"))


# --- table upkeep ------------------------------------------------------------


def recent(rows: DataFrame) -> DataFrame:
    return recent_batches(rows, EVENTS_AS_OF)


def newest(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, KEY, EVENTS.newest_first)


def seed(rows: DataFrame) -> DataFrame:
    """The final table as it stood before the later batches."""
    return newest(rows.where(F.col("load_date") < F.lit(SEED_BEFORE)))


def mrg_upsert(rows: DataFrame) -> DataFrame:
    return shown(upsert(seed(rows), newest(recent(rows)), KEY))


def del_out_of_window(rows: DataFrame) -> DataFrame:
    return shown(delete_out_of_window(rows, "business_date", EVENTS_AS_OF))


def del_stale(rows: DataFrame) -> DataFrame:
    kept = delete_out_of_window(rows, "business_date", EVENTS_AS_OF)
    return shown(delete_stale(newest(recent(rows)), kept))


def fresh_tables(spark: SparkSession, label: str) -> str:
    """An empty pair of event tables in a database of its own."""
    path = scratch_path(spark, label)
    database = path.rsplit("/", 1)[-1].replace("-", "_")
    create_tables(spark, database, EVENTS, path)
    return database


def snk_append_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = fresh_tables(tune(spark), "append")
    append_batch(spark, database, EVENTS, staging(spark, sf_dir), "all")
    back = spark.table(f"{database}.{EVENTS.staging_table}")
    return back.select("record_key", "business_date", "event_id", "value", "load_date")


def staged_by_week(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Every event in staging, a batch per week of load days; the first batch twice."""
    database = fresh_tables(tune(spark), label)
    rows, week = staging(spark, sf_dir), F.pmod(F.datediff("load_date", F.lit(EVENTS_AS_OF)), F.lit(5))
    for number in (0, 1, 2, 3, 4, 0):
        append_batch(spark, database, EVENTS, rows.where(week == number), f"part {number}")
    return database


def snk_batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger notes of each staged load day."""
    database = staged_by_week(spark, sf_dir, "ledger")
    return ledger(spark, database, EVENTS).select("load_date", "rows", "undated", "least_day", "greatest_day")


def snk_trim_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging after a trim by the ledger."""
    database = staged_by_week(spark, sf_dir, "trim")
    trim_staging(spark, database, EVENTS, EVENTS_AS_OF)
    return shown(read_staging(spark, database, EVENTS))


def seeded_tables(spark: SparkSession, label: str, seed_rows: DataFrame, spec: DatasetSpec = EVENTS) -> str:
    database = fresh_tables(spark, label)
    publish(spark, database, spec, seed(seed_rows))
    return database


def load_lifecycle(spark: SparkSession, sf_dir: str, spec: DatasetSpec = EVENTS) -> DataFrame:
    """Earlier batches are staged; the last day's batch goes through the load."""
    rows = coerced(staging(tune(spark), sf_dir), spec)
    database = seeded_tables(spark, "lifecycle", rows)
    earlier = F.col("load_date") < F.lit(EVENTS_AS_OF)
    append_batch(spark, database, EVENTS, rows.where(earlier), "earlier")
    stamp = datetime(EVENTS_AS_OF.year, EVENTS_AS_OF.month, EVENTS_AS_OF.day, tzinfo=timezone.utc)
    load_batch(spark, database, spec, rows.where(~earlier).drop("load_date"), EVENTS_AS_OF, stamp)
    return shown(read_final(spark, database, EVENTS))


def load_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load without stale removal: rows that the last batch does not hold stay."""
    return load_lifecycle(spark, sf_dir, replace(EVENTS, cleanup_stale=False))


def pipe_load_changes(spark: SparkSession, sf_dir: str, spec: DatasetSpec = EVENTS) -> DataFrame:
    """What the load of the last day's batch does to the rows of the final table."""
    rows = coerced(staging(tune(spark), sf_dir), spec)
    database = seeded_tables(spark, "changes", rows)
    earlier = F.col("load_date") < F.lit(EVENTS_AS_OF)
    append_batch(spark, database, spec, rows.where(earlier), "earlier")
    before = current_state(spark, database, spec)
    stamp = datetime(EVENTS_AS_OF.year, EVENTS_AS_OF.month, EVENTS_AS_OF.day, tzinfo=timezone.utc)
    load_batch(spark, database, spec, rows.where(~earlier).drop("load_date"), EVENTS_AS_OF, stamp)
    return state_changes(spark, database, spec, before, current_state(spark, database, spec), EVENTS_AS_OF)


def pipe_backfill_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without stale removal."""
    return pipe_load_changes(spark, sf_dir, replace(EVENTS, cleanup_stale=False))


def str_incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches land in files out of order and are worked off in micro-batches."""
    return upserted(spark, sf_dir, EVENTS, 2)


def str_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in 24 buckets and batch by batch, each state on the one before."""
    return upserted(spark, sf_dir, replace(EVENTS, buckets=24), 1)


def upserted(spark: SparkSession, sf_dir: str, spec: DatasetSpec, files_per_batch: int) -> DataFrame:
    rows = staging(tune(spark), sf_dir)
    database = seeded_tables(spark, "stream", coerced(rows, EVENTS), spec)
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    rows.repartition(4, "load_timestamp").select(*EVENTS.schema.names).write.parquet(landing)
    upsert_stream(
        spark, database, spec, landing, checkpoint, EVENTS_AS_OF, files_per_batch=files_per_batch
    ).awaitTermination()
    return shown(read_final(spark, database, EVENTS))


QUERIES: dict[str, Query] = {
    "src_windowed_extract": over_sources(src_windowed_extract),
    "src_extract_from_files": src_extract_from_files,
    "src_param_binding": src_param_binding,
    "src_rename_columns": over_sources(src_rename_columns),
    "src_typed_inputs": over_sources(src_typed_inputs),
    "snk_append_staging": snk_append_staging,
    "snk_batch_ledger": snk_batch_ledger,
    "snk_trim_staging": snk_trim_staging,
    "fil_in_list": over_sources(fil_in_list),
    "fil_date_between": over_sources(lambda src: within(src.pohdr, "dateexp", WINDOW).select("po", "dateexp")),
    "fil_non_blank": over_sources(lambda src: src.pohdr.where(non_blank(F.col("po_man"))).select("po", "po_man")),
    "fil_outer_to_inner": over_sources(fil_outer_to_inner),
    "fil_recent_batches": over_staging(lambda rows: shown(recent(rows))),
    "fil_rolling_window": over_sources(fil_rolling_window),
    "join_star_inner": over_sources(join_star_inner),
    "join_left_latest_receipt": over_sources(join_left_latest_receipt),
    "join_left_invoice": over_sources(join_left_invoice),
    "join_left_shipments_fanout": over_sources(join_left_shipments_fanout),
    "join_left_breakout_alloc": over_sources(join_left_breakout_alloc),
    "join_agg_to_agg": over_sources(join_agg_to_agg),
    "join_semi_exists": over_sources(join_semi_exists),
    "join_existence_distinct": over_sources(join_existence_distinct),
    "join_allocation_chain": over_sources(allocations_of),
    "join_parent_summary": over_sources(join_parent_summary),
    "agg_sum_wide_key": over_sources(agg_sum_wide_key),
    "agg_max_date": over_sources(lambda src: inb.latest_receipts(src.purhst, RULES)),
    "agg_conditional_sum": over_sources(children_of),
    "agg_invoice_sum": over_sources(lambda src: inb.invoiced_units(src.invdtl)),
    "agg_asn_sum": over_sources(
        lambda src: inb.shipped_units(inb.tracked_notices(src.asnhdr, RULES), src.asndtl)
    ),
    "agg_distinct_parents": over_sources(agg_distinct_parents),
    "agg_listagg_ordered": over_sources(agg_listagg_ordered),
    "agg_pivot_store": over_sources(agg_pivot_store),
    "agg_child_qty": over_sources(agg_child_qty),
    "agg_daily_counts": over_staging(agg_daily_counts),
    "win_latest_per_key": over_staging(lambda rows: shown(newest(recent(rows)))),
    "sort_po_output": over_sources(lambda src: inb.po_inbound_sorted(src, WINDOW, RULES)),
    "topk_recent_dates": over_staging(lambda rows: reports.newest_days(rows, F.col("business_date"))),
    "fn_coalesce_case": over_sources(fn_coalesce_case),
    "fn_string_ops": over_sources(fn_string_ops),
    "fn_record_key_sql": over_sources(fn_record_key_sql),
    "fn_date_arith": over_staging(fn_date_arith),
    "fn_record_key_null_safe": over_sources(fn_record_key_null_safe),
    "typ_int_coerce": typ_int_coerce,
    "typ_violations": typ_violations,
    "typ_date_coerce": typ_date_coerce,
    "typ_string_coerce": over_sources(typ_string_coerce),
    "mrg_upsert": over_staging(mrg_upsert),
    "del_out_of_window": over_staging(del_out_of_window),
    "del_stale": over_staging(del_stale),
    "po_inbound": over_sources(lambda src: inb.po_inbound(src, WINDOW, RULES)),
    "po_inbound_dedup": over_sources(lambda src: inb.po_inbound_dedup(src, WINDOW, RULES)),
    "breakout_pivot": over_sources(lambda src: br.breakout(src, WINDOW, RULES)),
    "sort_breakout_output": over_sources(lambda src: br.breakout_sorted(src, WINDOW, RULES)),
    "load_lifecycle": load_lifecycle,
    "load_backfill": load_backfill,
    "pipe_load_changes": pipe_load_changes,
    "pipe_backfill_changes": pipe_backfill_changes,
    "str_incremental_upsert": str_incremental_upsert,
    "str_upsert_bucketed": str_upsert_bucketed,
}
