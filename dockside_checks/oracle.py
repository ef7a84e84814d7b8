"""The same results in plain SQL over the given tables."""

from __future__ import annotations

VIEWS = """
pohdr AS (
  SELECT o_orderkey AS po,
         CASE WHEN o_custkey % 13 = 0 THEN '   '
              WHEN o_custkey % 17 = 0 THEN NULL
              ELSE 'M' || CAST(o_custkey AS VARCHAR) END AS po_man,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'O' WHEN '2-HIGH' THEN 'D' ELSE 'X' END AS pocode,
         o_orderkey % 25 AS postr,
         CAST(o_orderdate AS DATE) AS dateexp,
         CAST(o_orderdate AS DATE) + 30 AS datecanc,
         CAST(o_orderdate AS DATE) - 5 AS dateship
  FROM orders),
potype AS (
  SELECT o_orderkey AS po,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'P'
              WHEN o_orderstatus = 'O' THEN 'C' WHEN o_orderstatus = 'P' THEN 'R' END AS type
  FROM orders),
podtl AS (
  SELECT l_orderkey AS po, l_partkey AS sku, CAST(l_quantity AS BIGINT) AS oounit,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS rcunit
  FROM lineitem),
skufile AS (
  SELECT CASE WHEN p_partkey = 49 THEN -49 ELSE p_partkey END AS sku, p_brand AS style, p_name AS skudesc1,
         p_type AS ss, p_partkey % 10 AS vend
  FROM part),
vendmain AS (SELECT s_suppkey AS vend, s_name AS vendname FROM supplier),
purhst AS (
  SELECT l_orderkey AS po, l_orderkey % 25 AS str, CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END AS datercv
  FROM lineitem),
invdtl AS (
  SELECT l_orderkey AS po, l_partkey AS sku, CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) END AS unitinvc
  FROM lineitem),
asndtl AS (
  SELECT l_orderkey * 10 + l_linenumber % 3 AS asn, l_partkey AS sku,
         CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS BIGINT) END AS qty
  FROM lineitem),
asnhdr AS (
  SELECT l_orderkey * 10 + l_linenumber % 3 AS asn, l_orderkey AS po, l_orderkey % 25 AS str,
         MAX(CAST(l_shipdate AS DATE)) AS shpnotcdt
  FROM lineitem GROUP BY ALL),
wim AS (SELECT CASE WHEN asn % 2 = 0 THEN asn END AS genasn, po FROM asnhdr),
staged AS (
  SELECT CASE WHEN event_id % 31 <> 0 THEN CAST(user_id AS VARCHAR) || '_' || event_type END AS record_key,
         CASE WHEN event_id % 29 <> 0
              THEN CAST(ts AS DATE) + CAST(event_id % 121 - 45 AS INTEGER) END AS business_date,
         event_id, value, ts, CAST(ts AS DATE) AS load_date
  FROM events)"""

STORES = "(2, 5, 8, 11, 14, 17, 20)"
SPAN = "dateexp BETWEEN DATE '1997-07-01' AND DATE '1999-06-30'"
TRACKED = f"postr IN {STORES} AND pocode IN ('O', 'D') AND {SPAN}"
NAMED = "trim(po_man) <> ''"
CELLS = ", ".join(f"COALESCE(MAX(CASE WHEN c.postr = {n} THEN c.oounit END), 0) AS s{n}" for n in range(25))

PARTS = {
    "receipt": f"SELECT po, MAX(datercv) AS latest_datercv FROM purhst WHERE str IN {STORES} GROUP BY po",
    "line": f"""
        SELECT h.postr, v.vendname, s.ss, h.datecanc, h.po, t.type, h.po_man, h.dateexp, h.pocode, h.dateship,
               s.sku, s.style, s.skudesc1, MAX(r.latest_datercv) AS latest_datercv,
               CAST(SUM(d.oounit) AS BIGINT) AS ooqty, CAST(SUM(d.rcunit) AS BIGINT) AS rcvdqty
        FROM pohdr h JOIN potype t USING (po) JOIN podtl d USING (po) JOIN skufile s USING (sku)
             JOIN vendmain v USING (vend) LEFT JOIN receipt r USING (po)
        WHERE {TRACKED} AND t.type IN ('P', 'R')
        GROUP BY ALL""",
    "invoice": "SELECT po, sku, CAST(SUM(unitinvc) AS BIGINT) AS unitinvc_per_sku FROM invdtl GROUP BY po, sku",
    "shipment": f"""
        SELECT n.po, n.shpnotcdt AS shipnotice_date, d.sku, CAST(SUM(d.qty) AS BIGINT) AS asn_qty
        FROM asnhdr n JOIN asndtl d ON d.asn = n.asn WHERE n.str IN {STORES} GROUP BY 1, 2, 3""",
    "child_sum": f"""
        SELECT h.po_man, d.sku, CAST(SUM(CASE WHEN t.type = 'C' THEN d.oounit ELSE 0 END) AS BIGINT) AS ooqty
        FROM pohdr h LEFT JOIN potype t ON t.po = h.po JOIN podtl d ON d.po = h.po JOIN skufile s ON s.sku = d.sku
        WHERE h.po_man IS NOT NULL AND {NAMED} GROUP BY 1, 2""",
    "allocation": f"""
        SELECT h.po_man, d.sku, CAST(SUM(d.qty) AS BIGINT) AS qty
        FROM wim w JOIN asndtl d ON d.asn = w.genasn JOIN skufile s ON s.sku = d.sku JOIN pohdr h ON h.po = w.po
        WHERE h.po_man IS NOT NULL AND {NAMED} GROUP BY 1, 2""",
    "managed": """
        SELECT c.po_man, c.sku, CAST(SUM(c.ooqty) AS BIGINT) AS breakoutqty,
               CAST(COALESCE(SUM(a.qty), 0) AS BIGINT) AS allocated
        FROM child_sum c LEFT JOIN allocation a ON a.po_man = c.po_man AND a.sku = c.sku GROUP BY 1, 2""",
    "inbound": """
        SELECT l.postr AS store, l.vendname AS vendor, l.ss, l.type, l.pocode AS po_code, l.po, l.po_man, l.sku,
               l.style, l.skudesc1, l.dateexp AS expected_date, l.datecanc AS cancel_date, l.ooqty, l.rcvdqty,
               COALESCE(m.breakoutqty, 0) AS breakoutqty, COALESCE(m.allocated, 0) AS allocated,
               COALESCE(i.unitinvc_per_sku, 0) AS unitinvc_per_sku, a.sku AS shipped_sku,
               COALESCE(a.asn_qty, 0) AS shipped_qty, l.latest_datercv, a.shipnotice_date,
               CAST(l.po AS VARCHAR) || '_' || CAST(l.sku AS VARCHAR) || '_' || strftime(l.dateexp, '%Y%m%d')
                 AS record_key
        FROM line l
        LEFT JOIN invoice i ON i.po = l.po AND i.sku = l.sku
        LEFT JOIN shipment a ON a.po = l.po AND a.sku = l.sku
        LEFT JOIN managed m ON m.po_man = l.po_man AND m.sku = l.sku""",
    "parent": f"""
        SELECT DISTINCT h.po, h.po_man, h.pocode, t.type, h.dateexp, h.postr
        FROM pohdr h JOIN potype t ON t.po = h.po JOIN podtl d ON d.po = h.po
        WHERE {TRACKED} AND t.type = 'P' AND h.po_man IS NOT NULL AND {NAMED}""",
    "parent_store": """
        SELECT po_man, string_agg(CAST(postr AS VARCHAR), ', ' ORDER BY postr) AS parent_stores
        FROM (SELECT DISTINCT po_man, postr FROM parent) GROUP BY po_man""",
    "parent_sum": """
        SELECT e.po_man, e.parent_exp_date, s.parent_stores
        FROM (SELECT po_man, MAX(dateexp) AS parent_exp_date FROM parent GROUP BY po_man) e
        LEFT JOIN parent_store s ON s.po_man = e.po_man""",
    "any_child": f"""
        SELECT h.po_man, h.po, h.postr, s.ss, v.vendname, s.sku, s.style, s.skudesc1, h.dateship, h.dateexp,
               CAST(SUM(d.oounit) AS BIGINT) AS oounit
        FROM pohdr h JOIN podtl d ON d.po = h.po JOIN skufile s ON s.sku = d.sku JOIN vendmain v ON v.vend = s.vend
             JOIN potype t ON t.po = h.po
        WHERE t.type = 'C' AND h.po_man IS NOT NULL AND {NAMED} GROUP BY ALL""",
    "child": "SELECT * FROM any_child c WHERE EXISTS (SELECT 1 FROM parent p WHERE p.po_man = c.po_man)",
    "breakout": f"""
        SELECT c.po_man, c.ss AS ss_num, c.vendname AS vendor, c.sku AS sku_num, c.style, c.skudesc1 AS skudesc,
               c.dateship AS ship_date, c.dateexp AS exp_date, p.parent_exp_date, p.parent_stores, {CELLS}
        FROM child c LEFT JOIN parent_sum p ON p.po_man = c.po_man GROUP BY ALL""",
}


# Lifecycle parts; the seed is the final table before the later batches.
NEWEST = "ORDER BY load_date DESC, ts DESC, event_id DESC"
COLUMNS = "record_key, business_date, event_id, value, load_date"
KEPT = "(business_date IS NULL OR business_date BETWEEN DATE '2023-12-31' AND DATE '2024-03-30')"
LIFECYCLE = f"""
seed AS (
  SELECT * FROM staged WHERE load_date < DATE '2024-01-10'
  QUALIFY row_number() OVER (PARTITION BY record_key {NEWEST}) = 1),
recent AS (SELECT * FROM staged WHERE load_date >= DATE '2024-01-16'),
newest AS (SELECT * FROM recent QUALIFY row_number() OVER (PARTITION BY record_key {NEWEST}) = 1),
merged AS (
  SELECT * FROM newest
  UNION ALL
  SELECT * FROM seed t WHERE NOT EXISTS (SELECT 1 FROM newest s WHERE s.record_key = t.record_key)),
last_batch AS (SELECT MAX(load_date) AS load_date FROM staged WHERE {KEPT})"""


def parts_of(*parts: str) -> str:
    return ",\n".join(f"{name} AS ({PARTS[name]})" for name in parts)


def over_views(select: str, *parts: str) -> str:
    return f"WITH {VIEWS.strip()}{',' if parts else ''}\n{parts_of(*parts)}\n{select}"


def over_lifecycle(select: str, text_keys: bool = False) -> str:
    views = VIEWS.strip()
    if text_keys:
        # A loaded key is never NULL: missing keys become empty text.
        views += ",\ntyped AS (SELECT * REPLACE (COALESCE(record_key, '') AS record_key) FROM staged)"
        return f"WITH {views},\n{LIFECYCLE.strip().replace('FROM staged', 'FROM typed')}\n{select}"
    return f"WITH {views},\n{LIFECYCLE.strip()}\n{select}"


FRESH = "NOT COALESCE(load_date < (SELECT load_date FROM last_batch), FALSE)"


def changes_into(state: str) -> str:
    """Rows of the seed and of a later state by what became of them."""
    return over_lifecycle(
        f"""SELECT c.change, COUNT(f.change) AS rows
FROM (VALUES ('unchanged'), ('replaced'), ('added'), ('out_of_window'), ('stale')) c(change)
LEFT JOIN (
  SELECT CASE WHEN s.record_key IS NULL THEN 'added'
              WHEN n.record_key IS NULL AND s.kept THEN 'stale'
              WHEN n.record_key IS NULL THEN 'out_of_window'
              WHEN s.load_date = n.load_date THEN 'unchanged' ELSE 'replaced' END AS change
  FROM (SELECT record_key, load_date, {KEPT} AS kept FROM seed) s
  FULL JOIN ({state}) n ON n.record_key = s.record_key) f ON f.change = c.change
GROUP BY c.change""",
        text_keys=True,
    )


MANAGED = ("child_sum", "allocation", "managed")
INBOUND = ("receipt", "line", "invoice", "shipment", *MANAGED, "inbound")
BREAKOUT = ("parent", "parent_store", "parent_sum", "any_child", "child", "breakout")
KEY_PARTS = "COALESCE({}, 'None')"
DETAIL_SUM = "(SELECT po, sku, CAST(SUM(oounit) AS BIGINT) AS ooqty FROM podtl GROUP BY po, sku)"

ORACLE: dict[str, str] = {
    "src_typed_inputs": over_views("SELECT * FROM breakout", *BREAKOUT).replace(
        "o_orderkey % 25 AS postr", "CASE WHEN o_orderkey % 101 <> 0 THEN o_orderkey % 25 END AS postr"
    ),
    "src_windowed_extract": over_views(f"SELECT * FROM pohdr WHERE {SPAN}"),
    "src_param_binding": over_views(f"SELECT po, postr, dateexp FROM pohdr WHERE {SPAN}"),
    "src_rename_columns": over_views("SELECT * FROM pohdr"),
    "snk_append_staging": over_views(f"SELECT {COLUMNS} FROM staged"),
    "snk_batch_ledger": over_views(
        "SELECT load_date, count(*) AS rows, count(*) FILTER (business_date IS NULL) AS undated, "
        "min(business_date) AS least_day, max(business_date) AS greatest_day FROM staged GROUP BY load_date"
    ),
    "fil_in_list": over_views(
        f"SELECT po, postr, pocode FROM pohdr WHERE postr IN {STORES} AND pocode IN ('O', 'D')"
    ),
    "fil_date_between": over_views(f"SELECT po, dateexp FROM pohdr WHERE {SPAN}"),
    "fil_non_blank": over_views(f"SELECT po, po_man FROM pohdr WHERE po_man IS NOT NULL AND {NAMED}"),
    "fil_outer_to_inner": over_views(
        "SELECT h.po, COALESCE(t.type, 'INVALID') AS type FROM pohdr h LEFT JOIN potype t ON t.po = h.po "
        "WHERE t.type IN ('P', 'R')"
    ),
    "fil_recent_batches": over_views(f"SELECT {COLUMNS} FROM staged WHERE load_date >= DATE '2024-01-30' - 14"),
    "fil_rolling_window": over_views(
        "SELECT po, dateexp FROM pohdr WHERE dateexp BETWEEN DATE '1998-05-31' AND DATE '1998-08-29'"
    ),
    "join_star_inner": over_views(
        "SELECT h.po, t.type, d.sku, s.style, v.vendname, d.oounit, d.rcunit "
        "FROM pohdr h JOIN potype t ON t.po = h.po JOIN podtl d ON d.po = h.po "
        "JOIN skufile s ON s.sku = d.sku JOIN vendmain v ON v.vend = s.vend "
        f"WHERE {TRACKED} AND t.type IN ('P', 'R')"
    ),
    "join_left_latest_receipt": over_views(
        "SELECT h.po, h.postr, r.latest_datercv FROM pohdr h LEFT JOIN receipt r ON r.po = h.po", "receipt"
    ),
    "join_left_invoice": over_views(
        "SELECT d.po, d.sku, d.ooqty, COALESCE(i.unitinvc_per_sku, 0) AS unitinvc_per_sku "
        f"FROM {DETAIL_SUM} d LEFT JOIN invoice i ON i.po = d.po AND i.sku = d.sku",
        "invoice",
    ),
    "join_left_shipments_fanout": over_views(
        "SELECT d.po, d.sku, d.ooqty, a.shipnotice_date, COALESCE(a.asn_qty, 0) AS shipped_qty "
        f"FROM {DETAIL_SUM} d LEFT JOIN shipment a ON a.po = d.po AND a.sku = d.sku",
        "shipment",
    ),
    "join_left_breakout_alloc": over_views(
        "SELECT h.po, h.po_man, d.sku, d.ooqty, COALESCE(m.breakoutqty, 0) AS breakoutqty, "
        f"COALESCE(m.allocated, 0) AS allocated FROM pohdr h JOIN {DETAIL_SUM} d ON d.po = h.po "
        "LEFT JOIN managed m ON m.po_man = h.po_man AND m.sku = d.sku",
        *MANAGED,
    ),
    "join_agg_to_agg": over_views("SELECT * FROM managed", *MANAGED),
    "join_semi_exists": over_views(
        "SELECT h.po, h.po_man, h.postr, h.dateexp FROM pohdr h JOIN potype t ON t.po = h.po "
        "WHERE t.type = 'C' AND EXISTS (SELECT 1 FROM parent p WHERE p.po_man = h.po_man)",
        "parent",
    ),
    "join_existence_distinct": over_views(
        "SELECT DISTINCT h.po, h.po_man, h.pocode, h.dateexp, h.postr FROM pohdr h JOIN podtl d ON d.po = h.po "
        f"WHERE {TRACKED}"
    ),
    "join_allocation_chain": over_views("SELECT * FROM allocation", "allocation"),
    "join_parent_summary": over_views("SELECT * FROM parent_sum", "parent", "parent_store", "parent_sum"),
    "agg_sum_wide_key": over_views("SELECT * FROM line", "receipt", "line"),
    "agg_max_date": over_views("SELECT * FROM receipt", "receipt"),
    "agg_conditional_sum": over_views("SELECT * FROM child_sum", "child_sum"),
    "agg_invoice_sum": over_views("SELECT * FROM invoice", "invoice"),
    "agg_asn_sum": over_views("SELECT * FROM shipment", "shipment"),
    "agg_distinct_parents": over_views("SELECT * FROM parent", "parent"),
    "agg_listagg_ordered": over_views("SELECT * FROM parent_store", "parent", "parent_store"),
    "agg_pivot_store": over_views(
        f"SELECT c.po_man, c.sku, c.dateexp, {CELLS} FROM any_child c GROUP BY 1, 2, 3", "any_child"
    ),
    "agg_child_qty": over_views("SELECT * FROM child", "parent", "any_child", "child"),
    "agg_daily_counts": over_views(
        "SELECT 'total' AS counted, CAST(NULL AS DATE) AS date, COUNT(*) AS records FROM staged "
        "UNION ALL SELECT 'business date', business_date, COUNT(*) FROM staged GROUP BY ALL "
        "UNION ALL SELECT 'load date', load_date, COUNT(*) FROM staged GROUP BY ALL"
    ),
    "win_latest_per_key": over_lifecycle(f"SELECT {COLUMNS} FROM newest"),
    "sort_po_output": over_views("SELECT * FROM inbound ORDER BY po, sku, shipnotice_date NULLS LAST", *INBOUND),
    "topk_recent_dates": over_views(
        "SELECT business_date AS date, COUNT(*) AS records FROM staged GROUP BY 1 "
        "ORDER BY 1 DESC NULLS LAST LIMIT 10"
    ),
    "fn_coalesce_case": over_views(
        "SELECT h.po, COALESCE(t.type, 'INVALID') AS type, "
        "CAST(CASE WHEN t.type = 'C' THEN 1 ELSE 0 END AS BIGINT) AS is_child "
        "FROM pohdr h LEFT JOIN potype t ON t.po = h.po"
    ),
    "fn_string_ops": over_views(
        "SELECT po, CAST(postr AS VARCHAR) AS store_text, trim(po_man) AS po_man_trimmed, "
        "CAST(po_man IS NOT NULL AND trim(po_man) <> '' AS BIGINT) AS has_po_man FROM pohdr"
    ),
    "fn_record_key_sql": over_views(
        "SELECT d.po, d.sku, strftime(h.dateexp, '%Y%m%d') AS day, "
        "CAST(d.po AS VARCHAR) || '_' || CAST(d.sku AS VARCHAR) || '_' || strftime(h.dateexp, '%Y%m%d') "
        "AS record_key, "
        "h.po_man || '_' || CAST(d.sku AS VARCHAR) || '_' || strftime(h.dateexp, '%Y%m%d') AS manager_key "
        "FROM podtl d JOIN pohdr h ON h.po = d.po"
    ),
    "fn_date_arith": over_views(
        "SELECT event_id, load_date AS load_day, load_date - 14 AS two_weeks_before, "
        "load_date + 60 AS sixty_days_after FROM staged"
    ),
    "fn_record_key_null_safe": over_views(
        f"SELECT d.po, d.sku, {KEY_PARTS.format('h.po_man')} || '_' || CAST(d.sku AS VARCHAR) || '_' || "
        "CASE WHEN d.po % 29 = 0 THEN 'NULL' ELSE strftime(h.dateexp, '%Y%m%d') END AS record_key "
        "FROM podtl d JOIN pohdr h ON h.po = d.po"
    ),
    "typ_int_coerce": """
        WITH raw AS (
          SELECT l_orderkey, l_linenumber,
                 CASE l_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN '1e3'
                      WHEN 4 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.0'
                      ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS x
          FROM lineitem)
        SELECT l_orderkey, l_linenumber, COALESCE(CAST(TRY_CAST(x AS DOUBLE) AS BIGINT), 0) AS quantity FROM raw""",
    "typ_violations": """
        WITH raw AS (
          SELECT CASE l_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN '1e3'
                      WHEN 4 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.5' WHEN 5 THEN '1e30'
                      ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
                 CASE WHEN l_orderkey % 7 > 1 THEN CAST(l_extendedprice AS DOUBLE) END AS price
          FROM lineitem),
        read AS (SELECT 'quantity' AS column_name, TRY_CAST(quantity AS DOUBLE) AS x FROM raw
                 UNION ALL SELECT 'price', price FROM raw)
        SELECT column_name, COUNT(*) FILTER (WHERE x <> floor(x) OR abs(x) >= 9223372036854775808.0) AS misfits
        FROM read GROUP BY column_name""",
    "typ_date_coerce": """
        WITH raw AS (
          SELECT o_orderkey,
                 CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                      WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') WHEN 2 THEN '2025-13-01'
                      WHEN 4 THEN '9999-12-31' END AS x
          FROM orders),
        parsed AS (
          SELECT o_orderkey,
                 CAST(COALESCE(try_strptime(x, '%Y-%m-%d'), try_strptime(x, '%Y%m%d')) AS DATE) AS d FROM raw)
        SELECT o_orderkey,
               CASE WHEN d BETWEEN DATE '1677-09-22' AND DATE '2262-04-11' THEN d END AS order_day
        FROM parsed""",
    "typ_string_coerce": over_views(
        "SELECT po, CASE WHEN po % 23 = 0 THEN '' ELSE COALESCE(po_man, '') END AS po_man FROM pohdr"
    ),
    "mrg_upsert": over_lifecycle(f"SELECT {COLUMNS} FROM merged"),
    "del_out_of_window": over_lifecycle(f"SELECT {COLUMNS} FROM staged WHERE {KEPT}"),
    "snk_trim_staging": over_lifecycle(f"SELECT {COLUMNS} FROM staged WHERE {KEPT}"),
    "del_stale": over_lifecycle(
        f"SELECT {COLUMNS} FROM newest WHERE NOT COALESCE(load_date < (SELECT load_date FROM last_batch), FALSE)"
    ),
    "po_inbound": over_views("SELECT * FROM inbound", *INBOUND),
    "src_extract_from_files": over_views("SELECT * FROM inbound", *INBOUND),
    "po_inbound_dedup": over_views(
        "SELECT * FROM inbound QUALIFY row_number() OVER (PARTITION BY record_key ORDER BY "
        "shipnotice_date DESC NULLS LAST, latest_datercv DESC NULLS LAST, rcvdqty DESC, ooqty DESC, "
        "store DESC, vendor DESC, ss DESC, type DESC, po_code DESC, po DESC, po_man DESC NULLS LAST, sku DESC, "
        "style DESC, skudesc1 DESC, expected_date DESC, cancel_date DESC, breakoutqty DESC, allocated DESC, "
        "unitinvc_per_sku DESC, shipped_sku DESC NULLS LAST, shipped_qty DESC) = 1",
        *INBOUND,
    ),
    "breakout_pivot": over_views("SELECT * FROM breakout", *BREAKOUT),
    "sort_breakout_output": over_views("SELECT * FROM breakout", *BREAKOUT),
    "load_lifecycle": over_lifecycle(
        f"SELECT {COLUMNS} FROM merged WHERE {KEPT} AND {FRESH}",
        text_keys=True,
    ),
    "load_backfill": over_lifecycle(f"SELECT {COLUMNS} FROM merged WHERE {KEPT}", text_keys=True),
    "pipe_load_changes": changes_into(f"SELECT {COLUMNS} FROM merged WHERE {KEPT} AND {FRESH}"),
    "pipe_backfill_changes": changes_into(f"SELECT {COLUMNS} FROM merged WHERE {KEPT}"),
    "str_incremental_upsert": over_lifecycle(f"SELECT {COLUMNS} FROM merged WHERE {KEPT}", text_keys=True),
    "str_upsert_bucketed": over_lifecycle(f"SELECT {COLUMNS} FROM merged WHERE {KEPT}", text_keys=True),
}
