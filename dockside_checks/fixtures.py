"""The given tables, seen as operational tables and as load batches.

Every view keeps all rows of its kind and gives them the gaps the operators must
handle: orders without a type, an item filed under another number, blank and
missing managing orders, warehouse history without a notice, receipts without a
day, invoices and notices without units.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockside.functions.dates import DateWindow, utc_day
from dockside.plans.datasets import DatasetSpec
from dockside.rules import OrderRules
from dockside.schemas import table_schema
from dockside.sources.inputs import SourceTables

WINDOW = DateWindow(date(1997, 7, 1), date(1999, 6, 30))
RULES = OrderRules(
    dc_stores=(2, 5, 8, 11, 14, 17, 20),
    store_columns=tuple((store, f"s{store}") for store in range(25)),
)
ORDERS_AS_OF = date(1998, 6, 30)
EVENTS_AS_OF = date(2024, 1, 30)
SEED_BEFORE = date(2024, 1, 10)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sources(spark: SparkSession, sf_dir: str) -> SourceTables:
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    order_day = F.col("o_orderdate").cast("date")
    customer = F.col("o_custkey")
    units = F.col("l_quantity").cast("bigint")
    order, item = F.col("l_orderkey"), F.col("l_partkey")
    notice = order * 10 + F.col("l_linenumber") % 3
    notices = lineitem.groupBy(notice.alias("asn"), order.alias("po"), (order % 25).alias("str")).agg(
        F.max(F.col("l_shipdate").cast("date")).alias("shpnotcdt")
    )
    return SourceTables(
        pohdr=orders.select(
            F.col("o_orderkey").alias("po"),
            F.when(customer % 13 == 0, "   ")
            .when(customer % 17 == 0, None)
            .otherwise(F.concat(F.lit("M"), customer.cast("string")))
            .alias("po_man"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "O")
            .when(F.col("o_orderpriority") == "2-HIGH", "D")
            .otherwise("X")
            .alias("pocode"),
            (F.col("o_orderkey") % 25).alias("postr"),
            order_day.alias("dateexp"),
            F.date_add(order_day, 30).alias("datecanc"),
            F.date_sub(order_day, 5).alias("dateship"),
        ),
        potype=orders.select(
            F.col("o_orderkey").alias("po"),
            F.when(F.col("o_orderkey") % 19 == 0, None)
            .when(F.col("o_orderstatus") == "F", "P")
            .when(F.col("o_orderstatus") == "O", "C")
            .when(F.col("o_orderstatus") == "P", "R")
            .alias("type"),
        ),
        podtl=lineitem.select(
            order.alias("po"),
            item.alias("sku"),
            units.alias("oounit"),
            F.when(F.col("l_linestatus") == "F", units).otherwise(0).alias("rcunit"),
        ),
        skufile=table(spark, sf_dir, "part").select(
            F.when(F.col("p_partkey") == 49, -49).otherwise(F.col("p_partkey")).alias("sku"),
            F.col("p_brand").alias("style"),
            F.col("p_name").alias("skudesc1"),
            F.col("p_type").alias("ss"),
            (F.col("p_partkey") % 10).alias("vend"),
        ),
        vendmain=table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("vend"), F.col("s_name").alias("vendname")
        ),
        purhst=lineitem.select(
            order.alias("po"),
            (order % 25).alias("str"),
            F.when(F.col("l_returnflag") == "R", F.col("l_shipdate").cast("date")).alias("datercv"),
        ),
        invdtl=lineitem.select(
            order.alias("po"), item.alias("sku"), F.when(F.col("l_linestatus") == "F", units).alias("unitinvc")
        ),
        asnhdr=notices,
        asndtl=lineitem.select(
            notice.alias("asn"), item.alias("sku"), F.when(F.col("l_returnflag") != "N", units).alias("qty")
        ),
        wim=notices.select(F.when(F.col("asn") % 2 == 0, F.col("asn")).alias("genasn"), "po"),
    )


EVENTS = DatasetSpec(
    name="events",
    staging_table="events_staging",
    final_table="events_final",
    schema=table_schema(
        "record_key string, business_date date, event_id bigint, value double, ts timestamp_ntz, "
        "load_timestamp timestamp"
    ),
    date_column="business_date",
    newest_first=("load_timestamp", "ts", "event_id"),
)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a staged row; each day is one batch."""
    events = table(spark, sf_dir, "events")
    event = F.col("event_id")
    day = F.col("ts").cast("date")
    key = F.concat(F.col("user_id").cast("string"), F.lit("_"), F.col("event_type"))
    shifted = F.date_add(day, (event % 121 - 45).cast("int"))
    midnight = F.timestamp_seconds(F.unix_date(day) * F.lit(86400).cast("bigint"))
    return events.select(
        F.when(event % 31 != 0, key).alias("record_key"),
        F.when(event % 29 != 0, shifted).alias("business_date"),
        event.alias("event_id"),
        "value",
        "ts",
        midnight.alias("load_timestamp"),
        day.alias("load_date"),
    )


def shown(rows: DataFrame) -> DataFrame:
    """Timestamps as UTC days, for comparison."""
    return rows.select(
        "record_key", "business_date", "event_id", "value", utc_day(F.col("load_timestamp")).alias("load_date")
    )
