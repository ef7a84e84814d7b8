"""Declared schemas of the target tables: the one place they are written down."""

from __future__ import annotations

from pyspark.sql import types as T

from dockside.rules import STORE_COLUMNS

KINDS = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def table_schema(columns: str) -> T.StructType:
    """Schema from "name type, name type, ..."; needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in pairs])


# Names, types and order of the target columns.
INBOUND_SCHEMA = table_schema(
    "store string, vendor string, ss string, type string, po_code string, po string, po_man string, "
    "sku string, style string, skudesc1 string, expected_date date, cancel_date date, ooqty bigint, "
    "rcvdqty bigint, breakoutqty bigint, allocated bigint, unitinvc_per_sku bigint, shipped_sku string, "
    "shipped_qty bigint, latest_datercv date, shipnotice_date date, record_key string, load_timestamp timestamp"
)

BREAKOUT_SCHEMA = table_schema(
    "po_man string, ss_num string, vendor string, sku_num string, style string, skudesc string, "
    "ship_date date, exp_date date, parent_exp_date date, parent_stores string, "
    + ", ".join(f"{column} bigint" for _, column in STORE_COLUMNS)
    + ", record_key string, load_timestamp timestamp"
)
