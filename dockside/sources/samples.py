"""Three-row sample batches per dataset, dated around ``as_of``."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dockside.functions.dates import as_day
from dockside.schemas import BREAKOUT_SCHEMA, INBOUND_SCHEMA

# Invented rows, column by column in table order, dates as days from ``as_of``.
INBOUND_ROWS = (
    ("22", "Alder Mills", "lamps", "P", "O", "A-7001", "A-7000", "lamp-05", "brass", "Desk lamp",
     3, 21, 64, 16, 4, 48, 8, "lamp-05", 12, -4, -3),
    ("110", "Birch & Co", "rugs", "R", "O", "B-7010", "B-7000", "rug-11", "woven", "Hall rug",
     5, 18, 90, 0, 9, 81, 0, "rug-11", 30, -6, -5),
    ("116", "Cedar Works", "chairs", "P", "D", "C-7020", "C-7000", "chair-2", "bent", "Side chair",
     8, 40, 24, 24, 0, 0, 24, "chair-2", 24, -2, -1),
)

# The same for the breakout; stores not named hold 0.
BREAKOUT_ROWS = (
    ("A-7000", "lamps", "Alder Mills", "lamp-05", "brass", "Desk lamp", -3, 3, 3, "22, 110"),
    ("B-7000", "rugs", "Birch & Co", "rug-11", "woven", "Hall rug", -7, 5, 5, "110"),
    ("C-7000", "chairs", "Cedar Works", "chair-2", "bent", "Side chair", -2, 8, 8, "116, 614"),
)
BREAKOUT_UNITS = ({"SD": 32, "IP": 16}, {"FFC": 45}, {"FFC_WEB": 12, "SD": 6})


def sample_frame(spark: SparkSession, schema: T.StructType, rows: list[dict], as_of: date | str) -> DataFrame:
    """Rows without a load time; numbers in date columns are days from ``as_of``."""
    today = as_day(as_of)
    dates = {f.name for f in schema.fields if isinstance(f.dataType, T.DateType)}
    dated = [{k: today + timedelta(v) if k in dates else v for k, v in row.items()} for row in rows]
    return spark.createDataFrame(dated, schema).drop("load_timestamp")


def sample_key(first: str, second: str, as_of: date | str, days: int) -> str:
    return f"{first}_{second}_{as_day(as_of) + timedelta(days):%Y%m%d}"


def inbound_sample(spark: SparkSession, as_of: date | str) -> DataFrame:
    rows = [dict(zip(INBOUND_SCHEMA.names, values)) for values in INBOUND_ROWS]
    for row in rows:
        row["record_key"] = sample_key(row["po"], row["sku"], as_of, row["expected_date"])
    return sample_frame(spark, INBOUND_SCHEMA, rows, as_of)


def breakout_sample(spark: SparkSession, as_of: date | str) -> DataFrame:
    rows = []
    for values, units in zip(BREAKOUT_ROWS, BREAKOUT_UNITS):
        row = dict(zip(BREAKOUT_SCHEMA.names, values))
        stores = BREAKOUT_SCHEMA.names[len(values) : -2]
        row |= {column: units.get(column, 0) for column in stores}
        row["record_key"] = sample_key(row["po_man"], row["sku_num"], as_of, row["exp_date"])
        rows.append(row)
    return sample_frame(spark, BREAKOUT_SCHEMA, rows, as_of)
