"""The ten operational tables, and how to open them from files, a catalog or JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockside.functions.dates import DateWindow
from dockside.sources.naming import plain_names

# Columns the plans use, per logical table.
TABLE_COLUMNS = {
    "pohdr": ("po", "po_man", "pocode", "postr", "dateexp", "datecanc", "dateship"),
    "potype": ("po", "type"),
    "podtl": ("po", "sku", "oounit", "rcunit"),
    "skufile": ("sku", "style", "skudesc1", "ss", "vend"),
    "vendmain": ("vend", "vendname"),
    "purhst": ("po", "str", "datercv"),
    "invdtl": ("po", "sku", "unitinvc"),
    "asnhdr": ("asn", "po", "str", "shpnotcdt"),
    "asndtl": ("asn", "sku", "qty"),
    "wim": ("genasn", "po"),
}

# Columns the plans compare as numbers, and as days.
STORES = ("postr", "str")
DAYS = ("dateexp", "datecanc", "dateship", "datercv", "shpnotcdt")

# Second names, and the table each stands for.
SECOND_NAMES = {"family_hdr": "pohdr", "child_dtl": "podtl", "child_sku": "skufile"}


def typed(field: T.StructField) -> Column:
    """The column with the type the plans expect.

    A store that is no number, or a day that cannot be read, is NULL.  A column
    that has its type is passed as it is, so filters on it still reach the scan.
    """
    value, kind = F.col(field.name), field.dataType
    if field.name in STORES and not isinstance(kind, T.IntegralType):
        value = value.try_cast("bigint")
    elif field.name in DAYS and isinstance(kind, T.StringType):
        value = F.coalesce(value.try_cast("date"), F.try_to_date(value, "yyyyMMdd"))
    elif field.name in DAYS and not isinstance(kind, T.DateType):
        value = value.try_cast("date")
    return value.alias(field.name)


@dataclass(frozen=True)
class SourceTables:
    """Inputs of the plans, one DataFrame per logical table.

    Some tables are read under a second name by part of the queries; those
    default to the first.  Columns the plans do not know are left out; stores
    and days of another type are cast (see ``typed``).
    """

    pohdr: DataFrame  # order headers
    potype: DataFrame  # order types
    podtl: DataFrame  # order details
    skufile: DataFrame  # items
    vendmain: DataFrame  # vendors
    purhst: DataFrame  # receipts
    invdtl: DataFrame  # invoice details
    asnhdr: DataFrame  # shipment notices
    asndtl: DataFrame  # shipment notice details
    wim: DataFrame  # warehouse item history
    family_hdr: DataFrame | None = None
    child_dtl: DataFrame | None = None
    child_sku: DataFrame | None = None

    def __post_init__(self):
        for name in (*TABLE_COLUMNS, *SECOND_NAMES):
            first = SECOND_NAMES.get(name, name)
            rows = getattr(self, name)
            rows = getattr(self, first) if rows is None else rows
            chosen = rows.select(*TABLE_COLUMNS[first])
            object.__setattr__(self, name, chosen.select(*[typed(f) for f in chosen.schema.fields]))


@dataclass(frozen=True)
class TableRef:
    """Where one logical table lives: ``parquet`` path, ``table`` name, or ``jdbc``."""

    kind: str
    location: str
    options: Mapping[str, str] = field(default_factory=dict)


def jdbc_options(
    url: str,
    driver: str,
    partition_column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    fetch_size: int = 10_000,
    **more: str,
) -> dict[str, str]:
    """Options of a split read: ``partitions`` range queries run side by side.

    Filters and column lists are pushed into each of them.
    """
    return {
        "url": url,
        "driver": driver,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        **more,
    }


def open_table(spark: SparkSession, ref: TableRef) -> DataFrame:
    if ref.kind == "parquet":
        rows = spark.read.options(**ref.options).parquet(ref.location)
    elif ref.kind == "table":
        rows = spark.table(ref.location)
    elif ref.kind == "jdbc":
        rows = spark.read.format("jdbc").options(**ref.options).option("dbtable", ref.location).load()
    else:
        raise ValueError(f"unknown kind of table: {ref.kind}")
    return plain_names(rows)


def open_sources(spark: SparkSession, refs: Mapping[str, TableRef]) -> SourceTables:
    """Open every referenced table."""
    unknown = set(refs) - {f.name for f in fields(SourceTables)}
    if unknown:
        raise ValueError(f"unknown source tables: {sorted(unknown)}")
    return SourceTables(**{name: open_table(spark, ref) for name, ref in refs.items()})


def run_sql(spark: SparkSession, text: str, window: DateWindow | None = None, **frames: DataFrame) -> DataFrame:
    """SQL over the given frames, with ``:start_date`` and ``:end_date`` bound.

    The dates travel as typed parameters, never as text; frames are named in
    the query as ``{name}``.
    """
    dates = {"start_date": window.start, "end_date": window.end} if window else None
    return spark.sql(text, args=dates, **frames)
