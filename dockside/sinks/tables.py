"""Staging tables in the session catalog, and the ledger of their batches.

Staging is a parquet table partitioned by load day, batch and version.  The
ledger is an append-only table with an entry per written partition: its rows,
those without a business day, the range of their days, and the newest load time.
The last entry of a load day and batch names the version that counts, so an
append, a repeated batch or a trim takes effect with its ledger entries, written
together as one file.  What no entry names is never read and is dropped once it is old.

Entries tell which partitions a trim or a look for the newest batch has to open.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone
from time import time_ns

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockside.functions.dates import DateWindow, as_day, date_window, utc_day
from dockside.operators.retention import inside_window
from dockside.plans.datasets import STAMP, DatasetSpec
from dockside.sinks.states import (
    VERSION,
    age_of,
    columns_sql,
    create_final,
    drop_partitions,
    final_name,
    new_version,
    partitions_of,
    publish,
    read_final,
)

__all__ = ["append_batch", "create_tables", "final_name", "publish", "read_final", "read_staging", "staging_name", "trim_staging"]

LOAD_DAY = "load_date"
BATCH = "batch_id"


def staging_name(database: str, spec: DatasetSpec) -> str:
    return f"{database}.{spec.staging_table}"


def ledger_name(database: str, spec: DatasetSpec) -> str:
    return f"{staging_name(database, spec)}__ledger"


def batch_id_of(stamp: datetime) -> str:
    return stamp.astimezone(timezone.utc).strftime("%Y%m%d%H%M%S%f")


@dataclass(frozen=True)
class Batch:
    """What the ledger says of one staged partition."""

    load_date: date
    batch_id: str
    version: str
    rows: int
    undated: int
    least_day: date | None
    greatest_day: date | None
    newest_micros: int | None

    def within(self, window: DateWindow) -> bool:
        """All rows stay in the window (rows without a day always do)."""
        return self.least_day is None or (window.start <= self.least_day and self.greatest_day <= window.end)

    def outside(self, window: DateWindow) -> bool:
        """No row stays."""
        return not self.undated and self.least_day is not None and (self.greatest_day < window.start or self.least_day > window.end)


def create_tables(spark: SparkSession, database: str, spec: DatasetSpec, location: str | None = None) -> list[str]:
    """Create what is missing, empty; returns the names created."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    created = []
    staging = staging_name(database, spec)
    if not spark.catalog.tableExists(staging):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {ledger_name(database, spec)} ({LOAD_DAY} date, {BATCH} string, {VERSION} string, "
            "rows bigint, undated bigint, least_day date, greatest_day date, newest_micros bigint, noted bigint) USING parquet"
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {staging} ({columns_sql(spec)}, {LOAD_DAY} date, {BATCH} string, {VERSION} string) "
            f"USING parquet PARTITIONED BY ({LOAD_DAY}, {BATCH}, {VERSION})"
        )
        created.append(staging)
    if create_final(spark, database, spec):
        created.append(final_name(database, spec))
    return created


# --- ledger --------------------------------------------------------------------


def ledger(spark: SparkSession, database: str, spec: DatasetSpec) -> DataFrame:
    """The entry that counts for each load day and batch."""
    name = ledger_name(database, spec)
    spark.catalog.refreshTable(name)
    rows = spark.table(name)
    last = F.max_by(F.struct(*[c for c in rows.columns if c not in (LOAD_DAY, BATCH)]), "noted").alias("last")
    return rows.groupBy(LOAD_DAY, BATCH).agg(last).select(LOAD_DAY, BATCH, "last.*").where(F.col("rows") > 0).drop("noted")


def batches(spark: SparkSession, database: str, spec: DatasetSpec) -> list[Batch]:
    """One per staged partition that counts."""
    return [Batch(*row) for row in ledger(spark, database, spec).collect()]


def note(spark: SparkSession, database: str, spec: DatasetSpec, entries: list[Batch]) -> None:
    """Write entries to the ledger, all or none."""
    if entries:
        name, now = ledger_name(database, spec), time_ns()
        rows = [(*(getattr(e, f) for f in Batch.__dataclass_fields__), now) for e in entries]
        spark.createDataFrame(rows, spark.table(name).schema).coalesce(1).write.insertInto(name)


def versioned(rows: DataFrame, write: str) -> DataFrame:
    """``rows`` (with load day and batch) under a version that no other partition has."""
    version = F.concat_ws(".", F.lit(write), F.date_format(LOAD_DAY, "yyyyMMdd"), F.col(BATCH))
    return rows.withColumn(VERSION, version)


def write_staged(spark: SparkSession, database: str, spec: DatasetSpec, rows: DataFrame) -> list[Batch]:
    """``rows`` (the schema's columns, load day, batch) as new partitions; returns their entries, not noted yet."""
    name, write = staging_name(database, spec), new_version()
    versioned(rows, write).write.insertInto(name)
    day = F.col(spec.date_column)
    stats = (
        spark.table(name)
        .where(F.col(VERSION).startswith(write))
        .groupBy(LOAD_DAY, BATCH, VERSION)
        .agg(F.count("*"), F.count_if(day.isNull()), F.min(day), F.max(day), F.unix_micros(F.max(STAMP)))
    )
    return [Batch(*row) for row in stats.collect()]


# --- staging -------------------------------------------------------------------


def of_batches(spark: SparkSession, database: str, spec: DatasetSpec, wanted: list[Batch]) -> DataFrame:
    """The partitions of these batches, all columns; no other one is opened."""
    rows = spark.table(staging_name(database, spec))
    return rows.where(F.col(VERSION).isin(*[b.version for b in wanted]) if wanted else F.lit(False))


def read_staging(spark: SparkSession, database: str, spec: DatasetSpec, with_load_day: bool = False) -> DataFrame:
    rows = of_batches(spark, database, spec, batches(spark, database, spec))
    return rows.select(*spec.schema.names, *([LOAD_DAY] if with_load_day else []))


def append_batch(
    spark: SparkSession,
    database: str,
    spec: DatasetSpec,
    rows: DataFrame,
    batch_id: str,
    check: Callable[[], None] | None = None,
) -> int:
    """Write one stamped batch to staging; returns its row count.

    Written again, a batch replaces its own rows of the same load days.  ``check`` is
    called when all rows are written and none counts yet; if it raises, none ever does.
    """
    return sum(b.rows for b in appended(spark, database, spec, rows, batch_id, check))


def appended(
    spark: SparkSession,
    database: str,
    spec: DatasetSpec,
    rows: DataFrame,
    batch_id: str,
    check: Callable[[], None] | None = None,
) -> list[Batch]:
    """Like ``append_batch``, but returns the partitions written."""
    unstamped = F.raise_error(F.lit("a staged row needs a load time")).cast("date")
    stamped = (
        rows.select(*spec.schema.names)
        .withColumn(LOAD_DAY, F.coalesce(utc_day(F.col(STAMP)), unstamped))
        .withColumn(BATCH, F.lit(batch_id))
    )
    entries = write_staged(spark, database, spec, stamped)
    if check is not None:
        check()
    note(spark, database, spec, entries)
    return entries


def newest_staged(spark: SparkSession, database: str, spec: DatasetSpec, as_of: date | str) -> int | None:
    """Load time, in microseconds, of the newest row that staging retention leaves.

    By the ledger; opened are only batches that may hold a newer row than all
    batches that stay whole, and of which rows go.
    """
    known = batches(spark, database, spec)
    window = date_window(as_of)
    whole = [b for b in known if not spec.cleanup_staging or b.within(window)]
    newest = max((b.newest_micros for b in whole), default=None)
    unsure = [b for b in known if b not in whole and not b.outside(window)]
    unsure = [b for b in unsure if newest is None or b.newest_micros > newest]
    found = []
    if unsure:
        stays = of_batches(spark, database, spec, unsure).where(inside_window(F.col(spec.date_column), as_of))
        found.append(stays.agg(F.unix_micros(F.max(STAMP))).first()[0])
    return max((f for f in [*found, newest] if f is not None), default=None)


def trim_staging(
    spark: SparkSession, database: str, spec: DatasetSpec, as_of: date | str, settled_days: int | None = None
) -> int:
    """Delete staged rows outside the retention window; returns how many went.

    By the ledger: batches wholly outside go unopened, those partly outside are
    written anew under another version, no other partition is touched.  All of it
    takes effect with the ledger entries; a job that dies before has changed
    nothing.  With ``settled_days`` only batches loaded more than so many days
    before ``as_of`` are looked at.  Versions that stopped counting some time ago
    are dropped on the way.
    """
    window, day = date_window(as_of), as_day(as_of)
    known = [b for b in batches(spark, database, spec) if not b.within(window)]
    if settled_days is not None:
        known = [b for b in known if (day - b.load_date).days > settled_days]
    mixed = [b for b in known if not b.outside(window)]
    left: list[Batch] = []
    if mixed:
        stays = of_batches(spark, database, spec, mixed).where(inside_window(F.col(spec.date_column), as_of))
        left = write_staged(spark, database, spec, stays.drop(VERSION))
    named = {(b.load_date, b.batch_id) for b in left}
    emptied = [b for b in known if (b.load_date, b.batch_id) not in named]
    note(spark, database, spec, left + [Batch(b.load_date, b.batch_id, b.version, 0, 0, None, None, None) for b in emptied])
    sweep_staging(spark, database, spec)
    return sum(b.rows for b in known) - sum(b.rows for b in left)


def sweep_staging(spark: SparkSession, database: str, spec: DatasetSpec) -> int:
    """Drop partitions that the ledger does not name and that are older than ``orphan_age``; returns how many.

    A version that has just stopped counting stays for readers at work.
    """
    name = staging_name(database, spec)
    live = {b.version for b in batches(spark, database, spec)}
    dead = [p for p in partitions_of(spark, name) if p[VERSION] not in live and age_of(p[VERSION]) > spec.orphan_age]
    drop_partitions(spark, name, [f"{LOAD_DAY} = DATE '{p[LOAD_DAY]}', {BATCH} = '{p[BATCH]}', {VERSION} = '{p[VERSION]}'" for p in dead])
    return len(dead)
