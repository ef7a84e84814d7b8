"""Final tables: states made of versioned key buckets.

A final table is a view over a table of buckets, partitioned by bucket (a hash of
the record key) and version.  A state names one version per bucket.  An update
writes new versions of the buckets it touches, notes the new state, then replaces
the view; all other buckets keep their files.  Readers see the old or the new
state, never one in between, and a job that dies leaves the old one in place.
The last few states are kept, so a reader of one finishes while others are
published; what no kept state names is dropped.

A state also holds a floor: dated rows below it are gone for readers at once and
leave their files when their bucket is next rewritten.  Each version's counts and
range of days tell which buckets need that.

Hidden rows are won contests of rows outside the retention window: a late, older
row of the same key still loses to them while their batch is recent.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockside.functions.dates import as_day, date_window, utc_day
from dockside.operators.latest import latest_per_key
from dockside.operators.retention import inside_window
from dockside.plans.datasets import KEY, STAMP, DatasetSpec

BUCKET, VERSION, HIDDEN, STATE = "bucket", "version", "hidden", "state"


def final_name(database: str, spec: DatasetSpec) -> str:
    return f"{database}.{spec.final_table}"


def data_name(database: str, spec: DatasetSpec) -> str:
    return f"{final_name(database, spec)}__buckets"


def states_name(database: str, spec: DatasetSpec) -> str:
    return f"{final_name(database, spec)}__states"


def new_version() -> str:
    """Sorts by time; its age can be read from it."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def age_of(version: str) -> timedelta:
    return timedelta(microseconds=(time.time_ns() - int(version.split("-")[0])) // 1000)


@dataclass(frozen=True)
class Part:
    """One version of a bucket: rows that readers may see, those without a day, and the range of days."""

    bucket: int
    version: str
    rows: int
    undated: int
    least_day: date | None
    greatest_day: date | None


@dataclass(frozen=True)
class State:
    """``kept`` names this state and those before it that are still readable, newest first."""

    buckets: int
    parts: tuple[Part, ...] = ()
    floor: date | None = None
    kept: tuple[str, ...] = ()


def columns_sql(spec: DatasetSpec) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)


def create_final(spark: SparkSession, database: str, spec: DatasetSpec) -> bool:
    """Make what is missing; whether the final table was."""
    if spark.catalog.tableExists(final_name(database, spec)):
        return False
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {data_name(database, spec)} ({columns_sql(spec)}, {HIDDEN} boolean, "
        f"{BUCKET} int, {VERSION} string) USING parquet PARTITIONED BY ({BUCKET}, {VERSION})"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {states_name(database, spec)} ({BUCKET} int, {VERSION} string, rows bigint, "
        f"undated bigint, least_day date, greatest_day date, {STATE} string) USING parquet PARTITIONED BY ({STATE})"
    )
    show(spark, database, spec, State(spec.buckets))
    return True


def read_final(spark: SparkSession, database: str, spec: DatasetSpec) -> DataFrame:
    return spark.table(final_name(database, spec))


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.hash(F.col(KEY)), F.lit(buckets)).cast("int")


def of_parts(parts: list[Part] | tuple[Part, ...]) -> str:
    """Predicate on the partitions of these parts; buckets of one version stand together."""
    versions: dict[str, list[int]] = {}
    for part in parts:
        versions.setdefault(part.version, []).append(part.bucket)
    each = [f"({VERSION} = '{v}' AND {BUCKET} IN ({', '.join(map(str, sorted(b)))}))" for v, b in sorted(versions.items())]
    return f"({' OR '.join(each)})" if each else "false"


def seen(spec: DatasetSpec, floor: date | None) -> str:
    """Predicate on what readers may see of a part."""
    above = f" AND (`{spec.date_column}` IS NULL OR `{spec.date_column}` >= DATE '{floor}')" if floor else ""
    return f"NOT {HIDDEN}{above}"


def show(spark: SparkSession, database: str, spec: DatasetSpec, state: State) -> None:
    """Switch readers to ``state``: one statement."""
    noted = {"states": ",".join(state.kept), "buckets": state.buckets, "floor": state.floor or ""}
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in noted.items())
    names = ", ".join(f"`{c}`" for c in spec.schema.names)
    spark.sql(
        f"CREATE OR REPLACE VIEW {final_name(database, spec)} TBLPROPERTIES ({properties}) AS "
        f"SELECT {names} FROM {data_name(database, spec)} WHERE {of_parts(state.parts)} AND {seen(spec, state.floor)}"
    )


def parts_of(spark: SparkSession, database: str, spec: DatasetSpec, names: tuple[str, ...]) -> dict[str, list[Part]]:
    """Parts of the named states, a row per bucket each."""
    found: dict[str, list[Part]] = {name: [] for name in names}
    name = states_name(database, spec)
    spark.catalog.refreshTable(name)
    for row in spark.table(name).where(F.col(STATE).isin(*names)).collect() if names else []:
        found[row[STATE]].append(Part(*[row[c] for c in (BUCKET, VERSION, "rows", "undated", "least_day", "greatest_day")]))
    return found


def current_state(spark: SparkSession, database: str, spec: DatasetSpec) -> State:
    properties = {p["key"]: p["value"] for p in spark.sql(f"SHOW TBLPROPERTIES {final_name(database, spec)}").collect()}
    kept = tuple(n for n in properties["states"].split(",") if n)
    parts = parts_of(spark, database, spec, kept[:1])
    floor = date.fromisoformat(properties["floor"]) if properties["floor"] else None
    return State(int(properties["buckets"]), tuple(parts[kept[0]]) if kept else (), floor, kept)


def write_buckets(spark: SparkSession, database: str, spec: DatasetSpec, rows: DataFrame, buckets: int) -> list[Part]:
    """``rows`` (the schema's columns and ``hidden``) as a new version of their buckets."""
    name, version = data_name(database, spec), new_version()
    ready = rows.select(*spec.schema.names, HIDDEN, bucket_of(buckets).alias(BUCKET), F.lit(version).alias(VERSION))
    # Few files per bucket; a large bucket is still written by many tasks.
    ready.hint("rebalance", F.col(BUCKET)).write.insertInto(name)
    day, visible = F.col(spec.date_column), ~F.col(HIDDEN)
    stats = spark.table(name).where(F.col(VERSION) == version).groupBy(BUCKET).agg(
        F.count_if(visible).alias("rows"),
        F.count_if(visible & day.isNull()).alias("undated"),
        F.min(F.when(visible, day)).alias("least_day"),
        F.max(F.when(visible, day)).alias("greatest_day"),
    )
    return [Part(r[BUCKET], version, r["rows"], r["undated"], r["least_day"], r["greatest_day"]) for r in stats.collect()]


def switch(
    spark: SparkSession, database: str, spec: DatasetSpec, before: State, parts: list[Part], floor: date | None, buckets: int
) -> str:
    """Note a state of ``parts``, show it, and drop what only states beyond ``keep_states`` name."""
    state = new_version()
    rows = [(p.bucket, p.version, p.rows, p.undated, p.least_day, p.greatest_day, state) for p in parts]
    name = states_name(database, spec)
    spark.createDataFrame(rows, spark.table(name).schema).coalesce(1).write.insertInto(name)
    kept, gone = (state, *before.kept)[: spec.keep_states], (state, *before.kept)[spec.keep_states :]
    show(spark, database, spec, State(buckets, tuple(parts), floor, kept))
    if gone:
        named = parts_of(spark, database, spec, kept + gone)
        live = {(p.bucket, p.version) for n in kept for p in named[n]}
        dead = {(p.bucket, p.version) for n in gone for p in named[n]} - live
        drop_partitions(spark, data_name(database, spec), [f"{BUCKET} = {b}, {VERSION} = '{v}'" for b, v in sorted(dead)])
        drop_partitions(spark, name, [f"{STATE} = '{n}'" for n in gone])
    return state


def drop_partitions(spark: SparkSession, table: str, partitions: list[str]) -> None:
    """In one statement."""
    if partitions:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(f'PARTITION ({p})' for p in partitions)}")


def partitions_of(spark: SparkSession, table: str) -> list[dict[str, str]]:
    listed = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return [{k: unquote(v) for k, v in (x.split("=", 1) for x in parts)} for parts in listed]


def publish(spark: SparkSession, database: str, spec: DatasetSpec, rows: DataFrame) -> str:
    """Replace the whole table by ``rows``; returns the new state's name."""
    create_final(spark, database, spec)
    before = current_state(spark, database, spec)
    parts = write_buckets(spark, database, spec, rows.withColumn(HIDDEN, F.lit(False)), spec.buckets)
    return switch(spark, database, spec, before, parts, None, spec.buckets)


def contested(old: DataFrame, arrivals: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The winner per key of ``old`` (with ``hidden``) and ``arrivals``, with ``came``: whether its key arrived.

    Both hold a key at most once.  The order is that of ``latest_per_key``.
    """
    names = spec.schema.names
    order = [*spec.newest_first, *[c for c in names if c != KEY and c not in spec.newest_first]]
    both = old.select(*names, HIDDEN, F.lit(False).alias("came")).unionByName(
        arrivals.select(*names, F.lit(False).alias(HIDDEN), F.lit(True).alias("came"))
    )
    best = F.max_by(F.struct(*names, HIDDEN), F.struct(*order)).alias("best")
    won = both.where(F.col(KEY).isNotNull()).groupBy(F.col(KEY).alias("_key")).agg(best, F.max("came").alias("came"))
    # Rows without a key match nothing and stay on both sides.
    return won.select("best.*", "came").unionByName(both.where(F.col(KEY).isNull()))


def merge_arrivals(spark: SparkSession, database: str, spec: DatasetSpec, arrivals: DataFrame, as_of: date | str) -> str:
    """Upsert recent ``arrivals`` (the schema's columns) against the rows of the state, rewriting only touched buckets.

    The columns of ``newest_first``, load time first, are part of each row, so the
    state itself tells whether an arriving row is newer; staging is not read.
    """
    before = current_state(spark, database, spec)
    oldest = as_day(as_of) - timedelta(days=spec.recent_days)
    window = date_window(as_of, back=spec.days_back, forward=spec.days_forward)
    newest = latest_per_key(arrivals.where(utc_day(F.col(STAMP)) >= F.lit(oldest)), KEY, spec.newest_first)
    touched = {r[BUCKET] for r in newest.select(bucket_of(before.buckets).alias(BUCKET)).distinct().collect()}
    floor = before.floor
    if spec.cleanup_final:
        # Days in front of the window that were let in before, and a window that moves back, need their rows rewritten.
        back = floor is not None and window.start < floor
        touched |= {p.bucket for p in before.parts if back or (p.greatest_day is not None and p.greatest_day > window.end)}
        floor = window.start
    inside = inside_window(F.col(spec.date_column), as_of, spec.days_back, spec.days_forward) if spec.cleanup_final else F.lit(True)
    recent = F.coalesce(utc_day(F.col(STAMP)) >= F.lit(oldest), F.lit(False))

    rewritten = [p for p in before.parts if p.bucket in touched]
    below = ~F.expr(seen(spec, before.floor))
    old = spark.table(data_name(database, spec)).where(of_parts(rewritten)).withColumn(HIDDEN, below)
    rows = contested(old.where(~F.col(HIDDEN) | recent), newest, spec)
    gone = F.when(F.col("came"), ~inside).otherwise(F.col(HIDDEN) | ~inside)
    rows = rows.withColumn(HIDDEN, gone).where(~F.col(HIDDEN) | recent)
    parts = write_buckets(spark, database, spec, rows, before.buckets)
    stay = [p for p in before.parts if p.bucket not in touched]
    return switch(spark, database, spec, before, stay + parts, floor, before.buckets)


def sweep_final(spark: SparkSession, database: str, spec: DatasetSpec) -> int:
    """Drop versions that no kept state names and that are older than ``orphan_age``; returns how many.

    Jobs that died before their switch leave such versions; a job at work is younger.
    """
    kept = current_state(spark, database, spec).kept
    live = {(str(p.bucket), p.version) for parts in parts_of(spark, database, spec, kept).values() for p in parts}
    data, states = data_name(database, spec), states_name(database, spec)
    dead = [p for p in partitions_of(spark, data) if (p[BUCKET], p[VERSION]) not in live and age_of(p[VERSION]) > spec.orphan_age]
    drop_partitions(spark, data, [f"{BUCKET} = {p[BUCKET]}, {VERSION} = '{p[VERSION]}'" for p in dead])
    old = [p for p in partitions_of(spark, states) if p[STATE] not in kept and age_of(p[STATE]) > spec.orphan_age]
    drop_partitions(spark, states, [f"{STATE} = '{p[STATE]}'" for p in old])
    return len(dead) + len(old)
