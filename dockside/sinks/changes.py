"""What an update of a final table did to its rows, counted from the two states."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockside.operators.retention import inside_window
from dockside.plans.datasets import KEY, STAMP, DatasetSpec
from dockside.sinks.states import Part, State, data_name, of_parts, seen

#: What may become of a row.
CHANGES = ("unchanged", "replaced", "added", "out_of_window", "stale")


def rows_of(spark: SparkSession, database: str, spec: DatasetSpec, parts: list[Part], floor: date | None) -> DataFrame:
    """Key, day and load time of what readers see of these parts."""
    rows = spark.table(data_name(database, spec)).where(of_parts(parts)).where(seen(spec, floor))
    return rows.select(KEY, F.col(spec.date_column).alias("day"), F.col(STAMP).alias("loaded"))


def state_changes(
    spark: SparkSession, database: str, spec: DatasetSpec, before: State, after: State, as_of: date | str
) -> DataFrame:
    """Rows per change (change, rows) from one kept state to another, 0 included.

    A key of both states is ``replaced`` if its load time changed, else ``unchanged``;
    a key of the new state alone is ``added``.  A row that went is ``out_of_window`` if
    its day lies outside the final table's window, else ``stale``: the load holds it no
    longer.  Rows without a key are matched by day and load time, as often as both
    states hold them.

    Parts that both states name are taken from their counts and not opened; of the
    others three columns are read, and sums per key combine before the shuffle.  Both
    states are files, so the counts are the same when tasks or the job are repeated.
    """

    def whole(part: Part) -> bool:
        floors = [f for f in (before.floor, after.floor) if f is not None]
        return part.least_day is None or all(part.least_day >= floor for floor in floors)

    shared = {(p.bucket, p.version) for p in before.parts} & {(p.bucket, p.version) for p in after.parts if whole(p)}
    untouched = sum(p.rows for p in after.parts if (p.bucket, p.version) in shared)

    def rest(state: State, side: int) -> DataFrame:
        parts = [p for p in state.parts if (p.bucket, p.version) not in shared]
        rows = rows_of(spark, database, spec, parts, state.floor)
        return rows.withColumns({"was": F.lit(1 - side), "stays": F.lit(side)})

    both = rest(before, 0).unionByName(rest(after, 1))
    old = F.col("was") == 1
    keys = both.groupBy(KEY, F.when(F.col(KEY).isNull(), F.struct("day", "loaded")).alias("twin")).agg(
        F.sum("was").alias("was"),
        F.sum("stays").alias("stays"),
        F.max(F.when(old, F.col("day"))).alias("day"),
        F.max(F.when(old, F.col("loaded"))).alias("old_loaded"),
        F.max(F.when(~old, F.col("loaded"))).alias("new_loaded"),
    )
    matched = F.least("was", "stays")
    gone = F.col("was") - matched
    same = F.col("old_loaded").eqNullSafe(F.col("new_loaded"))
    inside = inside_window(F.col("day"), as_of, spec.days_back, spec.days_forward) if spec.cleanup_final else F.lit(True)
    counts = {
        "unchanged": F.when(same, matched),
        "replaced": F.when(~same, matched),
        "added": F.col("stays") - matched,
        "out_of_window": F.when(~inside, gone),
        "stale": F.when(inside, gone),
    }
    first = {"unchanged": untouched}
    totals = keys.agg(*[(F.coalesce(F.sum(counts[c]), F.lit(0)) + first.get(c, 0)).cast("bigint").alias(c) for c in CHANGES])
    return totals.unpivot([], list(CHANGES), "change", "rows")


def counted_changes(
    spark: SparkSession, database: str, spec: DatasetSpec, before: State, after: State, as_of: date | str
) -> dict[str, int]:
    return {r["change"]: r["rows"] for r in state_changes(spark, database, spec, before, after, as_of).collect()}
