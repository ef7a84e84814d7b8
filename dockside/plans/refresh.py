"""From a raw batch to the next state of a final table."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date, datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockside.functions.coerce import to_day, to_integer, to_text
from dockside.operators.filters import recent_batches
from dockside.operators.latest import latest_per_key
from dockside.operators.retention import delete_out_of_window
from dockside.operators.upsert import upsert_newest
from dockside.plans.datasets import KEY, STAMP, DatasetSpec, with_key
from dockside.plans.misfits import MisfitError, counted, keep_rejected
from dockside.sinks.changes import counted_changes
from dockside.sinks.states import current_state
from dockside.sinks.tables import (
    LOAD_DAY,
    append_batch,
    batch_id_of,
    create_tables,
    newest_staged,
    publish,
    read_final,
    read_staging,
    trim_staging,
)


log = logging.getLogger(__name__)


def coerced(rows: DataFrame, spec: DatasetSpec, strict: bool = True) -> DataFrame:
    """Every declared column that is present, in its declared type; ``strict`` as in ``to_integer``."""
    given = {f.name: f.dataType for f in rows.schema.fields}
    changes = {}
    for name in set(spec.columns_of(T.LongType)) & given.keys():
        changes[name] = to_integer(F.col(name), given[name], name, strict)
    for name in set(spec.columns_of(T.DateType)) & given.keys():
        changes[name] = to_day(F.col(name), given[name])
    for name in set(spec.columns_of(T.StringType)) & given.keys():
        changes[name] = to_text(F.col(name))
    return rows.withColumns(changes) if changes else rows


def prepared(rows: DataFrame, spec: DatasetSpec, stamp: datetime, strict: bool = True) -> DataFrame:
    """A batch ready for staging: typed, keyed, stamped, in schema order."""
    ready = with_key(coerced(rows, spec, strict), spec).withColumn(STAMP, F.lit(stamp))
    absent = {f.name: F.lit(None).cast(f.dataType) for f in spec.schema.fields if f.name not in ready.columns}
    return (ready.withColumns(absent) if absent else ready).select(*spec.schema.names)


def newest_stamp(staging: DataFrame, spec: DatasetSpec, as_of: date | str) -> int | None:
    """Load time, in microseconds, of the newest batch that staging retention leaves."""
    left = delete_out_of_window(staging, spec.date_column, as_of) if spec.cleanup_staging else staging
    return left.agg(F.unix_micros(F.max(STAMP)).alias("newest")).first()["newest"]


def next_final(
    final: DataFrame, staging: DataFrame, spec: DatasetSpec, as_of: date | str, newest: Callable[[], int | None] | None = None
) -> DataFrame:
    """The final table after upsert of the recent batches, retention and stale removal.

    ``staging`` comes with its load day; ``newest`` tells the newest load time that
    staging retention leaves, where that is known without a look at all of it.  The deletes are moved ahead of the
    upsert, which gives the same rows: an old row that they delete would be
    replaced or deleted afterwards, and a staged row older than the newest batch
    would be deleted afterwards.  So a nightly run reads the newest batch, and
    next to nothing of the old state, instead of two weeks of batches and all of it.
    """

    def in_time(rows: DataFrame) -> DataFrame:
        if not spec.cleanup_final:
            return rows
        return delete_out_of_window(rows, spec.date_column, as_of, spec.days_back, spec.days_forward)

    recent = recent_batches(staging, as_of, spec.recent_days, LOAD_DAY)
    newest = (newest() if newest else newest_stamp(staging, spec, as_of)) if spec.cleanup_stale else None
    if newest is None:
        return in_time(upsert_newest(in_time(final), recent, KEY, spec.newest_first))

    stamp = F.timestamp_micros(F.lit(newest))
    newest_day = datetime.fromtimestamp(newest // 1_000_000, timezone.utc).date()
    fresh = recent.where((F.col(LOAD_DAY) >= F.lit(newest_day)) & (F.col(STAMP) >= stamp))
    latest = latest_per_key(fresh.select(*spec.schema.names), KEY, spec.newest_first)
    old = in_time(final.where(F.col(STAMP).isNull() | (F.col(STAMP) >= stamp)))
    if old.isEmpty():
        return in_time(latest)
    # Any recent batch replaces the old row of its keys, also one that goes stale.
    untouched = old.join(recent.select(KEY).distinct(), KEY, "left_anti").select(*spec.schema.names)
    return in_time(untouched.unionByName(latest))


def load_batch(
    spark: SparkSession,
    database: str,
    spec: DatasetSpec,
    rows: DataFrame,
    as_of: date | str,
    stamp: datetime,
    use_merge: bool = True,
    notes: dict[str, Any] | None = None,
) -> int:
    """Append a batch and bring the final table up to date; returns rows loaded.

    The new state is live before its changes are counted and staging is trimmed.
    With ``notes`` these hold the rows of the final table by what became of them
    ("final_rows", where the old state is kept) and the number of staged rows that
    went; a failure of either step is noted instead and the load stands.

    A batch with numbers that no BIGINT holds is refused as a whole: it is written but
    never noted in the ledger, its misfits are counted on the way, and their rows
    are kept beside staging before the load fails with ``MisfitError``.

    An empty batch leaves both tables as they are.  Without ``use_merge`` only
    staging grows.
    """
    create_tables(spark, database, spec)
    batch_id = batch_id_of(stamp)
    watched, seen = counted(rows, spec)

    def refuse_misfits() -> None:
        if seen is not None and seen.get.get("refused"):
            counts = keep_rejected(spark, database, spec, rows, batch_id)
            if notes is not None:
                notes["violations"] = counts
            raise MisfitError(counts)

    loaded = append_batch(spark, database, spec, prepared(watched, spec, stamp, strict=False), batch_id, refuse_misfits)
    if loaded and use_merge:
        staging = read_staging(spark, database, spec, with_load_day=True)
        newest = lambda: newest_staged(spark, database, spec, as_of)
        before = current_state(spark, database, spec)
        publish(spark, database, spec, next_final(read_final(spark, database, spec), staging, spec, as_of, newest))
        if notes is not None and spec.keep_states > 1:
            try:
                after = current_state(spark, database, spec)
                notes["final_rows"] = counted_changes(spark, database, spec, before, after, as_of)
            except Exception as problem:
                log.exception("changes of %s were not counted", spec.name)
                notes["final_rows"] = f"failed: {problem}"
        if spec.cleanup_staging:
            try:
                deleted = trim_staging(spark, database, spec, as_of)
                if notes is not None:
                    notes["staging_rows_deleted"] = deleted
            except Exception as problem:
                if notes is None:
                    raise
                log.exception("staging of %s was not trimmed", spec.name)
                notes["cleanup"] = f"failed: {problem}"
    return loaded
