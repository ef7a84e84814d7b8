"""Upsert of arriving batches into a final table, as micro-batches."""

from __future__ import annotations

from datetime import date, timedelta
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from dockside.functions.dates import as_day
from dockside.plans.datasets import DatasetSpec, with_missing_keys
from dockside.plans.refresh import coerced
from dockside.sinks.states import merge_arrivals
from dockside.sinks.tables import appended, create_tables, of_batches, trim_staging


def apply_arrivals(
    rows: DataFrame, batch_id: str, database: str, spec: DatasetSpec, as_of: date | str
) -> None:
    """Stage one micro-batch and upsert the keys it brought.

    Arriving rows compete with the rows of the final table's state, so a late
    batch never overwrites a newer row; of staging only the batch itself is read,
    and of the final table only the buckets it touches are rewritten.  A replay of
    the same micro-batch replaces its staged rows and ends in the same state.  Rows
    without a key get the dataset's own.  Batches that are no longer recent are
    staged only.  Staged rows outside the retention window go once their batch is
    no longer recent; until then they still win over late batches.  Stale removal
    expects complete batches and is left out.
    """
    spark = rows.sparkSession
    staged = appended(spark, database, spec, with_missing_keys(coerced(rows, spec), spec), batch_id)
    if not staged:
        return
    oldest = as_day(as_of) - timedelta(days=spec.recent_days)
    recent = [b for b in staged if b.load_date >= oldest]
    merge_arrivals(spark, database, spec, of_batches(spark, database, spec, recent).select(*spec.schema.names), as_of)
    if spec.cleanup_staging:
        trim_staging(spark, database, spec, as_of, spec.recent_days)


def upsert_stream(
    spark: SparkSession,
    database: str,
    spec: DatasetSpec,
    landing: str,
    checkpoint: str,
    as_of: date | str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Work through the stamped parquet batches in ``landing``, then stop.

    A staged batch is named after the checkpoint and its number there, which a
    replay repeats and another stream cannot.
    """
    create_tables(spark, database, spec)
    stream = sha256(checkpoint.encode()).hexdigest()[:16]
    arriving = spark.readStream.schema(spec.schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    return (
        arriving.writeStream.queryName(f"{spec.name}_upserts")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(
            lambda rows, number: apply_arrivals(rows, f"{stream}{number:012d}", database, spec, as_of)
        )
        .trigger(availableNow=True)
        .start()
    )
