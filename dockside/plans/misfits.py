"""Numbers that no BIGINT holds unchanged: counted while a batch is staged, their rows kept aside.

A load with such rows fails, but only after all of them are counted and stand in
a side table of staging, so one look tells what to mend.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkValueError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockside.functions.coerce import WHOLE_KINDS, is_misfit
from dockside.plans.datasets import DatasetSpec

BATCH = "batch_id"


class MisfitError(PySparkValueError):
    """A batch was refused; ``counts`` has the number of misfits of each column that holds any."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        super().__init__("; ".join(f"{name}: not a whole number in {n} rows" for name, n in counts.items()))


def rejected_name(database: str, spec: DatasetSpec) -> str:
    return f"{database}.{spec.staging_table}__rejected"


def misfits(rows: DataFrame, spec: DatasetSpec) -> dict[str, Column]:
    """Per BIGINT column of the schema whose raw values may not fit: whether the value does not."""
    given = {f.name: f.dataType for f in rows.schema.fields}
    names = [n for n in spec.columns_of(T.LongType) if n in given and not isinstance(given[n], WHOLE_KINDS)]
    return {n: is_misfit(F.col(n), given[n]) for n in names}


def violations(rows: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Misfits of each column that may hold any (column_name, misfits), 0 included, in one pass over ``rows``."""
    found = misfits(rows, spec)
    if not found:
        return rows.sparkSession.createDataFrame([], "column_name string, misfits bigint")
    counts = rows.agg(*[F.count_if(test).alias(name) for name, test in found.items()])
    return counts.unpivot([], list(found), "column_name", "misfits")


def counted(rows: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, Observation | None]:
    """``rows``, and what will know under "refused" how many of them hold a misfit once they are written."""
    tests = list(misfits(rows, spec).values())
    if not tests:
        return rows, None
    seen = Observation()
    return rows.observe(seen, F.count_if(reduce(Column.__or__, tests)).alias("refused")), seen


def keep_rejected(
    spark: SparkSession, database: str, spec: DatasetSpec, rows: DataFrame, batch_id: str
) -> dict[str, int]:
    """Write the rows that hold misfits, as JSON beside the columns at fault; returns misfits per column.

    Written again, a batch replaces its own rejected rows.
    """
    name, found = rejected_name(database, spec), misfits(rows, spec)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (columns array<string>, raw string, {BATCH} string) "
        f"USING parquet PARTITIONED BY ({BATCH})"
    )
    at_fault = F.array_compact(F.array(*[F.when(test, F.lit(column)) for column, test in found.items()]))
    raw = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    refused = rows.select(at_fault.alias("columns"), raw.alias("raw"), F.lit(batch_id).alias(BATCH)).where(F.size("columns") > 0)
    refused.write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)
    kept = spark.table(name).where(F.col(BATCH) == batch_id).select(F.explode("columns").alias("column"))
    return {r["column"]: r["count"] for r in kept.groupBy("column").count().orderBy("column").collect()}
