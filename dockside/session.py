"""Session settings the plans count on, and the shared scratch tables."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from datetime import timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Joins too big to broadcast are shuffled on their key; a hot key is then split
# by AQE, also where an aggregate sits on top of the join (that costs one more
# shuffle, so Spark wants to be told).  What a task reads of a shuffle takes some
# thirty to ninety times as much memory in the sorts and hash tables of a join of
# sums, so AQE merges partitions to a sixteenth of its usual size.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Shuffle partitions per core: AQE merges small ones, but never splits the
# partitions of an aggregate, so a cluster starts with many.
PARTITIONS_PER_CORE = 8


def cluster_settings(cores: int) -> dict[str, str]:
    """Sizes for a cluster: few columns of wide files are read, so splits are big."""
    return {
        "spark.sql.shuffle.partitions": str(max(200, PARTITIONS_PER_CORE * cores)),
        "spark.sql.files.maxPartitionBytes": "512m",
    }


def tune(spark: SparkSession) -> SparkSession:
    """Set what the caller has left unset."""
    wanted = dict(RUNTIME_SETTINGS)
    context = spark.sparkContext
    if not context.master.startswith("local"):
        wanted.update(cluster_settings(context.defaultParallelism))
    for name, value in wanted.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


def local_session(name: str = "dockside", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    return tune(builder.getOrCreate())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the folder the cluster shares for checkpoints.

    Only a session without such a folder (a local test) gets one of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="dockside-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Scratch tables of the surrounding ``scratch_tables`` block, if there is one.
_OPEN_SCRATCH: ContextVar[list[str] | None] = ContextVar("open_scratch", default=None)

SCRATCH_DATABASE = "dockside_scratch"

#: No job and no reader of a result needs its scratch tables for longer.
SCRATCH_AGE = timedelta(days=7)


@contextmanager
def scratch_tables(spark: SparkSession):
    """Drop at the end what ``written`` makes inside the block."""
    made: list[str] = []
    token = _OPEN_SCRATCH.set(made)
    try:
        yield
    finally:
        _OPEN_SCRATCH.reset(token)
        for name in made:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def written(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a scratch table: computed once, read many times.

    Reads of it survive the loss of any executor, and its files tell Spark its
    true size.  Outside a ``scratch_tables`` block the table stays, since the
    result built on it is still to be read; ``sweep_scratch`` drops it once it is old.
    """
    spark = rows.sparkSession
    if not spark.catalog.databaseExists(SCRATCH_DATABASE):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DATABASE} LOCATION '{scratch_path(spark, 'dockside')}'")
    name = f"{SCRATCH_DATABASE}.{label}_{time.time_ns():020d}_{uuid.uuid4().hex}"
    made = _OPEN_SCRATCH.get()
    if made is not None:
        made.append(name)
    rows.write.format("parquet").saveAsTable(name)
    return spark.table(name)


def sweep_scratch(spark: SparkSession, older_than: timedelta = SCRATCH_AGE) -> int:
    """Drop scratch tables made longer ago than that, whose owner died or never closed them; returns how many."""
    if not spark.catalog.databaseExists(SCRATCH_DATABASE):
        return 0
    latest = time.time_ns() - older_than // timedelta(microseconds=1) * 1000
    names = [row["tableName"] for row in spark.sql(f"SHOW TABLES IN {SCRATCH_DATABASE}").collect() if not row["isTemporary"]]
    made = {name: name.rsplit("_", 2)[-2] for name in names if name.count("_") >= 2}
    old = [name for name, at in made.items() if at.isdigit() and int(at) < latest]
    for name in old:
        spark.sql(f"DROP TABLE IF EXISTS {SCRATCH_DATABASE}.{name}")
    return len(old)


def side_by_side(*jobs: Callable[[], Any]) -> list[Any]:
    """Results of jobs that do not wait for each other, submitted together."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(copy_context().run, job) for job in jobs]
        return [job.result() for job in running]
