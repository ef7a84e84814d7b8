"""A scheduled run: one or more datasets, each on its own, with a report."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from datetime import date, datetime, timedelta, timezone
from typing import Any

from pyspark.sql import SparkSession

from dockside.functions.dates import as_day, date_window
from dockside.plans.datasets import DatasetSpec, default_datasets, extract
from dockside.plans.refresh import load_batch
from dockside.session import scratch_tables, sweep_scratch, tune
from dockside.sinks.tables import create_tables
from dockside.sources.inputs import SourceTables

log = logging.getLogger(__name__)


def create_all(
    spark: SparkSession, database: str, datasets: Mapping[str, DatasetSpec] | None = None, location: str | None = None
) -> list[str]:
    """Create the missing tables of every dataset; returns the names created."""
    specs = (datasets or default_datasets()).values()
    return [name for spec in specs for name in create_tables(spark, database, spec, location)]


def run(
    spark: SparkSession,
    database: str,
    src: SourceTables | None,
    as_of: date | str,
    names: Iterable[str] | None = None,
    datasets: Mapping[str, DatasetSpec] | None = None,
    rolling: bool = True,
    start: date | str | None = None,
    end: date | str | None = None,
    use_merge: bool = True,
    samples: bool = False,
    stamp: datetime | None = None,
) -> dict[str, Any]:
    """Refresh the named datasets (all by default).

    A dataset that fails is reported and does not stop the others.  One failure
    is a partial failure; a second, or nothing but failures, is an error.
    Without a rolling window and a start date, the run covers yesterday.
    """
    tune(spark)
    specs = datasets or default_datasets()
    chosen = list(names) if names is not None else list(specs)
    unknown = [name for name in chosen if name not in specs]
    if unknown or not chosen:
        raise ValueError(f"unknown datasets {unknown}; known are {list(specs)}")
    day = as_day(as_of)
    window = date_window(day, rolling, start or day - timedelta(days=1), end)
    loaded_at = stamp or datetime.now(timezone.utc)
    report: dict[str, Any] = {
        "status": "success",
        "start_date": window.start.isoformat(),
        "end_date": window.end.isoformat(),
        "datasets": chosen,
        "rolling_window": rolling,
        "use_merge": use_merge,
        "samples": samples,
        "timestamp": loaded_at.isoformat(),
        "results": {},
    }
    try:
        sweep_scratch(spark)
    except Exception:
        log.exception("old scratch tables were not dropped")
    for name in chosen:
        spec = specs[name]
        notes: dict[str, Any] = {}
        try:
            with scratch_tables(spark):
                rows = spec.sample(spark, day) if samples else extract(spec, src, window)
                loaded = load_batch(spark, database, spec, rows, day, loaded_at, use_merge, notes)
            if loaded:
                outcome = {"status": "success", "rows_fetched": loaded, "rows_loaded": loaded, **notes}
            else:
                outcome = {"status": "no_data", "message": f"no {name} rows in the date range"}
        except Exception as problem:
            log.exception("dataset %s failed", name)
            outcome = {"status": "error", "error": str(problem), **notes}
            report["status"] = "partial_failure" if report["status"] == "success" else "error"
        report["results"][name] = outcome
    if all(outcome["status"] == "error" for outcome in report["results"].values()):
        report["status"] = "error"
    return report
