"""Scheduled jobs: ``spark-submit`` this, or ``python -m dockside``.

    run --database orders --sources tables.json
    run --database orders --sources tables.json --dataset po \\
        --fixed-window --start-date 2024-01-01 --end-date 2024-01-31 --append-only
    create-tables --database orders --location /warehouse/orders

The sources file maps logical tables to {"kind", "location", "options"}.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import SparkSession

from dockside.functions.dates import as_day
from dockside.plans.datasets import default_datasets
from dockside.plans.runs import create_all, run
from dockside.sources.inputs import TableRef, open_sources


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dockside")
    jobs = top.add_subparsers(dest="job", required=True)
    refresh = jobs.add_parser("run", help="refresh staging and final tables")
    refresh.add_argument("--database", required=True)
    refresh.add_argument("--sources", type=Path, help="JSON file; not needed with --samples")
    refresh.add_argument("--dataset", choices=list(default_datasets()), action="append", help="all by default")
    refresh.add_argument("--as-of", type=as_day, default=None, help="day of the run; today (UTC) by default")
    refresh.add_argument("--fixed-window", action="store_true", help="use the given dates, not the rolling window")
    refresh.add_argument("--start-date", type=as_day, help="yesterday by default")
    refresh.add_argument("--end-date", type=as_day, help="the start date by default")
    refresh.add_argument("--append-only", action="store_true", help="grow staging, leave the final table")
    refresh.add_argument("--samples", action="store_true", help="load the sample batches")
    create = jobs.add_parser("create-tables", help="create missing tables")
    create.add_argument("--database", required=True)
    create.add_argument("--location", help="folder of the database, if it is new")
    return top


def main(arguments: list[str] | None = None) -> int:
    """Print the report as JSON; 0 unless the run as a whole failed."""
    given = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("dockside").getOrCreate()
    if given.job == "create-tables":
        report = {"status": "success", "created_tables": create_all(spark, given.database, location=given.location)}
    else:
        if not (given.sources or given.samples):
            raise SystemExit("run needs --sources or --samples")
        refs = json.loads(given.sources.read_text()) if given.sources else {}
        report = run(
            spark,
            given.database,
            open_sources(spark, {name: TableRef(**ref) for name, ref in refs.items()}) if refs else None,
            given.as_of or datetime.now(timezone.utc).date(),
            names=given.dataset,
            rolling=not given.fixed_window,
            start=given.start_date,
            end=given.end_date,
            use_merge=not given.append_only,
            samples=given.samples,
        )
    print(json.dumps(report))
    return 1 if report["status"] == "error" else 0


if __name__ == "__main__":
    sys.exit(main())
