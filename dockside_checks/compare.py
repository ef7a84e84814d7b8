"""Run queries and their SQL side by side: ``python -m dockside_checks.compare [sf_dir] [names...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from dockside_checks.oracle import ORACLE
from dockside_checks.queries import QUERIES
from dockside.session import local_session

TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as text tuples, columns by name, in sorted order."""
    columns = sorted(frame.columns)

    def text(value) -> str:
        if value is None or value is pd.NaT or value is pd.NA or value != value:
            return "NULL"
        if hasattr(value, "isoformat"):
            return value.isoformat()[:10]
        if isinstance(value, float) and value == int(value):
            return str(int(value))
        return str(value)

    return sorted(tuple(text(v) for v in row) for row in frame[columns].itertuples(index=False))


def same(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> tuple[bool, str]:
    begun = time.time()
    mine = QUERIES[name](spark, sf_dir).toPandas()
    took = time.time() - begun
    theirs = con.execute(ORACLE[name]).df()
    note = f"{len(mine)} rows, {took:.1f} s"
    if sorted(mine.columns) != sorted(theirs.columns):
        return False, f"{note}; columns {sorted(mine.columns)} and {sorted(theirs.columns)}"
    a, b = canonical(mine), canonical(theirs)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return False, f"{note}; {len(b)} expected; only here {only_a}; only there {only_b}"
    return True, note


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session("compare")
    con = database(sf_dir)
    bad = 0
    for name in names:
        try:
            ok, note = same(spark, con, name, sf_dir)
        except Exception as problem:
            ok, note = False, f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
