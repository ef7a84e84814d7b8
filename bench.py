"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the number of task threads.
Each query runs once to warm up, then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from dockside_checks.queries import QUERIES
from dockside.session import local_session, scratch_tables

HEADLINE = (
    "po_inbound",
    "po_inbound_dedup",
    "breakout_pivot",
    "load_lifecycle",
    "str_incremental_upsert",
    "mrg_upsert",
    "win_latest_per_key",
    "join_left_shipments_fanout",
    "join_allocation_chain",
    "agg_pivot_store",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(4):
            begun = time.perf_counter()
            with scratch_tables(spark):
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
