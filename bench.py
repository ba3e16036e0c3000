"""Time the headline queries; one JSON line comes out.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs once
to warm up and is then timed over a full run into the ``noop`` sink, plan
building and eager steps included.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyline.bindings import load  # noqa: E402
from tallyline.session import build_session  # noqa: E402

HEADLINE = [
    "trend_counts", "trend_counts_events", "outcome_rates", "incident_stats", "derived_key_counts", "metric_correlation",
    "hotspots", "nearest_center", "dedupe_key", "mode_per_group", "hop_counts", "trailing_count", "trailing_emits",
    "alert_rows", "clean_incidents", "stream_parse", "run_ledger_state", "staged_publish",
    "stream_alerts", "csv_scan", "batch_run", "serve_live_counts", "run_row_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load().QUERIES
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            begun = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begun, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds_of_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
