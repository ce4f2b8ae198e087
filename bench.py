"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
Every query runs twice, the first time to warm up; the second run counts, from
building the plan to the last row.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from fareway.registry.queries import all_queries
from fareway.session import create_session

HEADLINE = [
    "clean_trips_strict",
    "quality_report",
    "numeric_summary_exact",
    "hourly_metrics",
    "demand_features",
    "od_routes",
    "lineitem_hotspots",
    "lineitem_routes",
    "trip_headline",
    "top_zones",
    "dashboard_small",
    "congestion_alerts",
    "served_alerts",
    "stream_congestion_alerts",
    "numbered_events",
    "count_windows",
    "annotation_boxes",
    "background_boxes",
    "suppressed_boxes",
    "matched_boxes",
    "sampled_background",
    "stratified_split",
    "linear_scores",
    "mean_baseline_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="fareway-bench-")
    spark = create_session(
        "fareway-bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="12g",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
        spark__sql__shuffle__partitions=cpus,
        spark__checkpoint__dir=f"{scratch}/shared",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    result = {
        "metric": "headline queries, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
