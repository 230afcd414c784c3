"""Measure the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3; the median after one warm-up run counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from graphtide.plans.queries import REGISTRY
from graphtide.session import local_session

HEADLINE = [
    "envelope_decode", "normalize_changes", "fan_out", "scope_feed", "edge_rows_rank",
    "vertex_state", "edge_state", "edge_state_rank", "bootstrap_state", "merged_state", "late_change",
    "vertex_lookup", "edge_fetch", "one_hop", "graph_stats", "reconcile",
    "render_timestamps", "geometry_gate", "stream_vertex_state", "stream_resume",
]


def measure(spark, run, sf_dir: str, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        # The noop sink computes every row without moving it to the driver.
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return statistics.median(times[1:])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    times = {name: round(measure(spark, REGISTRY[name], sf_dir, runs), 3) for name in names}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
