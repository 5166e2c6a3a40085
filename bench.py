"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default: the headline set below).
Each query runs to completion into the ``noop`` sink (full execution, no
collect); the time includes planning.  A warm-up pass runs every headline
query once on sf0.001 first, so one-time JVM and code-generation costs are
not charged to whichever query happens to come first.  ``machine_sec`` is the
time of a fixed computation that reads nothing and uses no code of the
library: between two runs it tells how much of a difference is the machine's.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sharelens.plans import QUERIES  # noqa: E402
from sharelens.session import get_spark  # noqa: E402

HEADLINE = [
    "daily_share",        # A1 + W3 (entry)
    "e2e_share",          # E1: charts -> metadata -> labels -> share fact
    "e2e_ownership",      # E2: dump -> relations -> graph -> label dimension
    "e2e_signals",        # E3: share series -> features -> returns join
    "incremental_share",  # E4 / S9
    "ownership_path",     # G7 walk
    "ownership_orders",   # G2-G6 with every order as a label (166k labels at sf0.1)
    "link_tracks",        # J1 + W1
    "rolling_signals",    # W4-W6
    "lead_lag",           # W9
    "corr_matrix",        # A9
    "series_describe",    # A6 exact quantiles
    "classify_rules",     # P8-P11 over whole documents
    "normalize_text",     # P2 over whole documents
]


def machine_seconds(spark) -> float:
    """Best of three runs over 200 million numbers."""
    best = float("inf")
    for _ in range(3):
        t0 = time.perf_counter()
        spark.range(200_000_000).selectExpr("sum(xxhash64(id) % 1000)", "sum(sqrt(id))").collect()
        best = min(best, time.perf_counter() - t0)
    return best


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = get_spark("sharelens-bench", cpus=cpus, shuffle_partitions=int(cpus) * 2)
    for name in names:
        QUERIES[name].build(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    machine = machine_seconds(spark)
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "machine_sec": round(machine, 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
