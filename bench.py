"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with the ``noop`` sink (full execution, nothing
collected). Model queries also include their fits, which run when the
query is built. Every query is first run once, untimed, on the sf0.001
tables so the timings are steady-state rather than JVM warm-up
(``BENCH_WARMUP=0`` to skip). ``BENCH_EVENT_LOG=<folder>`` writes Spark's
event log under a fresh sub-folder of it. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roomrate.plans.catalog import QUERIES  # noqa: E402
from roomrate.session import build_session  # noqa: E402

HEADLINE = [
    "prepare_listings",
    "frequency_filter_mean",
    "zscore_filter_by_group",
    "annotate_count",
    "semi_join_keys",
    "one_hot_multi",
    "bulk_cast",
    "overlay_prediction",
    "metric_summary",
    "assign_nearest",
    "comparables_report",
    "kmeans_sizes",
    "global_price_model",
    "per_group_metrics",
    "clustered_price_model",
    "leak_free_cluster_model",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        # stage/task timings for offline reading (the UI stays off)
        log_dir = tempfile.mkdtemp(prefix="roomrate-events-", dir=os.environ["BENCH_EVENT_LOG"])
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
        print(f"event log: {log_dir}", file=sys.stderr)
    spark = build_session(master=f"local[{cpus}]", app="roomrate-bench",
                          shuffle_partitions=int(cpus) * 2, extra=extra)
    # steady-state timing: run every query once on the smallest tables first
    # (JIT compilation, class loading, MLlib initialisation), untimed
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.environ.get("BENCH_WARMUP", "1") == "1":
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()   # nothing cached by the warm-up carries over
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    base = os.path.basename(sf_dir.rstrip("/"))
    try:
        sf = float(base[2:]) if base.startswith("sf") else base
    except ValueError:
        sf = base
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
