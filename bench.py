"""Benchmark of the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:

    {"metric": "total_query_seconds", "value": N, "unit": "sec",
     "queries": {"name": sec, ...}, "sf": ...}

Each query is executed to completion with the ``noop`` sink (full plan, no
driver collect).  A warm-up pass of every query loads the JVM classes
first (on the sf0.001 tables) so the first timed query is not penalised.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "report_session_summary",
    "report_event_types",
    "report_daily_active_users",
    "report_top_brands",
    "report_rows_per_month",
    "features_session_orders",
    "features_merged",
    "scoring_batch",
    "eval_auc_ap",
    "shift_ks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    from shopsignals.plans.registry import REGISTRY
    from shopsignals.session import build_session

    spark = build_session(
        "shopsignals-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=max(cpus * 2, 8),
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    # warm-up on the smallest tables: loads classes and JIT-compiles the
    # generated code of every plan shape; nothing of the measured data is cached
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            REGISTRY[name].build(spark, warm_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.perf_counter()
        REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
