"""Benchmark: run every registered query at $BENCH_SF_DIR on
local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full through the ``noop`` sink (the whole plan
runs, nothing is collected to the driver).  A warm-up pass runs every query
once on the smallest scale factor (JIT, generated-code cache, Python
workers), then each query is timed once at ``$BENCH_SF_DIR``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from eventide.plans.catalog import spark_queries
    from eventide.session import get_session

    spark = get_session(f"local[{cpus}]", app="eventide-bench", shuffle_partitions=int(cpus))
    qs = spark_queries()
    names = only or sorted(qs)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.environ.get("BENCH_WARMUP", "1") == "1" and os.path.isdir(warm_dir):
        for name in names:
            try:
                qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001 - reported by the timed run
                pass
    else:
        qs["win_tumbling_avg"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": int(cpus), "n_queries": len(times)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
