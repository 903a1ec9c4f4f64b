"""Benchmark: run every registered query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query's plan is executed completely with the ``noop`` sink (no driver collect), so the
time is the engine's work. Prints ONE JSON line:
``{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (best of N, default 1), BENCH_QUERIES (comma list, default all).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "1")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from brandpulse.session import get_spark
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = get_spark(f"local[{cpus}]", app="brandpulse-bench", shuffle_partitions=max(8, 2 * cpus), extra=extra)
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="brandpulse-bench-"))

    from brandpulse.plans import catalog
    names = only or list(catalog.REGISTRY)

    # warm-up: every query once on the smallest input (JVM class loading, codegen caches),
    # so that the timed run measures the work at the target scale, not the first compile
    warm = "/root/testdata/sf0.001"
    warmup_errors: dict[str, str] = {}
    if os.path.isdir(warm) and os.environ.get("BENCH_WARMUP", "1") == "1":
        for name in names:
            try:
                catalog.REGISTRY[name].run(spark, warm).write.format("noop").mode("overwrite").save()
            except Exception as e:  # reported; the timed run decides
                warmup_errors[name] = repr(e)[:300]

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        best = None
        for _ in range(repeats):
            t0 = time.perf_counter()
            try:
                df = catalog.REGISTRY[name].run(spark, sf_dir)
                df.write.format("noop").mode("overwrite").save()
            except Exception as e:  # keep benchmarking the others, report the failure
                errors[name] = repr(e)[:300]
                best = None
                break
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        if best is not None:
            times[name] = round(best, 3)
        print(f"# {name}: {times.get(name, 'ERROR')}", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
    }
    if errors:
        out["errors"] = errors
    if warmup_errors:
        out["warmup_errors"] = warmup_errors
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
