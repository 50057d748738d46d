"""Benchmark: headline pipeline runs and every report query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_WARM (warm repetitions per query, default 1; the median is kept).
Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

Timed work is executed with the no-op sink (full plan, no result transfer
to Python), so it measures Spark, not Python row conversion.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    warm = int(os.environ.get("BENCH_WARM", "1"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from lanecast.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app_name="lanecast-bench")
    from lanecast.plans import catalog, pipeline as P
    from lanecast.sources import fixtures as fx

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    cold: dict[str, float] = {}

    def timed(name, fn, reps=1):
        samples = []
        for i in range(1 + reps):
            t0 = time.perf_counter()
            fn()
            samples.append(time.perf_counter() - t0)
        cold[name] = round(samples[0], 3)
        times[name] = round(statistics.median(samples[1:]) if reps else samples[0], 3)

    spark.range(1).count()  # JVM / session warm-up, not timed

    # 1. full build: driver tables -> raw -> staging (stored) -> mart (stored)
    def full_build():
        root = P._root(spark, sf_dir, f"bench-{time.time_ns()}")
        P.run_full(spark, fx.full_load(spark, sf_dir), root, fx.FULL_LOAD_DATE)
    timed("full_build", full_build, reps=warm)

    # 2. mart alone from the stored staging layer
    staged = P.materialised_staging(spark, sf_dir)
    timed("mart_compute", lambda: run(P.build_mart(staged, P.M.MartParams(load_date=fx.FULL_LOAD_DATE))),
          reps=warm)

    # 3. batch 1 as a full build, then batch 2 as an incremental run
    #    (raw merge, staging upsert, affected-day mart recompute, snapshots)
    for i in range(1 + warm):
        root = P._root(spark, sf_dir, f"bench-inc-{time.time_ns()}")
        b1, b2 = fx.batches(spark, sf_dir)
        t0 = time.perf_counter()
        P.run_full(spark, b1, root, fx.BATCH1_LOAD_DATE)
        t1 = time.perf_counter()
        P.run_incremental(spark, b2, root, fx.BATCH2_LOAD_DATE, P.SNAPSHOT_TS)
        t2 = time.perf_counter()
        if i == 0:
            cold["batch1_full"], cold["batch2_incremental"] = round(t1 - t0, 3), round(t2 - t1, 3)
        times["batch1_full"], times["batch2_incremental"] = round(t1 - t0, 3), round(t2 - t1, 3)

    # 4. every registered query (reports read the stored mart)
    P.materialised_mart(spark, sf_dir)
    skip = {"daily_lane_equipment_prices"}  # = mart_compute
    for key, fn in catalog.QUERIES.items():
        if key in skip:
            continue
        timed(key, lambda fn=fn: run(fn(spark, sf_dir)), reps=warm)

    # keys whose warm time is a read of a stored result, not the operator
    stored = sorted(k for k in times if k.startswith("stg_") or k in (
        "charges_upsert", "mart_upsert", "coverage_snapshot", "coverage_log", "coverage_changes", "extract_mart"))
    total = round(sum(v for k, v in times.items()), 3)
    print(json.dumps({
        "metric": "total_warm_sec", "value": total, "unit": "sec",
        "queries": times, "cold": cold, "sf": sf, "cpus": cpus, "warm_reps": warm,
        "stored_reads": stored,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
