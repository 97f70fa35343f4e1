"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Mirrors the baseline probe: the GMV snapshot and the contribution margin at
three cutoffs (1998-07-01, 1998-08-01, 2002-01-01), each collected, JVM warm,
logs derived from the test tables inside each query; plus the three
snapshots in one job; plus a daily D-1 run against a stored RAW store, full
and incremental from the stored D-2 snapshot (store written untimed).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tempora import schemas as S  # noqa: E402
from tempora.functions.rules import RunParams  # noqa: E402
from tempora.operators import gmv, incremental, margin  # noqa: E402
from tempora.plans import jobs  # noqa: E402
from tempora.session import get_session, scratch_path  # noqa: E402
from tempora.sinks.raw import append_raw, raw_path  # noqa: E402
from tempora.sources.testdata import DERIVERS, cdc_logs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

RUNS = {"r1": RunParams.for_day("1998-06-30"), "r2": RunParams.for_day("1998-07-31"),
        "all": RunParams.for_day("2001-12-31")}


def main() -> None:
    spark = get_session(f"local[{CPUS}]", CPUS, app_name="tempora-bench",
                        extra={"spark.driver.memory": "16g"})
    logs = cdc_logs(spark, SF_DIR)

    def snapshot(run, src=None):
        return lambda: gmv.gmv_snapshot(src or logs, run).collect()

    def margin_at(run):
        return lambda: margin.contribution_margin(logs, run.cutoff_ts).collect()

    # warm-up: JIT and file metadata, untimed
    gmv.gmv_snapshot(logs, RUNS["r1"]).collect()

    # Untimed setup for the RAW-store queries: the logs as a production RAW store in three deliveries (up to the day
    # before the run, the run's own arrivals, what comes later), silver merged up to the first, and the stored D-1 snapshot.
    raw_root, day_before = scratch_path(spark, "bench-raw"), RunParams.for_day("1998-07-30")
    cuts = [F.lit(r.cutoff_literal).cast("timestamp_ntz") for r in (day_before, RUNS["r2"])]
    ing = F.col("ingestion_ts")
    for t in (S.PURCHASE, S.EXTRA, S.ITEM):
        log = DERIVERS[t](spark, SF_DIR)
        for part in (log.where(ing < cuts[0]), log.where((ing >= cuts[0]) & (ing < cuts[1])), log.where(ing >= cuts[1])):
            append_raw(spark, part, raw_path(raw_root, t), t)
    stored = jobs.raw_logs(spark, raw_root, jobs.SNAPSHOT_LOGS)
    silver = jobs.silver_store(spark, raw_root)
    silver.refresh(raw_root, dict.fromkeys(jobs.SNAPSHOT_LOGS, 1))
    prev = gmv.gmv_snapshot(stored, day_before).checkpoint(eager=True)

    plan = {f"gmv_snapshot_{k}": snapshot(r) for k, r in RUNS.items()}
    plan.update({f"contribution_margin_{k}": margin_at(r) for k, r in RUNS.items()})
    plan["multi_snapshot_3"] = lambda: gmv.multi_snapshot(logs, list(RUNS.values())).collect()
    # Daily D-1 run on the stored tables: full recompute; incremental from silver with the day's delivery and the D-2 snapshot.
    plan["raw_store_full_r2"] = snapshot(RUNS["r2"], stored)
    plan["raw_store_incremental_r2"] = lambda: incremental.incremental_from(
        silver.with_recent(raw_root, dict.fromkeys(jobs.SNAPSHOT_LOGS, 2)), jobs.arrivals(stored, day_before, RUNS["r2"], dict.fromkeys(jobs.SNAPSHOT_LOGS, 1)), prev, RUNS["r2"]).collect()

    times = {}
    for name, fn in plan.items():
        t = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t, 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": CPUS}))
    spark.stop()


if __name__ == "__main__":
    main()
