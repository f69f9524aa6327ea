"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with a no-op sink (every row produced, none
collected), ``$BENCH_REPEATS`` times (default 2); the fastest run counts.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "mart_penetration",
    "mart_phone_quality",
    "stg_cases",
    "stg_case_attributes",
    "stg_dialer",
    "stg_contacts",
    "latest_per_key",
    "contact_stats",
    "reconcile_counts",
    "reconcile_rows",
    "dq_report",
    "extraction_cost",
    "full_reload_pull",
    "incremental_pull",
    "leak_findings",
    "zorder_key",
    "watermark_history",
    "ingest_all",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tidemark.plans.catalog import QUERIES
    from tidemark.session import local_session

    n_cpus = (os.cpu_count() or 8) if cpus == "*" else int(cpus)
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", n_cpus)),
                          app="tidemark-bench")
    # Warm-up on a different, tiny dataset: JIT and code generation are warm as
    # in a long-running session; no data of the measured scale is cached.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for key in HEADLINE:
            QUERIES[key](spark, warm_dir).write.format("noop").mode("overwrite").save()

    # Best of ``repeats`` runs per query (plan building included), to damp machine noise.
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    times: dict[str, float] = {}
    for key in HEADLINE:
        best = None
        for _ in range(repeats):
            t0 = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - t0
            best = took if best is None else min(best, took)
        times[key] = round(best, 3)

    cost = QUERIES["extraction_cost"](spark, sf_dir).collect()[0]
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "repeats": repeats,
        "extraction_rows_full": cost["full_rows"],
        "extraction_rows_incremental": cost["incremental_rows"],
        "extraction_ratio": cost["ratio"],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
