"""Benchmark the headline queries.

/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` (default 8), each fully
executed into the ``noop`` sink, ``$BENCH_RUNS`` times (default 3); reports
the median per query and their sum as ONE JSON line.  As in the baseline,
the feeds are recomputed from the source tables on every run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_checkpoints", "gold_user_team_metrics", "gold_team_summary", "team_daily",
    "team_dashboard", "scd2_history", "scd2_collapsed", "scd2_asof", "daily_counts",
    "null_profile", "dup_bronze", "dup_lookup", "processing_lag", "orphan_threads",
    "latest_bronze",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from threadlens.session import build_session
    from threadlens.plans.catalog import QUERIES

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    names = sys.argv[1:] or HEADLINE
    # one untimed warm-up of the JVM/codegen path
    QUERIES["dup_bronze"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        samples = []
        try:
            for _ in range(runs):
                t = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t)
            timings[name] = round(statistics.median(samples), 3)
        except Exception as e:  # keep measuring the others; report the failure
            timings[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(v for v in timings.values() if v is not None), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
