"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (warm runs per query, default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse.plans import all_queries  # noqa: E402
from tallyhouse.session import build_session  # noqa: E402

HEADLINE = [
    "star_department_category",
    "star_suppressed_team_category",
    "snowflake_division_rollup",
    "rollup_build",
    "rollup_read",
    "cube_rollup",
    "suppressed_cuts",
    "k_anonymize",
    "generalize",
    "dedup_latest",
    "silver_responses",
    "team_overview_metrics",
    "dq_suite",
    "question_metrics",
    "percentiles",
    "percent_rank_departments",
    "eav_pivot",
    "wide_from_eav",
    "encoding_equivalence",
    "scd2_from_log",
    "scd2_asof_join",
    "mv_incremental_equals_full",
    "upsert",
    "clustered_read",
    "team_overview_flat",
    "scope_status",
    "ttl_replay",
    "driver_correlations",
    "chi_squared",
    "served_read",
    "stream_gold",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = all_queries(), {}
    picked = sys.argv[1:] or HEADLINE
    for name in picked:
        samples = []
        for run in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:  # the first run warms up
                samples.append(time.perf_counter() - start)
        times[name] = round(statistics.median(samples), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
