"""Seconds per headline query: median of repeated runs after one warm-up run."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from proofline.plans.queries import registered  # noqa: E402
from proofline.session import local_session  # noqa: E402

HEADLINE = [
    "settlement_range",
    "daily_settlement_whole",
    "daily_summary_calendar",
    "derive_batches",
    "derive_settlements",
    "match_loss",
    "fingerprint",
    "profile_diff",
    "row_diff",
    "row_diff_narrowed",
    "hash_tree_diff",
    "verification_checks",
    "as_of_many",
    "partition_counts",
    "reconcile_orphans",
    "apply_changes",
    "change_history",
    "full_refresh",
    "partitioned_export",
    "replicate_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not wanted else sorted(registered()) if wanted == "all" else wanted.split(",")
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = registered(), {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:] or times), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
