"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` timed runs
of each query after one warm-up (default 1; the median is reported).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "district_review",
    "clean_address",
    "nfkc_clean",
    "attach_geocode",
    "parse_geocode",
    "snapshot_delta_nullsafe",
    "upsert_rows",
    "upsert_rows_delta",
    "classify_changes",
    "cascade_reset",
    "enqueue",
    "sample_pending",
    "miss_runs",
    "batch_running_totals",
    "prefix_assemble",
    "first_by_key",
    "tag_two_tier",
    "tag_explain",
    "tag_explain_join",
    "mine_bigrams",
    "mine_words",
    "master_summary",
    "full_refresh",
    "verify_hits",
    "stream_ingest",
)


def main() -> None:
    from rollbook.session import local_session
    from suite import all_queries

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cores, "rollbook-bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "registry_headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
