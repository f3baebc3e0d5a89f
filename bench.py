"""Benchmark the headline queries.

Runs each query of HEADLINE on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8): one warm-up and three timed runs into the
``noop`` sink, median per query.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "validate_all_failures",
    "profile_row_health",
    "issues_all",
    "clean_full",
    "mask_full",
    "clean_audit_counts",
    "profile_key_uniqueness_lineitem",
    "pii_text_scan_documents",
    "ext_referential_orphans",
    "ext_zscore_outliers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from veridq.plans.queries import all_queries
    from veridq.session import local_session

    spark = local_session(cpus=cpus, shuffle_partitions=max(cpus, 8))
    qs = all_queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
