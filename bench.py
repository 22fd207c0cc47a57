"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (every row is
computed, nothing is collected to the driver).  One warm-up pass, then the
timed pass (best of $BENCH_REPEAT).  Prints one JSON line.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chronofeat.queries import QUERIES  # noqa: E402
from chronofeat.session import local_session  # noqa: E402

HEADLINE = [
    "pit_ttl", "pit_join_strategy", "pit_created", "pit_no_ttl", "pit_multi_view",
    "pit_fused_views", "pit_entityless", "pit_role_twice", "pull_latest", "pull_latest_created", "pull_all",
    "latest_per_key", "dedup_keep_last", "materialize_merge", "snapshot_lookup", "sort_rank",
]


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = local_session(cpus, shuffle_partitions=max(2 * cpus, 8), app="chronofeat-bench")
    for n in names:                       # warm-up: JIT, file listing, Python workers
        run(QUERIES[n](spark, sf_dir))
    times = {}
    for n in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(QUERIES[n](spark, sf_dir))
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[n] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
