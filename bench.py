"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all) choose data and
cores; names as arguments choose queries, ``all`` runs every one.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans import QUERIES
from millrace.session import local_session

HEADLINE = [
    "t01_tumbling_count",
    "t03_sliding_count",
    "t05_session_summary",
    "t06_unchanged_runs",
    "t07_grouped_within",
    "t09_timed_gate",
    "t10_rate_limit",
    "t12_conflate",
    "t13_running_set",
    "t14_capped_total",
    "w01_moving_average_ring",
    "w07_running_count_and_sum",
    "w14_monotonic",
    "a03_sum_every_n",
    "a10_histogram",
    "a15_percentiles",
    "j01_merge_join_pairwise",
    "j01_merge_join_relational",
    "j02_zip",
    "j03_latest_per_tick",
    "j04_asof",
    "j06_enrich_with_flag",
    "j07_point_in_polygon",
    "u05_distinct_first",
    "u06_distinct_in_last_n",
    "l04_retain_newest",
    "f01_decode_events",
    "v05_named_rules",
    "v08_ledger",
    "r03_consistent_hash",
    "g02_reachable",
    "g06_neighbours",
    "s08_journal_read",
    "x03_chunk_function",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session(int(cpus), "bench")
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["w07_running_count_and_sum"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    sf = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
