"""Benchmark the headline workloads.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``,
executing the full plan into the ``noop`` sink (no driver collection), and prints one JSON
line: {"metric", "value" (sum of per-query medians), "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from geomedallion.plans.workloads import WORKLOADS  # noqa: E402
from geomedallion.session import local_session  # noqa: E402

HEADLINE = [
    "gold_fact",
    "nearest_location",
    "nearest_event_location",
    "nearest_location_chunked",
    "location_fact",
    "bin_join_candidates",
    "flatten_events",
    "flatten_weather",
    "dedup_by_key",
    "merge_upsert",
    "merge_upsert_watermarked",
    "incremental_extract",
    "date_dimension",
    "row_hash_id",
    "duplicate_keys",
    "silver_layer",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in WORKLOADS]
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    timings: dict[str, float] = {}
    for name in names:
        samples = []
        for i in range(runs + 1):  # first run warms the JVM and file caches, not counted
            t0 = time.perf_counter()
            WORKLOADS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0 or runs == 0:
                samples.append(dt)
        timings[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {timings[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
