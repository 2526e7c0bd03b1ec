"""Headline-query benchmark: one JSON line with seconds per query.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (optional comma list of keys).
Each query is run to completion with the ``noop`` sink (full execution, no
collect), after one warm-up run of a small query to start the JVM.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flyway.plans.registry import QUERIES  # noqa: E402
from flyway.session import local_session  # noqa: E402

HEADLINE = [
    "observer_year_summary", "transitions", "temporal_features", "geo_features",
    "popularity_metrics", "cooc_metrics", "neighbor_cosine_metrics", "cross_validate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="flyway-bench")
    QUERIES["year_profile"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for k in keys:
        t0 = time.perf_counter()
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
        print(f"{k}: {times[k]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
