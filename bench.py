"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3; the best run of each query is reported).
Each query runs to completion into Spark's ``noop`` sink, so every row is
computed but nothing is collected to the driver. Every headline query runs
once untimed first, so JIT compilation and code generation of each new code
path are not counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickscope.plans import QUERIES  # noqa: E402
from clickscope.session import build_session  # noqa: E402

HEADLINE = [
    "session_bucket_stats",           # D1
    "session_sample",                 # D2
    "category_top10",                 # D3
    "top_sessions_per_top_category",  # D4
    "page_conversion_rate",           # D5
    "area_top3_products",             # D6
    "professional_share",             # D7
    "hot_product_user_visits",        # D8
    "session_rollup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    for name in HEADLINE:  # warm-up pass, untimed
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - t0
            best = elapsed if best is None else min(best, elapsed)
        timings[name] = round(best, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf.group(1)) if sf else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
