"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (full computation,
nothing collected to the driver); the time covers plan construction too.
The session is first warmed by running the same queries on the smallest
tables, so JVM JIT and first-time code generation (fixed costs that vanish
at cluster scale) are not charged to the measured run.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "catalog_dedup", "quality_violations", "outbound_links", "crawl_sites", "advertised_feeds",
    "probe_urls", "health_history", "retry_resolution", "relevance_score", "candidates",
    "catalog_search", "top_candidates",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from feedcat.session import get_spark
    from feedcat.plans.queries import QUERIES

    spark = get_spark(app="feedcat-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in HEADLINE:  # warm-up on the smallest tables
        QUERIES[name](spark, warm_dir if os.path.isdir(warm_dir) else sf_dir) \
            .write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()  # construction included: some plans checkpoint a stage eagerly
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
