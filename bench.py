"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the cores. Each query runs once on the same
tables to warm up, then once for the clock; results go to the no-op sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from tenantferry.session import local_session
from workload import QUERIES

HEADLINE = [
    "src1_tenant_slice", "agg1_slice_stats", "agg3_chunk_counts", "gen2_chunk_of_each_row",
    "agg4_slice_checksum", "agg4_unicode_checksum", "agg10_latest_change", "jn7_upsert",
    "e2e1_plan", "e2e2_migrate", "e2e4_replicate", "e2e5_verify",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
