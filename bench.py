"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8). Every query
runs once to warm up and once for the time, writing all rows and columns to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from haulage.plans.catalog import QUERIES
from haulage.session import local_session


def run(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "haulage-bench")
    names = sys.argv[1:] or list(QUERIES)
    times = {}
    for name in names:
        run(spark, sf_dir, name)
        times[name] = round(run(spark, sf_dir, name), 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
