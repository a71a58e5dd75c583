"""Time the queries on one machine and print one line of JSON.

All queries run once unmeasured. Then each runs three times, its whole result
computed and thrown away, and the median counts. A run includes building the
query; queries that write files write them anew in every run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from amity.plans.queries import QUERIES  # noqa: E402
from amity.session import local_session  # noqa: E402

REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    names = only or list(QUERIES)
    for name in names:
        run(name)
    seconds = {n: round(statistics.median(run(n) for _ in range(REPEATS)), 3) for n in names}
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("/sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
