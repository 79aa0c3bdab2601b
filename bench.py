"""Benchmark the analytic queries.

Runs every registered analytic query (22 queries + variants by default) on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``.
Each query is executed in full through the ``noop`` sink (no collect), once
as warm-up and then ``$BENCH_RUNS`` times (default 3); the reported time is
the minimum, the rule the benchmark's own report uses. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from dssforge.registry import registered_queries  # noqa: E402
from dssforge.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_QUERIES")
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
             "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="dssforge-bench-")}
    for kv in filter(None, os.environ.get("BENCH_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        extra[k] = v
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus, extra=extra)
    queries = registered_queries()
    names = [n for n in queries if re.match(r"q\d\d", n)]
    if only:
        names = [n for n in names if any(o in n for o in only.split(","))]
    times: dict[str, float] = {}
    for name in names:
        fn = queries[name]
        best = float("inf")
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                best = min(best, dt)
        times[name] = round(best, 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "analytic_queries_total_min_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
