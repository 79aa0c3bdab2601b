"""Run registered queries from the command line.

    python -m dssforge DATA_DIR [KEY ...] [--params FILE] [--rows N] [--master URL]

Without keys, the 22 analytic queries run in order. ``--params`` replays a
recorded parameter file (one tab-separated line per query). Each result is
shown with ``DataFrame.show`` (at most ``--rows`` rows), followed by its
wall time.
"""

from __future__ import annotations

import argparse
import re
import time

from pyspark.sql import SparkSession

from dssforge.plans.params import SIGNATURES, read_params
from dssforge.registry import registered_queries
from dssforge.session import get_spark
from dssforge.sources.tables import Catalog


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m dssforge")
    ap.add_argument("data_dir")
    ap.add_argument("keys", nargs="*")
    ap.add_argument("--params")
    ap.add_argument("--rows", type=int, default=20, help="rows shown of each result")
    ap.add_argument("--out", help="folder that gets every row of each result, as Parquet")
    ap.add_argument("--complete", action="store_true", help="derive columns and partsupp that the data set lacks")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    created = SparkSession.getActiveSession() is None
    spark = get_spark(a.master)
    queries = registered_queries(a.complete)
    keys = a.keys or [k for k in queries if re.match(r"q\d\d_", k)]
    params = read_params(a.params) if a.params else {}
    cat = Catalog(spark, a.data_dir, complete=a.complete)
    for key in keys:
        t0 = time.perf_counter()
        n = int(key[1:3]) if re.match(r"q\d\d_", key) else None
        if n in params:
            df = SIGNATURES[n][0](cat, **params[n])
        else:
            df = queries[key](spark, a.data_dir)
        print(f"== {key}")
        if a.out:
            out = f"{a.out.rstrip('/')}/{key}"
            df.write.mode("errorifexists").parquet(out)
            df = spark.read.schema(df.schema).parquet(out)
        df.show(a.rows, truncate=False)
        print(f"-- {time.perf_counter() - t0:.2f}s")
    if created:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
