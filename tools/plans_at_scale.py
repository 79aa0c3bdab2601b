"""Print each analytic query's join and shuffle shape as planned at scale.

Usage: python tools/plans_at_scale.py [sf_dir]

Plans are made with ``spark.sql.autoBroadcastJoinThreshold=-1``: at 100 TB
every size estimate is over the threshold, so only the hinted, row-checked
dimensions are broadcast. For each query: sort-merge joins, broadcast hash
joins, hash exchanges and their keys, and any nested-loop or cartesian join
(there should be none). The numbers feed the table in PLANS.md.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dssforge.plans.explain import plan_text  # noqa: E402
from dssforge.registry import registered_queries  # noqa: E402
from dssforge.session import get_spark  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 16, extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    print("| Query | SMJ | BHJ | Shuffles | Shuffle keys | Nested loop / cartesian |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, fn in registered_queries().items():
        if not re.match(r"q\d\d_", name):
            continue
        plan = plan_text(fn(spark, sf_dir), "simple")
        plan = plan.split("== Initial Plan ==")[-1]
        keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
        bad = [k for k in ("BroadcastNestedLoopJoin", "CartesianProduct") if k in plan]
        print(f"| {name[:3]} | {plan.count('SortMergeJoin')} | {plan.count('BroadcastHashJoin')} | {len(keys)} "
              f"| {'; '.join(keys)} | {', '.join(bad) or 'none'} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
