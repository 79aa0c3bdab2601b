"""Connected components of an edge table, as DataFrame joins.

Alternates two steps on edges that point from a larger node to a smaller one:
every node hands its larger neighbours its smallest one, then every node hands
its smaller neighbours the smallest of them.  Each step is a minimum per node
(partial aggregation) and a join, so no neighbourhood is ever gathered in a
task; edges are written to the shared folder after each pair of steps.  The
number of rounds grows with the logarithm of the longest path.  Joins broadcast
the minima only while the counted edges are few (``store.BROADCAST_IDS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dssforge.llm.store import Scratch, few, fewer_tasks


def _large_star(edges: DataFrame, most: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("m"))
    joined = both.where("b > a").join(few(fewer_tasks(least, most), most), F.col("a") == F.col("n"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, most: int) -> DataFrame:
    least = few(fewer_tasks(edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")), most), most)
    joined = edges.join(least, F.col("a") == F.col("n"))
    back = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return back.unionByName(joined.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str, most: int) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node reachable.

    ``most``: rows of ``edges`` at most.  Nulls and loops are no edges;
    repeated edges count once; no edges give no rows.
    """
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, step = scratch.keep(fewer_tasks(clean, most), f"{name}-0"), 0
    while not _is_star(now, most):
        step += 1
        after = scratch.keep(fewer_tasks(_small_star(_large_star(now, most), most), most), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        now = after
    roots = now.select("b").distinct()
    return now.toDF("node", "component").unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("component")))


def _is_star(edges: DataFrame, most: int) -> bool:
    """No node has two smaller neighbours, and no smaller end is a larger end elsewhere."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("root"))
    )
    per = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return fewer_tasks(per, most).where("up > 1 or (up > 0 and root = 1)").isEmpty()
