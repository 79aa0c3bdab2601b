"""Row numbers and ranks that stay distributed under skew.

``row_number() over (order by ..)`` without a partition, or
``rank() over (partition by g order by ..)`` with one very large group,
makes Spark move the whole (group of the) table into one task. Here rows are
range-partitioned by ``(g, order)`` and written once with their range number
to the shared folder. The local numbers and the sizes per (range, group) are
both taken from that one written table, so they always agree; a row's number is
its local one plus the size of its group in earlier ranges, a table with one
row per (range, group) pair.

For a rank, the rows that are ranged are the distinct (group, sort key) pairs
with their counts: a value that holds a third of all rows is one row. For a row
number, ties are broken by the remaining columns and at last by a generated
number, so equal rows spread over ranges too.

NULL groups and NULL sort keys are groups and keys like any other.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dssforge.session import scratch_path

c = F.col


def _same(left: list[str], right: list[str]):
    return reduce(lambda a, b: a & b, [c(x).eqNullSafe(c(y)) for x, y in zip(left, right)], F.lit(True))


def _ranged(rows: DataFrame, keys: list[str], pid: str) -> DataFrame:
    """``rows`` with the number of their range, written and read back."""
    path = scratch_path(rows.sparkSession, "ranged")
    rows.repartitionByRange(*keys).withColumn(pid, F.spark_partition_id()).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _before(ranged: DataFrame, group: list[str], order: list[str], pid: str, weight: str, name: str) -> DataFrame:
    """``ranged`` plus ``name``: the weight of all rows of the group that come before the row."""
    local = Window.partitionBy(pid, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(pid, *group).agg(F.sum(weight).alias(f"{name}_n"))
    earlier = Window.partitionBy(*group).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    renamed = [f"{name}_k{i}" for i in range(len(group))]
    offsets = sizes.select(c(pid).alias(f"{name}_p"), *[c(g).alias(r) for g, r in zip(group, renamed)],
                           F.coalesce(F.sum(f"{name}_n").over(earlier), F.lit(0)).alias(f"{name}_off"))
    numbered = ranged.withColumn(f"{name}_in", F.coalesce(F.sum(weight).over(local), F.lit(0)))
    joined = numbered.join(offsets, (c(pid) == c(f"{name}_p")) & _same(group, renamed))
    return joined.select(*ranged.columns, (c(f"{name}_in") + c(f"{name}_off")).alias(name))


def distributed_rank(df: DataFrame, partition_by: list[str], order_by: list[str],
                     name: str = "rank", kind: str = "rank") -> DataFrame:
    """``df`` plus ``name`` = rank / row_number within ``partition_by`` in ``order_by``.

    For ``row_number`` ties are broken by the remaining columns so that the
    numbering is deterministic.
    """
    tag = f"_{uuid.uuid4().hex[:8]}"
    pid, weight, before = f"{tag}_pid", f"{tag}_w", f"{tag}_b"
    if kind == "row_number":
        order = list(order_by) + [x for x in df.columns if x not in partition_by and x not in order_by]
        tie = f"{tag}_tie"
        rows = df.withColumn(tie, F.monotonically_increasing_id()).withColumn(weight, F.lit(1))
        order.append(tie)
        numbered = _before(_ranged(rows, [*partition_by, *order], pid), partition_by, order, pid, weight, before)
        return numbered.select(*df.columns, (c(before) + 1).cast("bigint").alias(name))
    if kind != "rank":
        raise ValueError(kind)
    keys = [*partition_by, *(x for x in order_by if x not in partition_by)]
    values = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(weight))
    ranked = _before(_ranged(values, keys, pid), partition_by, order_by, pid, weight, before)
    renamed = [f"{tag}_k{i}" for i in range(len(keys))]
    ranked = ranked.select(*[c(k).alias(r) for k, r in zip(keys, renamed)], before)
    return df.join(ranked, _same(keys, renamed)).select(*df.columns, (c(before) + 1).cast("bigint").alias(name))


def w_row_number(cat) -> DataFrame:
    """Customers numbered by name (then key) over the whole table."""
    cust = cat.customer.select("c_custkey", "c_name", "c_nationkey")
    return distributed_rank(cust, [], ["c_name", "c_custkey"], "row_number", "row_number")


def w_rank(cat) -> DataFrame:
    """Suppliers ranked by name within their nation."""
    supp = cat.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return distributed_rank(supp, ["s_nationkey"], ["s_name"], "name_rank", "rank")
