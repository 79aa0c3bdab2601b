"""Column-class tolerant comparison of two result tables.

Rows of the two results are lined up by row number in a given order, then
each column is compared by its class:

* ``str`` equal after right-trim;  ``cnt``, ``int`` exactly equal;
* ``num`` equal when both are rounded to 2 decimals;
* ``sum`` rounded to 2 decimals, differ by at most 100;
* ``avg`` rounded to 2 decimals, differ by at most 1 percent of the first
  (a zero first value compares the absolute difference with 1);
* ``rat`` rounded to 2 decimals, differ by at most 1 (absolute).

A row present on one side only counts as a mismatch of every column.

Row numbers come from :func:`dssforge.operators.windows.distributed_rank`,
so no step holds the whole result in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dssforge.operators.windows import distributed_rank

c = F.col

CLASSES = ("str", "sum", "avg", "cnt", "int", "num", "rat")


def row_numbered(df: DataFrame, order: list[str], name: str = "_rn") -> DataFrame:
    """``df`` with a 1-based consecutive row number in ``order`` (ties by all columns)."""
    return distributed_rank(df, [], order, name, "row_number")


def _mismatch(cls: str, a: Column, b: Column) -> Column:
    if cls == "str":
        return ~F.rtrim(a.cast("string")).eqNullSafe(F.rtrim(b.cast("string")))
    if cls in ("cnt", "int"):
        return ~a.eqNullSafe(b)
    ra, rb = F.round(a.cast("double"), 2), F.round(b.cast("double"), 2)
    diff = F.abs(ra - rb)
    if cls == "num":
        return ~ra.eqNullSafe(rb)
    if cls == "sum":
        return diff > 100
    if cls == "avg":
        return F.when(ra == 0, diff > 1).otherwise(diff / F.abs(ra) * 100 > 1)
    if cls == "rat":
        return diff > 1
    raise ValueError(f"unknown column class {cls!r}")


def result_diff(left: DataFrame, right: DataFrame, classes: dict[str, str], order: list[str]) -> DataFrame:
    """Per column: ``column_name, column_class, rows_compared, mismatches``.

    ``classes`` maps every compared column to its class; ``order`` lines the
    rows up (both sides numbered in that order).
    """
    unknown = {k: v for k, v in classes.items() if v not in CLASSES}
    if unknown:
        raise ValueError(f"unknown column classes {unknown}")
    cols = list(classes)
    a = row_numbered(left.select(*cols), order, "_rn").select("_rn", *[c(x).alias(f"a_{x}") for x in cols])
    b = row_numbered(right.select(*cols), order, "_rn").select(c("_rn").alias("_rn_b"),
                                                               *[c(x).alias(f"b_{x}") for x in cols])
    lined = a.join(b, c("_rn") == c("_rn_b"), "full_outer")
    one_side = c("_rn").isNull() | c("_rn_b").isNull()
    aggs = []
    for x in cols:
        bad = one_side | F.coalesce(_mismatch(classes[x], c(f"a_{x}"), c(f"b_{x}")), F.lit(True))
        aggs.append(F.count(F.when(bad, 1)).alias(x))
    counts = lined.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(x).alias("column_name"), F.lit(classes[x]).alias("column_class"),
                 c("_rows").alias("rows_compared"), c(x).alias("mismatches"))
        for x in cols])))
