"""Key and NOT NULL constraints, re-aimed as distributed checks.

Spark does not enforce keys, so each declared constraint becomes a query
that counts its violations:

* ``pk_violations``: per table, rows with a NULL key part, key values that
  occur more than once, and the rows carrying them -- one grouped aggregate
  per table (partial aggregation first, so a hot key costs one row per map
  task in the shuffle);
* ``fk_orphans``: per foreign key, child rows whose non-NULL key has no
  parent -- a left anti join (broadcast only for the fixed-size parents);
* ``not_null``: per table and declared NOT NULL column, the NULL count --
  one aggregate pass per table, unpivoted to one row per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dssforge.functions.constants import BOUNDED_ROWS
from dssforge.sources.tables import Catalog, union_all

c = F.col

# --- fixed values: declared primary keys ---
PRIMARY_KEYS = {
    "nation": ["n_nationkey"],
    "region": ["r_regionkey"],
    "customer": ["c_custkey"],
    "part": ["p_partkey"],
    "supplier": ["s_suppkey"],
    "partsupp": ["ps_partkey", "ps_suppkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
}

# --- fixed values: declared foreign keys (name, child, child cols, parent, parent cols) ---
FOREIGN_KEYS = [
    ("supplier_nation_fk", "supplier", ["s_nationkey"], "nation", ["n_nationkey"]),
    ("partsupp_part_fk", "partsupp", ["ps_partkey"], "part", ["p_partkey"]),
    ("partsupp_supplier_fk", "partsupp", ["ps_suppkey"], "supplier", ["s_suppkey"]),
    ("customer_nation_fk", "customer", ["c_nationkey"], "nation", ["n_nationkey"]),
    ("orders_customer_fk", "orders", ["o_custkey"], "customer", ["c_custkey"]),
    ("lineitem_order_fk", "lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
    ("lineitem_part_fk", "lineitem", ["l_partkey"], "part", ["p_partkey"]),
    ("lineitem_partsupp_fk", "lineitem", ["l_partkey", "l_suppkey"], "partsupp", ["ps_partkey", "ps_suppkey"]),
    ("nation_region_fk", "nation", ["n_regionkey"], "region", ["r_regionkey"]),
]

# Columns that may be NULL; every other column of the schema is NOT NULL.
NULLABLE = {"n_comment", "r_comment"}


def pk_violations(cat: Catalog) -> DataFrame:
    """One row per table: null_key_rows, duplicate_keys, duplicate_rows.

    A single grouped pass per table: the group of NULL keys counts the rows
    with a NULL key part, the other groups with more than one row are the
    duplicates.
    """
    frames = []
    for table, keys in PRIMARY_KEYS.items():
        any_null = F.greatest(*[c(k).isNull() for k in keys]) if len(keys) > 1 else c(keys[0]).isNull()
        groups = (cat.table(table).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                  .select(any_null.alias("has_null"), "n"))
        dup = ~c("has_null") & (c("n") > 1)
        frames.append(groups.agg(
            F.coalesce(F.sum(F.when(c("has_null"), c("n"))), F.lit(0)).cast("bigint").alias("null_key_rows"),
            F.count(F.when(dup, 1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(dup, c("n"))), F.lit(0)).cast("bigint").alias("duplicate_rows"))
            .select(F.lit(table).alias("table_name"), "null_key_rows", "duplicate_keys", "duplicate_rows"))
    return union_all(frames)


def fk_orphans(cat: Catalog) -> DataFrame:
    """One row per foreign key: child rows whose key has no parent row."""
    frames = []
    for name, child, ccols, parent, pcols in FOREIGN_KEYS:
        kids = cat.table(child).select(*ccols).dropna(subset=ccols)
        parents = cat.small(parent) if parent in BOUNDED_ROWS else cat.table(parent)
        parents = parents.select(*[c(p).alias(f"_p{i}") for i, p in enumerate(pcols)])
        cond = [c(cc) == c(f"_p{i}") for i, cc in enumerate(ccols)]
        orphans = kids.join(parents, cond, "left_anti")
        frames.append(orphans.agg(F.count(F.lit(1)).alias("orphan_rows"))
                      .select(F.lit(name).alias("constraint_name"), F.lit(child).alias("child_table"),
                              F.lit(parent).alias("parent_table"), "orphan_rows"))
    return union_all(frames)


def not_null(cat: Catalog, tables: list[str] | None = None) -> DataFrame:
    """One row per (table, NOT NULL column present): null_rows."""
    frames = []
    for table in tables or list(PRIMARY_KEYS):
        df = cat.table(table)
        cols = [f for f in df.columns if f not in NULLABLE]
        counts = df.agg(*[F.count(F.when(c(f).isNull(), 1)).alias(f) for f in cols])
        stacked = counts.unpivot([], cols, "column_name", "null_rows")
        frames.append(stacked.select(F.lit(table).alias("table_name"), "column_name",
                                     c("null_rows").cast("bigint").alias("null_rows")))
    return union_all(frames)
