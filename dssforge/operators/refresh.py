"""Refresh sets: insert new orders with their lines, delete orders by key.

A refresh never updates files in place: the next state of a table is a new
DataFrame (``(state - deleted) + inserted``) that is written to a new folder
of the shared location; the caller switches readers to it afterwards.

Deletion is a left anti join on the order key (a shuffle on both sides at
scale, a broadcast only when the key set is measured small by adaptive
execution); insertion is a union. Both keep every other row whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dssforge.functions.exprs import date
from dssforge.operators.key_sets import overlaps, without_keys
from dssforge.operators.layout import write_year_partitioned, year_partition
from dssforge.session import scratch_path
from dssforge.sources.delimited import load_delete_keys, load_delimited, to_file_shape, write_delimited
from dssforge.sources.sizing import written_parts
from dssforge.sources.tables import Catalog

c = F.col


@dataclass
class RefreshSets:
    base_orders: DataFrame
    base_lines: DataFrame
    insert_orders: DataFrame
    insert_lines: DataFrame
    delete_keys: DataFrame  # one column: o_orderkey


def refresh_sets(cat: Catalog, insert_from: str = "1999-01-01", delete_before: str = "1996-01-01",
                 store_keys: bool = False) -> RefreshSets:
    """Split the data into a base state, an insert set and a delete key set.

    Orders placed from ``insert_from`` on (and their lines) form the insert
    set; the base holds everything else. The delete set is the keys of the
    orders placed before ``delete_before`` (old orders leave the system).
    ``store_keys`` writes the insert set's keys once, so the planner knows their size
    and the lines are not shuffled to meet a few.
    """
    orders, lines = cat.orders, cat.lineitem
    new = orders.filter(c("o_orderdate") >= date(insert_from))
    new_keys = new.select(c("o_orderkey").alias("_k"))
    if store_keys:
        new_keys = cat.spark.read.schema(new_keys.schema).parquet(write_state(new_keys, "insert-keys"))
    return RefreshSets(
        base_orders=orders.filter(~(c("o_orderdate") >= date(insert_from)) | c("o_orderdate").isNull()),
        base_lines=lines.join(new_keys, c("l_orderkey") == c("_k"), "left_anti"),
        insert_orders=new,
        insert_lines=lines.join(new_keys, c("l_orderkey") == c("_k"), "left_semi"),
        delete_keys=orders.filter(c("o_orderdate") < date(delete_before)).select("o_orderkey"),
    )


def refresh_delete(orders: DataFrame, lines: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove the orders whose key is in ``keys`` and all their lines."""
    k = keys.select(c(keys.columns[0]).alias("_dk")).dropna()
    return (orders.join(k, c("o_orderkey") == c("_dk"), "left_anti"),
            lines.join(k, c("l_orderkey") == c("_dk"), "left_anti"))


def refresh_insert(orders: DataFrame, lines: DataFrame, new_orders: DataFrame,
                   new_lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add new orders and their lines (columns matched by name)."""
    return orders.unionByName(new_orders), lines.unionByName(new_lines)


def refresh_apply(orders: DataFrame, lines: DataFrame, keys: DataFrame, new_orders: DataFrame,
                  new_lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Next state: delete set first, then insert set."""
    o, l_ = refresh_delete(orders, lines, keys)
    return refresh_insert(o, l_, new_orders, new_lines)


def write_state(df: DataFrame, name: str, path: str | None = None) -> str:
    """Write a table state to a new folder of the shared location and return it."""
    out = path or scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(out)
    return out


def refresh_partitions(state: str, schema, part_col: str, key: str, delete_keys: DataFrame, inserts: DataFrame,
                       parts: int | None = None) -> list[str]:
    """Apply a refresh set to a table stored in ``part_col`` folders; returns the partitions rewritten.

    Delete keys are mapped to the partitions that hold them by a join over the key and partition columns
    alone; those partitions and the ones that get rows are built anew in the shared folder, and
    replace the old ones by a dynamic partition overwrite; one left without rows is removed. All other
    partitions keep their files. ``inserts`` has the table's columns, ``part_col`` (a string) too.
    Applying a set once more changes nothing: rows of inserted keys are replaced. ``parts`` is the number of
    partitions the rows are dealt into (by default the session's shuffle partitions).
    """
    spark = inserts.sparkSession
    table = spark.read.schema(schema).parquet(state)
    keys = delete_keys.select(c(delete_keys.columns[0]).alias("_k")).dropna()
    gone = keys.unionByName(inserts.select(c(key).alias("_k")).dropna()).distinct()
    gone = spark.read.schema(gone.schema).parquet(write_state(gone, "refresh-keys"))
    n_keys = gone.count()
    hit = table.select(key, part_col).join(gone, c(key) == c("_k"), "left_semi").select(part_col)
    # One value per folder, so this list is as long as the table has partitions at most.
    touched = sorted(r[0] for r in hit.unionByName(inserts.select(part_col)).distinct().collect())
    staged = scratch_path(spark, "staged-partitions")
    fresh = without_keys(table.where(c(part_col).isin(touched)), key, gone, "_k", n_keys=n_keys, parts=parts).unionByName(inserts)
    dealt = [part_col, F.pmod(F.xxhash64(key), F.lit(SPREAD))]
    fresh = fresh.repartition(parts, *dealt) if parts else fresh.repartition(*dealt)
    fresh.write.partitionBy(part_col).parquet(staged)
    new = spark.read.schema(schema).parquet(staged)
    left = {r[0] for r in new.select(part_col).distinct().collect()}
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(state)
    for value in set(touched) - left:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/{part_col}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return touched


#: Tasks that write one rewritten partition, at most.
SPREAD = 64

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
              "o_shippriority", "o_comment"]
LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "l_commitdate",
             "l_receiptdate", "l_shipinstruct", "l_shipmode"]
_MONEY = {"o_totalprice", "l_quantity", "l_extendedprice", "l_discount", "l_tax"}


def as_result(df: DataFrame, cols: list[str]) -> DataFrame:
    """Project a table state for reporting (money as DOUBLE)."""
    return df.select(*[c(x).cast("double").alias(x) if x in _MONEY else c(x) for x in cols])


def write_update_files(cat: Catalog, sets: RefreshSets, kinds: tuple[str, ...] = ("orders", "lineitem", "delete")) -> dict[str, str]:
    """Write the named parts of a refresh set in the benchmark's update-file format.

    orders and lineitem insert files (table format, trailing separator) and
    the delete keys as one-column key files, as many numbered files each as
    the data has tasks; returns their folders.
    """
    rows = {"orders": lambda: to_file_shape(sets.insert_orders, "orders"),
            "lineitem": lambda: to_file_shape(sets.insert_lines, "lineitem"),
            "delete": lambda: sets.delete_keys}
    out = {}
    for kind in kinds:
        out[kind] = scratch_path(cat.spark, f"update-{kind}")
        write_delimited(rows[kind](), out[kind])
    return out


def _inserted(cat: Catalog, table: str) -> DataFrame:
    """State of one table after its insert files are loaded and added to the base state."""
    s = refresh_sets(cat, store_keys=table == "lineitem")
    files = write_update_files(cat, s, (table,))
    base, cols = (s.base_orders, ORDER_COLS) if table == "orders" else (s.base_lines, LINE_COLS)
    new = load_delimited(cat.spark, f"{files[table]}/part-*", table)
    return as_result(base.select(*cols).unionByName(new.select(*cols)), cols)


def _deleted(cat: Catalog, table: str, state: DataFrame, key: str, s: RefreshSets) -> DataFrame:
    """``state`` without the rows of the orders in the delete key file."""
    files = write_update_files(cat, s, ("delete",))
    keys = load_delete_keys(cat.spark, f"{files['delete']}/part-*").select(c("o_orderkey").alias("_dk")).dropna()
    n_keys = cat.spark.read.text(files["delete"]).count()
    return without_keys(state, key, keys, "_dk", n_keys=n_keys, parts=written_parts(cat.spark, cat.path(table)))


def _applied(cat: Catalog, table: str) -> DataFrame:
    """State of one table after the delete file, then the insert files, applied to the base state."""
    s = refresh_sets(cat, store_keys=table == "lineitem")
    base, cols, key = (s.base_orders, ORDER_COLS, "o_orderkey") if table == "orders" else (s.base_lines, LINE_COLS, "l_orderkey")
    files = write_update_files(cat, s, (table,))
    new = load_delimited(cat.spark, f"{files[table]}/part-*", table)
    left = _deleted(cat, table, base.select(*cols), key, s)
    return as_result(left.unionByName(new.select(*cols)), cols)


def _partitioned(cat: Catalog, table: str) -> DataFrame:
    """State of one table, stored in yearly folders, after both update files are applied to the folders they touch."""
    s = refresh_sets(cat, store_keys=table == "lineitem")
    parts = written_parts(cat.spark, cat.path(table))
    base, cols, key, day = ((s.base_orders, ORDER_COLS, "o_orderkey", "o_orderdate") if table == "orders"
                            else (s.base_lines, LINE_COLS, "l_orderkey", "l_shipdate"))
    files = write_update_files(cat, s, (table, "delete"))
    state = scratch_path(cat.spark, f"{table}-by-year")
    base = base.select(*cols)
    write_year_partitioned(base, day, state, spread_cols=[key], parts=parts)
    new = load_delimited(cat.spark, f"{files[table]}/part-*", table).select(*[c(x).cast(base.schema[x].dataType) for x in cols])
    schema = base.withColumn("year", F.lit("")).schema
    refresh_partitions(state, schema, "year", key, load_delete_keys(cat.spark, f"{files['delete']}/part-*"),
                       new.withColumn("year", year_partition(day)), parts)
    return as_result(cat.spark.read.schema(schema).parquet(state), cols)


def refresh_partitioned_query(cat: Catalog) -> DataFrame:
    """Orders in yearly folders after the update files; only the folders they touch are rewritten."""
    return _partitioned(cat, "orders")


def refresh_partitioned_lines_query(cat: Catalog) -> DataFrame:
    """lineitem in yearly folders after the update files; only the folders they touch are rewritten."""
    return _partitioned(cat, "lineitem")


def refresh_key_sets_query(cat: Catalog) -> DataFrame:
    """Sizes and overlaps of the base, insert and delete key sets, counted on bitmaps."""
    s = refresh_sets(cat)
    return overlaps({"base": s.base_orders.select("o_orderkey"), "insert": s.insert_orders.select("o_orderkey"),
                     "delete": s.delete_keys})


def refresh_insert_query(cat: Catalog) -> DataFrame:
    """Orders state after the insert files."""
    return _inserted(cat, "orders")


def refresh_insert_lines_query(cat: Catalog) -> DataFrame:
    """lineitem state after the insert files."""
    return _inserted(cat, "lineitem")


def refresh_delete_query(cat: Catalog) -> DataFrame:
    """lineitem state after deleting the orders listed in the delete key file."""
    return as_result(_deleted(cat, "lineitem", cat.lineitem, "l_orderkey", refresh_sets(cat)), LINE_COLS)


def refresh_delete_orders_query(cat: Catalog) -> DataFrame:
    """Orders state after deleting the orders listed in the delete key file."""
    return as_result(_deleted(cat, "orders", cat.orders, "o_orderkey", refresh_sets(cat)), ORDER_COLS)


def refresh_apply_query(cat: Catalog) -> DataFrame:
    """Orders state after the delete file, then the insert files."""
    return _applied(cat, "orders")


def refresh_apply_lines_query(cat: Catalog) -> DataFrame:
    """lineitem state after the delete file, then the insert files."""
    return _applied(cat, "lineitem")
