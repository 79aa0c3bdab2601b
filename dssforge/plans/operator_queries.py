"""Registered forms of the non-query operators, over the given tables.

Each function takes a :class:`Catalog` and returns a lazy DataFrame whose
work grows with the tables. Operators that write (sinks, layouts, the file
stream) write to a fresh folder of the shared location
(``spark.checkpoint.dir``) and return the table read back, so the result
shows what a reader of the written table sees.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dssforge.operators import layout, partition_stats
from dssforge.operators.checks import PRIMARY_KEYS
from dssforge.operators.compare import result_diff
from dssforge.operators.refresh import LINE_COLS, ORDER_COLS, RefreshSets, as_result, refresh_sets
from dssforge.operators.reports import (
    report_analyze,
    report_gen_data,
    report_loads,
    report_queries,
    report_sessions,
)
from dssforge.plans.explain import plan_statistics
from dssforge.plans.queries import q01, q05, q09, q10, q18
from dssforge.session import scratch_path
from dssforge.sources.delimited import load_delimited, to_file_shape, write_delimited
from dssforge.sources.runlog import events_runlog, parse_runlog, read_runlog, runlog_lines
from dssforge.sources.load import load_counted, load_tables, store_bucketed
from dssforge.sources.sizing import written_parts
from dssforge.sources.tables import TABLE_NAMES, Catalog, union_all
from dssforge.streaming.refresh_stream import read_state, segment_stream

c = F.col


# -- sources and sinks -----------------------------------------------------
def load_delimited_q(cat: Catalog) -> DataFrame:
    """lineitem written as table files (trailing separator) and loaded back."""
    path = scratch_path(cat.spark, "tbl-lineitem")
    write_delimited(to_file_shape(cat.lineitem, "lineitem"), path)
    return as_result(load_delimited(cat.spark, path, "lineitem"), LINE_COLS)


def load_csv_nodummy_q(cat: Catalog) -> DataFrame:
    """orders written without the trailing separator and loaded back."""
    path = scratch_path(cat.spark, "csv-orders")
    write_delimited(to_file_shape(cat.orders, "orders"), path, trailing_separator=False)
    return as_result(load_delimited(cat.spark, path, "orders", dummy=False), ORDER_COLS)


def load_copy_q(cat: Catalog) -> DataFrame:
    """customer written as one file per writer and loaded through a glob."""
    path = scratch_path(cat.spark, "copy-customer")
    write_delimited(to_file_shape(cat.customer, "customer"), path)
    df = load_delimited(cat.spark, f"{path}/part-*", "customer")
    return df.select("c_custkey", "c_name", "c_address", "c_nationkey", "c_phone",
                     c("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment", "c_comment")


def write_delimited_q(cat: Catalog) -> DataFrame:
    """The text lines that nation and part are written as."""
    out = []
    for table in ("nation", "part"):
        path = scratch_path(cat.spark, f"text-{table}")
        write_delimited(to_file_shape(cat.table(table), table), path)
        out.append(cat.spark.read.text(path).select(F.lit(table).alias("table_name"), c("value").alias("line")))
    return union_all(out)


def write_tbl_dataset(cat: Catalog, folder: str) -> None:
    """Every table written as table files ``{folder}/{table}.tbl/part-*``, a file per task that reads it."""
    for table in TABLE_NAMES:
        write_delimited(to_file_shape(cat.table(table), table), f"{folder}/{table}.tbl")


def load_tables_q(cat: Catalog) -> DataFrame:
    """All eight tables written as table files and loaded into a Parquet folder."""
    src, dst = scratch_path(cat.spark, "tbl-dataset"), scratch_path(cat.spark, "loaded-dataset")
    write_tbl_dataset(cat, src)
    return load_tables(cat.spark, src, dst)


def write_table_q(cat: Catalog) -> DataFrame:
    """q05's result written as a table, then the same query appended."""
    path = scratch_path(cat.spark, "result-q05")
    q05(cat).write.mode("overwrite").parquet(path)
    q05(cat).write.mode("append").parquet(path)
    return cat.spark.read.parquet(path)


def table_from_query(cat: Catalog, query, name: str, path: str) -> None:
    """CREATE TABLE AS of a query's result, then INSERT INTO .. SELECT of the same query."""
    result = query(cat)
    result.write.mode("errorifexists").format("parquet").option("path", path).saveAsTable(name)
    query(cat).select(*cat.spark.table(name).columns).write.insertInto(name)


def table_from_query_q(cat: Catalog) -> DataFrame:
    """q10's result as a catalog table, created from the query and inserted into once more."""
    name = f"result_{uuid.uuid4().hex[:12]}"
    path = scratch_path(cat.spark, name)
    table_from_query(cat, q10, name, path)
    try:
        return cat.spark.read.parquet(path)
    finally:
        cat.spark.sql(f"DROP TABLE {name}")  # external: the files stay for the result


# -- layouts ---------------------------------------------------------------
def layout_year_partition_q(cat: Catalog, year: int = 1997) -> DataFrame:
    """lineitem in yearly ship-date folders; a one-year read prunes the others."""
    path = scratch_path(cat.spark, "lineitem-by-year")
    layout.write_year_partitioned(cat.lineitem, "l_shipdate", path, spread_cols=["l_orderkey", "l_linenumber"], parts=_buckets(cat))
    return as_result(cat.spark.read.parquet(path).filter(c("year") == str(year)), LINE_COLS)


def _buckets(cat: Catalog) -> int:
    """Buckets (or ranges) of the fact tables, from lineitem's bytes."""
    return written_parts(cat.spark, cat.path("lineitem"))


def layout_hash_q(cat: Catalog, buckets: int | None = None) -> DataFrame:
    """orders and lineitem, whole rows, bucketed by order key; their join reads matching buckets."""
    buckets = buckets or _buckets(cat)
    tag = uuid.uuid4().hex[:12]
    o_name, l_name = f"orders_b_{tag}", f"lineitem_b_{tag}"
    layout.write_bucketed(cat.orders, o_name, scratch_path(cat.spark, o_name), "o_orderkey", buckets)
    layout.write_bucketed(cat.lineitem, l_name, scratch_path(cat.spark, l_name), "l_orderkey", buckets)
    o, li = cat.spark.table(o_name), cat.spark.table(l_name)
    return (li.join(o, c("l_orderkey") == c("o_orderkey"))
            .groupBy("o_orderpriority")
            .agg(F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").cast("double").alias("quantity")))


def layout_bucketed_q(cat: Catalog, buckets: int | None = None) -> DataFrame:
    """q18 over orders and lineitem stored bucketed by order key.

    The per-order sums and the join with orders read matching buckets: no
    shuffle of either fact table on the order key.
    """
    db = f"dss_{uuid.uuid4().hex[:12]}"
    return q18(store_bucketed(cat, db, scratch_path(cat.spark, db), buckets or _buckets(cat)))


def layout_minmax_q(cat: Catalog, lo: str = "1997-03-01", hi: str = "1997-04-01") -> DataFrame:
    """lineitem sorted by ship date, zstd-compressed; a date range reads few row groups."""
    path = scratch_path(cat.spark, "lineitem-sorted")
    layout.write_sorted(cat.lineitem, path, ["l_shipdate"], compression="zstd",
                        spread_cols=["l_orderkey", "l_linenumber"], parts=_buckets(cat))
    df = cat.spark.read.parquet(path)
    return as_result(df.filter((c("l_shipdate") >= F.lit(lo).cast("date")) & (c("l_shipdate") < F.lit(hi).cast("date"))),
                     LINE_COLS)


#: Columns that the space-filling layout keeps together.
SKIP_COLS = ["l_quantity", "l_returnflag", "l_linestatus", "l_shipdate", "l_receiptdate", "l_shipinstruct", "l_shipmode"]


def layout_interleaved_q(cat: Catalog, quantity: int = 10, ship: str = "1996-01-01", receipt: str = "1996-03-01", mode: str = "RAIL") -> DataFrame:
    """lineitem along a space-filling order of seven columns; a predicate on four of them."""
    path = scratch_path(cat.spark, "lineitem-interleaved")
    layout.write_interleaved(cat.lineitem, path, SKIP_COLS, files=_buckets(cat), spread_cols=["l_orderkey", "l_linenumber"])
    df = cat.spark.read.parquet(path)
    return as_result(df.filter((c("l_quantity") <= quantity) & (c("l_shipdate") >= F.lit(ship).cast("date"))
                               & (c("l_receiptdate") < F.lit(receipt).cast("date")) & (c("l_shipmode") != mode)), LINE_COLS)


def layout_sorted_q(cat: Catalog) -> DataFrame:
    """Proof that lineitem, stored sorted by ship date, is sorted inside and across its files."""
    path = scratch_path(cat.spark, "lineitem-proved")
    layout.write_sorted(cat.lineitem, path, ["l_shipdate"], spread_cols=["l_orderkey", "l_linenumber"], parts=_buckets(cat))
    return layout.order_proof(cat.spark, path, "l_shipdate").select("rows", "unsorted_rows", "overlapping_files", "first_key", "last_key")


def load_counts_by_file_q(cat: Catalog) -> DataFrame:
    """orders and lineitem written as table files, a folder a year, and loaded: rows inserted from each folder's files."""
    src, dst = scratch_path(cat.spark, "tbl-years"), scratch_path(cat.spark, "loaded-years")
    for table, day in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")):
        write_delimited(to_file_shape(cat.table(table), table), f"{src}/{table}.tbl", folders={"year": layout.year_partition(day)})
    counted = load_counted(cat.spark, src, dst, ["orders", "lineitem"])
    year = F.regexp_extract("source_file", r"^year=([^/]+)/", 1).alias("year")
    return counted.groupBy("table_name", year).agg(F.sum("tuples").alias("tuples"))


def plan_statistics_q(cat: Catalog) -> DataFrame:
    """Rows that q09 and q18 read of each table, joined and returned, from the metrics of their finished plans."""
    out = []
    for name, df in (("q09", q09(cat)), ("q18", q18(cat))):
        st = plan_statistics(df).withColumn("query", F.lit(name))
        scans = st.where(c("relation").isNotNull()).groupBy("query", c("relation").alias("part")).agg(F.max("rows_out").alias("rows_out"))
        joins = st.where(c("operator").contains("Join")).groupBy("query", F.lit("last join").alias("part")).agg(F.min_by("rows_out", "node").alias("rows_out"))
        out += [scans, joins]
    return union_all(out)


#: Cell widths of the columns whose statistics are kept by partition.
STAT_WIDTHS = {"l_quantity": 1.0, "l_extendedprice": 1000.0, "l_shipdate": 1.0}


def stats_by_partition_q(cat: Catalog, late: str = "1998-01-01") -> DataFrame:
    """Statistics of yearly partitions; after later lines arrive only their partitions are analysed, then all are merged."""
    state, stats = scratch_path(cat.spark, "lineitem-analyzed"), scratch_path(cat.spark, "lineitem-stats")
    year, old = layout.year_partition("l_shipdate"), c("l_shipdate") < F.lit(late).cast("date")
    schema = cat.lineitem.withColumn("year", year).schema
    layout.write_year_partitioned(cat.lineitem.where(old), "l_shipdate", state, spread_cols=["l_orderkey"], parts=_buckets(cat))
    partition_stats.analyze(cat.spark.read.schema(schema).parquet(state), "year", STAT_WIDTHS, stats)
    new = cat.lineitem.where(~old | c("l_shipdate").isNull())
    fresh = [r[0] for r in new.select(year.alias("year")).distinct().collect()]  # at most one per yearly partition
    layout.write_year_partitioned(new, "l_shipdate", state, spread_cols=["l_orderkey"], mode="append", parts=_buckets(cat))
    partition_stats.analyze(cat.spark.read.schema(schema).parquet(state), "year", STAT_WIDTHS, stats, fresh)
    found = partition_stats.merged(partition_stats.read(cat.spark, stats), STAT_WIDTHS)
    return found.select("column_name", "row_count", "null_count", "min_value", "max_value", *[F.get("bounds", F.lit(i)).alias(f"bound_{i + 1}") for i in range(3)])


def compact_q(cat: Catalog) -> DataFrame:
    """orders written in many files, then compacted into files of the target size."""
    src, dst = scratch_path(cat.spark, "orders-many"), scratch_path(cat.spark, "orders-compact")
    cat.orders.repartition(16 * written_parts(cat.spark, cat.path("orders"))).write.parquet(src)
    layout.compact(cat.spark, src, dst)
    return as_result(cat.spark.read.parquet(dst), ORDER_COLS)


def layout_random_q(cat: Catalog) -> DataFrame:
    """orders dealt evenly over files of the target size, without a key."""
    path = scratch_path(cat.spark, "orders-random")
    layout.write_distributed(cat.orders, path, written_parts(cat.spark, cat.path("orders")))
    return as_result(cat.spark.read.parquet(path), ORDER_COLS)


def layout_compress_q(cat: Catalog, codec: str = "zstd", level: int = 9) -> DataFrame:
    """orders written with a codec and level, read back."""
    path = scratch_path(cat.spark, "orders-compressed")
    layout.write_compressed(cat.orders, path, codec, level)
    return as_result(cat.spark.read.parquet(path), ORDER_COLS)


def recreate_schema_q(cat: Catalog) -> DataFrame:
    """A schema that holds lineitem and orders is dropped with them, created again and filled with orders."""
    db = f"dss_{uuid.uuid4().hex[:12]}"
    layout.recreate_schema(cat.spark, db, scratch_path(cat.spark, db))
    for table in ("lineitem", "orders"):
        cat.table(table).write.format("parquet").saveAsTable(f"{db}.{table}")
    layout.recreate_schema(cat.spark, db, scratch_path(cat.spark, db))
    if cat.spark.catalog.listTables(db):
        raise RuntimeError("the schema kept a table")
    cat.orders.write.format("parquet").saveAsTable(f"{db}.orders")
    return as_result(cat.spark.table(f"{db}.orders"), ORDER_COLS)


def stats_q(cat: Catalog) -> DataFrame:
    """All tables saved in a re-created schema, analyzed; the optimizer's statistics of rows and first key column."""
    db = f"dss_{uuid.uuid4().hex[:12]}"
    layout.recreate_schema(cat.spark, db, scratch_path(cat.spark, db))
    rows = []
    try:
        for table, keys in PRIMARY_KEYS.items():
            cat.table(table).write.format("parquet").saveAsTable(f"{db}.{table}")
            layout.compute_stats(cat.spark, f"{db}.{table}")
            st = layout.table_stats(cat.spark, f"{db}.{table}", keys[0])
            rows.append((table, st["rows"], st["min"], st["max"], st["num_nulls"]))
    finally:
        cat.spark.sql(f"DROP DATABASE {db} CASCADE")
    return cat.spark.createDataFrame(
        rows, "table_name string, row_count bigint, key_min bigint, key_max bigint, key_nulls bigint")


# -- refresh stream --------------------------------------------------------
def land_segments(cat: Catalog, s: RefreshSets, table: str, landing: str, segment: int, segments: int) -> None:
    """Write one of ``segments`` shares of refresh set 1 of a table: a segment of rows and one of delete keys."""
    rows, key = (s.insert_orders, "o_orderkey") if table == "orders" else (s.insert_lines, "l_orderkey")
    mine = F.pmod(F.xxhash64(key), F.lit(segments)) == segment
    write_delimited(to_file_shape(rows.where(mine), table), f"{landing}/{table}.tbl.u1.{segment + 1}")
    mine = F.pmod(F.xxhash64("o_orderkey", F.lit(1)), F.lit(segments)) == segment
    write_delimited(s.delete_keys.where(mine), f"{landing}/delete.u1.{segment + 1}")


def _streamed(cat: Catalog, table: str, files_per_batch: int) -> DataFrame:
    """A table after a refresh set came as segments, in two runs of the stream over one checkpoint."""
    s = refresh_sets(cat, store_keys=table == "lineitem")
    base, cols, key = (s.base_orders, ORDER_COLS, "o_orderkey") if table == "orders" else (s.base_lines, LINE_COLS, "l_orderkey")
    landing, state, ckpt = (scratch_path(cat.spark, f"{kind}-{table}") for kind in ("landing", "state", "ckpt"))
    for segment in range(2):
        land_segments(cat, s, table, landing, segment, 2)
        segment_stream(cat.spark, table, key, landing, state, ckpt, files_per_batch).awaitTermination()
    return as_result(read_state(cat.spark, to_file_shape(base, table), key, state, written_parts(cat.spark, cat.path(table))), cols)


def refresh_stream_q(cat: Catalog, files_per_batch: int = 1000) -> DataFrame:
    """Insert and delete segments of a refresh set arriving as files, applied to the base orders by a stream."""
    return _streamed(cat, "orders", files_per_batch)


def refresh_stream_lines_q(cat: Catalog, files_per_batch: int = 1000) -> DataFrame:
    """The same for lineitem: its insert segments and the delete keys of their orders."""
    return _streamed(cat, "lineitem", files_per_batch)


# -- run logs and reports --------------------------------------------------
def _events_log(cat: Catalog) -> DataFrame:
    return parse_runlog(runlog_lines(events_runlog(cat.raw("events"))))


def runlog_load_q(cat: Catalog) -> DataFrame:
    """A run log derived from events, written as log text and loaded back."""
    path = scratch_path(cat.spark, "runlog")
    runlog_lines(events_runlog(cat.raw("events"))).write.text(path)
    return read_runlog(cat.spark, path)


def report_queries_q(cat: Catalog) -> DataFrame:
    return report_queries(_events_log(cat))


def report_loads_q(cat: Catalog) -> DataFrame:
    return report_loads(_events_log(cat))


def report_analyze_q(cat: Catalog) -> DataFrame:
    return report_analyze(_events_log(cat))


def report_gen_data_q(cat: Catalog) -> DataFrame:
    """The whole run's duration (sum of steps) as seconds, minutes and hours."""
    total = _events_log(cat).agg(F.sum("duration_ms").alias("duration_ms"))
    return report_gen_data(total)


def report_sessions_q(cat: Catalog) -> DataFrame:
    return report_sessions(_events_log(cat))


# -- result comparison -----------------------------------------------------
Q01_CLASSES = {
    "l_returnflag": "str", "l_linestatus": "str", "sum_qty": "sum", "sum_base_price": "sum",
    "sum_disc_price": "sum", "sum_charge": "sum", "avg_qty": "avg", "avg_price": "avg",
    "avg_disc": "avg", "count_order": "cnt",
}


def result_diff_q(cat: Catalog) -> DataFrame:
    """q01 at 90 days against q01 at 120 days, column by column."""
    return result_diff(q01(cat, 90), q01(cat, 120), Q01_CLASSES, ["l_returnflag", "l_linestatus"])
