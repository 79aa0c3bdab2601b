"""Load a dataset of table files into a Parquet folder the Catalog reads.

For each table, ``{src}/{table}.tbl*`` (one file or many chunks, read as one
glob and split across tasks) is parsed with the table's schema and written
to ``{dst}/{table}.parquet``. lineitem and orders are range-partitioned and
sorted by their date (then key), so files cover disjoint date ranges and
Parquet min/max statistics let date predicates skip whole files and row
groups. The result is the loader's row-count report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dssforge.operators.layout import write_sorted
from dssforge.session import scratch_path
from dssforge.sources.delimited import TBL_SCHEMAS, parse_lines
from dssforge.sources.sizing import written_parts
from dssforge.sources.tables import TABLE_NAMES, union_all

# Date column each fact table is clustered by, then its key (to split large days).
SORT_KEYS = {"lineitem": (["l_shipdate"], ["l_orderkey", "l_linenumber"]),
             "orders": (["o_orderdate"], ["o_orderkey"])}


def load_tables(spark: SparkSession, src: str, dst: str, tables: list[str] | None = None,
                pattern: str = "{table}.tbl*", dummy: bool = True, compression: str = "snappy",
                compression_options: dict | None = None) -> DataFrame:
    """Load table files into ``dst``; returns (table_name, tuples) per loaded table."""
    found = []
    for table in tables or TABLE_NAMES:
        lines = spark.read.text(f"{src.rstrip('/')}/{pattern.format(table=table)}").select("value")
        found.append((table, _load_lines(lines, table, dst, dummy, compression, compression_options)))
    return spark.createDataFrame(found, "table_name string, tuples bigint")


def load_counted(spark: SparkSession, src: str, dst: str, tables: list[str] | None = None,
                 pattern: str = "{table}.tbl*", dummy: bool = True, compression: str = "snappy",
                 compression_options: dict | None = None) -> DataFrame:
    """Load table files into ``dst``; returns (table_name, source_file, tuples), the rows inserted from each file
    (its folder and name).

    The parsed rows are written once with the file they came from. The table is loaded from these rows and
    their files are counted on that one column, exactly for any number of files and without
    gathering them on the driver, so the source is read and parsed once. A file without rows has no line
    of its own; a table without rows has one, with 0.
    """
    found = []
    for table in tables or TABLE_NAMES:
        lines = spark.read.text(f"{src.rstrip('/')}/{pattern.format(table=table)}")
        told = lines.select("value", F.substring_index("_metadata.file_path", "/", -2).alias("source_file"))
        staged = scratch_path(spark, f"parsed-{table}")
        if _load_lines(told, table, dst, dummy, compression, compression_options, staged):
            counts = spark.read.schema("source_file string").parquet(staged).groupBy("source_file").agg(F.count(F.lit(1)).alias("tuples"))
        else:
            counts = spark.createDataFrame([(None, 0)], "source_file string, tuples bigint")
        found.append(counts.select(F.lit(table).alias("table_name"), "source_file", "tuples"))
    return union_all(found)


def _load_lines(lines: DataFrame, table: str, dst: str, dummy: bool, compression: str, compression_options: dict | None,
                staged: str | None = None) -> int:
    """Load a table's text lines into ``dst``; returns its rows, observed on the write.

    Columns of ``lines`` besides ``value`` are kept with the parsed rows in the folder ``staged``, not in the table.
    """
    spark, seen = lines.sparkSession, Observation()
    df = parse_lines(lines, TBL_SCHEMAS[table], dummy).observe(seen, F.count(F.lit(1)).alias("rows"))
    out = f"{dst.rstrip('/')}/{table}.parquet"
    if table in SORT_KEYS:
        # Parsed rows are written once before they are ranged: drawing the ranges would run the observed read twice.
        staged = staged or scratch_path(spark, f"parsed-{table}")
    if staged:
        df.write.parquet(staged)
        df = spark.read.schema(df.drop(*lines.columns).schema).parquet(staged)
    if table in SORT_KEYS:
        dates, spread = SORT_KEYS[table]
        write_sorted(df, out, dates, compression=compression, spread_cols=spread, options=compression_options, parts=written_parts(spark, staged))
    else:
        w = df.write.mode("errorifexists").option("compression", compression)
        for k, v in (compression_options or {}).items():
            w = w.option(k, v)
        w.parquet(out)
    return seen.get["rows"]


def store_bucketed(cat, database: str, location: str, buckets: int):
    """Store orders and lineitem bucketed (and sorted) by order key.

    Both are written as catalog tables of ``database`` with the same number
    of buckets, so joins and per-order aggregations on the order key read
    matching buckets without a shuffle. Returns a Catalog that reads those
    two tables and everything else from the original folder.
    """
    from dssforge.operators.layout import write_bucketed
    from dssforge.sources.tables import Catalog
    spark = cat.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location.rstrip('/')}/{database}.db'")
    names = {}
    for table, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        ident = f"{database}.{table}"
        write_bucketed(cat.table(table), ident, f"{location.rstrip('/')}/{database}.{table}", key, buckets)
        names[table] = ident
    return Catalog(spark, cat.sf_dir, tables=names, complete=cat.complete)
