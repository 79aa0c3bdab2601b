"""Physical layout of stored tables: each a DataFrameWriter or SQL call.

* yearly partitions (1992-1998 plus ``others``) so date predicates prune
  whole folders;
* hash co-location by key (bucketing) so that joins on the key read
  matching buckets without a shuffle;
* sort order inside files so Parquet row-group min/max statistics skip
  data for range predicates, along one column or a space-filling order of
  several, and a proof that a stored table is sorted;
* zstd compression, statistics for the cost-based optimizer, compaction,
  schema re-creation.

Layout writers pay one shuffle at write time so that later reads do not:
yearly folders are written from date ranges (one or two folders per task,
not one file per task and year), buckets from a hash partitioning with one
task per bucket, and ``maxRecordsPerFile`` bounds file size.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dssforge.sources.sizing import written_parts

c = F.col

# --- fixed values: yearly partitions of the date-partitioned layout ---
FIRST_YEAR, LAST_YEAR = 1992, 1998
OTHERS = "others"


def year_partition(col: str) -> F.Column:
    """Partition value: the year for 1992..1998, ``others`` outside."""
    y = F.year(c(col))
    return F.when(y.between(FIRST_YEAR, LAST_YEAR), y.cast("string")).otherwise(F.lit(OTHERS))


def write_year_partitioned(df: DataFrame, date_col: str, path: str, part_col: str = "year",
                           spread_cols: list[str] | None = None, max_records: int = 5_000_000,
                           compression: str = "snappy", mode: str = "errorifexists", parts: int | None = None) -> None:
    """Write into yearly folders (1992-1998 plus ``others``).

    Rows are range-partitioned by the date (then ``spread_cols``, so one very
    large day is still split over several tasks): each task holds a
    contiguous date range and writes to one or two folders, instead of every
    task writing a file into every year. Within a task rows are sorted by
    date, so row-group min/max statistics are tight. ``parts`` is the number of
    ranges (by default the session's shuffle partitions).
    """
    keys = [date_col] + list(spread_cols or [])
    out = _ranged(df, parts, keys).withColumn(part_col, year_partition(date_col))
    out = out.sortWithinPartitions(part_col, *keys)
    (out.write.mode(mode).option("maxRecordsPerFile", max_records).option("compression", compression)
     .partitionBy(part_col).parquet(path))


def _ranged(df: DataFrame, parts: int | None, keys: list[str]) -> DataFrame:
    return df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int,
                   sort: bool = True, mode: str = "errorifexists") -> None:
    """Hash-distribute by ``key`` into ``buckets`` buckets (catalog table at ``path``).

    Rows are first hash-partitioned by the key into as many partitions as
    buckets (Spark uses the same hash for both), so each bucket is written
    by one task as one file instead of one file per writing task and bucket.
    """
    w = (df.repartition(buckets, key).write.mode(mode).format("parquet").option("path", path)
         .bucketBy(buckets, key))
    if sort:
        w = w.sortBy(key)
    w.saveAsTable(table)


def write_sorted(df: DataFrame, path: str, sort_cols: list[str], compression: str = "snappy",
                 spread_cols: list[str] | None = None, cluster: bool = True,
                 mode: str = "errorifexists", options: dict | None = None, parts: int | None = None) -> None:
    """Write rows ordered by ``sort_cols`` so min/max statistics skip data.

    With ``cluster`` the rows are first range-partitioned by the sort columns
    (then ``spread_cols``, so one very large value is still split over
    tasks): files then cover disjoint ranges and a range predicate skips
    whole files, not only row groups inside each file. ``parts`` is the number
    of ranges (by default the session's shuffle partitions).
    """
    keys = list(sort_cols) + list(spread_cols or [])
    out = _ranged(df, parts, keys) if cluster else df
    w = out.sortWithinPartitions(*keys).write.mode(mode).option("compression", compression)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.parquet(path)


def write_compressed(df: DataFrame, path: str, codec: str = "zstd", level: int | None = None,
                     mode: str = "errorifexists") -> None:
    w = df.write.mode(mode).option("compression", codec)
    if codec == "zstd" and level is not None:
        w = w.option("parquet.compression.codec.zstd.level", str(level))
    w.parquet(path)


def write_distributed(df: DataFrame, path: str, files: int, key: str | None = None,
                      mode: str = "errorifexists") -> None:
    """Distribute rows over ``files`` files by hash of ``key``, or evenly when no key is given."""
    out = df.repartition(files, key) if key else df.repartition(files)
    out.write.mode(mode).parquet(path)


def compute_stats(spark: SparkSession, table: str) -> None:
    """Full-scan table and column statistics for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def table_stats(spark: SparkSession, table: str, column: str) -> dict:
    """Row count of a table and min / max / null count of one column, from the catalog.

    Reads catalog metadata only, not the table; bounds are whole numbers of the
    column's type, None for a column without values.
    """
    described = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])
    info = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table} {column}").collect()}

    def number(name: str) -> int | None:
        return None if info.get(name) in (None, "NULL") else int(info[name])

    return {"rows": described["statistics"]["num_rows"], "min": number("min"), "max": number("max"), "num_nulls": number("num_nulls")}


def _as_number(df: DataFrame, col: str) -> F.Column:
    """A column's values as numbers in the same order: texts by their first six bytes."""
    kind = df.schema[col].dataType.simpleString()
    if kind == "string":
        first = F.rpad(F.hex(F.substring(F.encode(c(col), "UTF-8"), 1, 6)), 12, "0")
        return F.conv(first, 16, 10).cast("double")
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_date(c(col).cast("date")).cast("double")
    return c(col).cast("double")


def _rank(value: F.Column, cuts: list[float]) -> F.Column:
    """How many of the ascending cuts are at most the value, by halving."""
    if not cuts:
        return F.lit(0)
    mid = len(cuts) // 2
    return F.when(value >= cuts[mid], _rank(value, cuts[mid + 1:]) + mid + 1).otherwise(_rank(value, cuts[:mid]))


def interleaved(df: DataFrame, cols: list[str], bits: int = 6) -> F.Column:
    """A space-filling order over several columns: their ranks' bits in turn, the highest first.

    A rank is the column's place among 2 ** ``bits`` - 1 quantiles, which one aggregation
    over the table finds for all columns (mergeable sketches of fixed size). Skewed columns
    have fewer distinct quantiles, so they take fewer bits. NULL ranks as 0.
    """
    if bits * len(cols) > 62:
        raise ValueError("bits of all columns must fit a long")
    parts = 1 << bits
    marks = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    found = df.agg(*[F.percentile_approx(_as_number(df, x), marks, 10_000).alias(f"q{i}") for i, x in enumerate(cols)]).first()
    ranks = []
    for i, x in enumerate(cols):
        cuts = sorted(set(found[f"q{i}"] or []))
        rank = F.coalesce(_rank(_as_number(df, x), cuts), F.lit(0))
        ranks.append((rank, len(cuts).bit_length()))
    out = F.lit(0).cast("bigint")
    for level in range(bits):
        for rank, width in ranks:
            if level < width:
                one = F.shiftright(rank, width - 1 - level).bitwiseAND(F.lit(1)).cast("bigint")
                out = F.shiftleft(out, 1).bitwiseOR(one)
    return out


def write_interleaved(df: DataFrame, path: str, cols: list[str], bits: int = 6, files: int | None = None,
                      spread_cols: list[str] | None = None, compression: str = "zstd", mode: str = "errorifexists") -> None:
    """Write rows along a space-filling order of several columns, so min/max statistics of each of them skip files.

    Rows are range-partitioned by the order (then ``spread_cols``, so that many equal rows spread over
    files): every file covers a small box in all the columns instead of a thin slice of one.
    """
    keys = ["_order", *(spread_cols or [])]
    ranged = df.withColumn("_order", interleaved(df, cols, bits))
    _ranged(ranged, files, keys).sortWithinPartitions(*keys).drop("_order").write.mode(mode).option("compression", compression).parquet(path)


def files_read(spark: SparkSession, path: str, predicate: F.Column) -> DataFrame:
    """(files, files_hit): files of a stored table, and those whose rows meet a predicate."""
    table = spark.read.parquet(path).select(c("_metadata.file_path").alias("file"), predicate.alias("hit"))
    per_file = table.groupBy("file").agg(F.max(F.coalesce(c("hit"), F.lit(False))).alias("hit"))
    return per_file.agg(F.count(F.lit(1)).alias("files"), F.count_if("hit").alias("files_hit"))


#: Rows of a file that are compared in one group when its order is proved.
PROOF_ROWS = 1 << 16


def order_proof(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(files, rows, unsorted_rows, overlapping_files, first_key, last_key) of a stored table.

    Whether it is sorted by ``key`` as a whole: inside files by row position, and across files, where those in
    the order of their first key may share no more than an end. Rows meet their neighbour inside blocks of
    ``PROOF_ROWS`` positions of a file; a block then gives one row (first and last key), and a file one row
    after that, so no task holds a file. NULL keys sort first, as Spark writes them.
    """
    order = F.struct(c("key").isNotNull().alias("known"), c("key"))
    rows = spark.read.parquet(path).select(c("_metadata.file_path").alias("file"), c("_metadata.row_index").alias("at"), c(key).alias("key"))
    rows = rows.select("file", "at", F.floor(c("at") / PROOF_ROWS).alias("block"), order.alias("k"))
    inside = Window.partitionBy("file", "block").orderBy("at")
    marked = rows.withColumn("wrong", F.coalesce(c("k") < F.lag("k").over(inside), F.lit(False)).cast("int"))
    blocks = marked.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("wrong").alias("wrong"), F.min_by("k", "at").alias("first"), F.max_by("k", "at").alias("last"),
        F.min("k").alias("least"), F.max("k").alias("most"))
    along = Window.partitionBy("file").orderBy("block")
    blocks = blocks.withColumn("wrong", c("wrong") + F.coalesce(c("first") < F.lag("last").over(along), F.lit(False)).cast("int"))
    files = blocks.groupBy("file").agg(F.sum("rows").alias("rows"), F.sum("wrong").alias("wrong"), F.min("least").alias("least"), F.max("most").alias("most"))
    across = Window.orderBy("least", "most")  # one row per file
    files = files.withColumn("overlap", F.coalesce(c("least") < F.max("most").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)))
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("wrong"), F.lit(0)).alias("unsorted_rows"),
        F.count_if("overlap").alias("overlapping_files"), F.min("least")["key"].alias("first_key"), F.max("most")["key"].alias("last_key"))


def compact(spark: SparkSession, src: str, dst: str, files: int | None = None) -> None:
    """Rewrite a table into ``files`` files, by default of the target size (a new folder; readers switch afterwards)."""
    spark.read.parquet(src).repartition(files or written_parts(spark, src)).write.mode("errorifexists").parquet(dst)


def recreate_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Drop a namespace with everything in it and create it again."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE {name}{loc}")
