"""Column statistics kept per partition and merged, so a refresh analyses only what changed.

A partition's statistics are one row per column: rows, NULLs, least and greatest value, and a
grid histogram (how many values fall into each cell of a fixed width). All of
them add up exactly, so merging partitions equals a scan of the whole table, and the
equi-height bounds that an optimizer wants are cut from the merged grid. Values
are numbers here: dates count as days since 1970-01-01.

``analyze`` scans the partitions it is given and writes their rows into folders of their
own (dynamic partition overwrite), so the statistics of other partitions stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

c = F.col

STATS = "column_name string, row_count bigint, null_count bigint, min_value double, max_value double, grid map<bigint,bigint>, part string"


def _value(df: DataFrame, col: str) -> Column:
    kind = df.schema[col].dataType.simpleString()
    return (F.unix_date(col) if kind == "date" else c(col)).cast("double")


def partition_rows(df: DataFrame, part_col: str, widths: dict[str, float]) -> DataFrame:
    """Statistics (``STATS``) of each partition of ``df``; ``widths`` has the cell width of each column.

    Values are counted per (partition, column, cell) first, so a shuffle moves counts, and a
    partition's grid has as many entries as its values span cells.
    """
    cells = F.inline(F.array(*[F.struct(F.lit(x).alias("column_name"), _value(df, x).alias("v"), F.lit(float(w)).alias("w")) for x, w in widths.items()]))
    long = df.select(c(part_col).cast("string").alias("part"), cells).withColumn("cell", F.floor(c("v") / c("w")))
    per_cell = long.groupBy("part", "column_name", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    return per_cell.groupBy("part", "column_name").agg(
        F.sum("n").alias("row_count"), F.sum(F.when(c("cell").isNull(), c("n")).otherwise(0)).alias("null_count"),
        F.min("least").alias("min_value"), F.max("most").alias("max_value"),
        F.map_from_entries(F.collect_list(F.when(c("cell").isNotNull(), F.struct("cell", "n")))).alias("grid"),
    ).select("column_name", "row_count", "null_count", "min_value", "max_value", "grid", "part")


def analyze(df: DataFrame, part_col: str, widths: dict[str, float], path: str, parts: list[str] | None = None) -> None:
    """Scan ``df`` (only the partitions ``parts``, if given) and put their statistics into ``path``."""
    seen = df if parts is None else df.where(c(part_col).cast("string").isin(parts))
    found = partition_rows(seen, part_col, widths)
    found.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def forget(spark: SparkSession, path: str, parts: list[str]) -> None:
    """Drop the statistics of partitions that are gone."""
    for part in parts:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part={part}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Stored statistics, a row per partition and column."""
    return spark.read.schema(STATS).parquet(path)


def merged(stats: DataFrame, widths: dict[str, float], buckets: int = 4) -> DataFrame:
    """(column_name, row_count, null_count, min_value, max_value, bounds): the whole table's statistics.

    ``bounds`` are the beginnings of the cells in which each further 1 / ``buckets`` of the values is reached.
    """
    whole = stats.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"))
    grid = stats.select("column_name", F.explode("grid").alias("cell", "n")).groupBy("column_name", "cell").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("column_name").orderBy("cell")  # a column's cells, counts only
    running = grid.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(Window.partitionBy("column_name")))
    hits = [F.when((c("upto") * buckets >= c("total") * k) & ((c("upto") - c("n")) * buckets < c("total") * k), c("cell")) for k in range(1, buckets)]
    width = F.create_map(*[x for name, w in widths.items() for x in (F.lit(name), F.lit(float(w)))])
    bounds = running.groupBy(c("column_name").alias("of")).agg(*[F.min(h).alias(f"b{k}") for k, h in enumerate(hits, 1)])
    bounds = bounds.select("of", F.array(*[c(f"b{k}") * width[c("of")] for k in range(1, buckets)]).alias("bounds"))
    return whole.join(bounds, c("column_name") == c("of"), "left").drop("of")
