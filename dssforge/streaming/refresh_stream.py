"""Refresh sets arriving as files, applied by Structured Streaming.

Two streams are here. ``append_stream`` appends files of any format.
``segment_stream`` takes refresh sets as they are produced: numbered segment files of
inserted rows (``{table}.tbl.u{set}.{segment}``, table format) and of deleted
order keys (``delete.u{set}.{segment}``), in any order. Both kinds are read as
text by one stream each, parsed by the typed reader inside the stream, and applied
together, micro-batch by micro-batch.

The state is a base table and a log. A micro-batch writes its rows and keys, with
the number of their set, to its own ``batch_id=`` folder (overwrite), and then its
manifest: only batches with a manifest count. A batch replayed after a failure
replaces its own output, and one that died half way is not seen. A row of set i
is deleted by a key of a later set (a set deletes before it inserts), so what
``read_state`` returns depends on the sets alone, not on the order in which their
segments came. ``compact`` folds the log into a new base.

With the checkpoint in the shared folder a stream resumes where it stopped;
``availableNow`` processes everything present and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dssforge.operators.key_sets import without_keys
from dssforge.sources.delimited import DELETE_SCHEMA, TBL_SCHEMAS, parse_lines

c = F.col

#: Number of the refresh set in a segment's name.
_SET = r"\.u(\d+)\.\d+(?:/|$)"
INSERT, DELETE = "insert", "delete"


def append_stream(spark: SparkSession, landing: str, schema, target: str, checkpoint: str,
                  fmt: str = "parquet", files_per_batch: int = 10, options: dict | None = None,
                  transform=None):
    """Start an availableNow stream from ``landing`` into ``target``; returns the query."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(landing)
    if transform is not None:
        stream = transform(stream)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return (stream.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def read_target(spark: SparkSession, target: str, schema) -> DataFrame:
    """The target table: all batch folders (the batch id is a partition column, dropped)."""
    return spark.read.schema(schema).parquet(target).drop("batch_id")


def _segments(spark: SparkSession, pattern: str, files_per_batch: int) -> DataFrame:
    """Lines of the segments that match, with the number of their set."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(pattern)
    return lines.select("value", F.regexp_extract(c("_metadata.file_path"), _SET, 1).cast("int").alias("refresh_set"))


def segment_stream(spark: SparkSession, table: str, key: str, landing: str, state: str, checkpoint: str,
                   files_per_batch: int = 1000, dummy: bool = True):
    """Start an availableNow stream over insert and delete segments of ``landing`` into the log of ``state``.

    ``key`` is the order key's column in ``table``. Returns the query.
    """
    rows = parse_lines(_segments(spark, f"{landing}/{table}.tbl.u*", files_per_batch), TBL_SCHEMAS[table], dummy)
    names = [x for x in rows.columns if x != "refresh_set"]
    inserted = rows.select("refresh_set", F.lit(INSERT).alias("kind"), c(key).alias("order_key"), F.struct(*names).alias("row"))
    keys = parse_lines(_segments(spark, f"{landing}/delete.u*", files_per_batch), DELETE_SCHEMA, dummy)
    deleted = keys.select("refresh_set", F.lit(DELETE).alias("kind"), c("o_orderkey").alias("order_key"),
                          F.lit(None).cast(inserted.schema["row"].dataType).alias("row"))
    return (inserted.unionByName(deleted).writeStream
            .foreachBatch(lambda batch, batch_id: apply_batch(batch, batch_id, state))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def apply_batch(batch: DataFrame, batch_id: int, state: str) -> None:
    """Write one micro-batch (refresh_set, kind, order_key, row), then its manifest."""
    seen = Observation()
    counted = batch.observe(seen, F.count_if(c("kind") == INSERT).alias("inserted"), F.count_if(c("kind") == DELETE).alias("deleted"))
    counted.write.mode("overwrite").parquet(f"{state}/log/batch_id={batch_id}")
    manifest = batch.sparkSession.createDataFrame([(seen.get["inserted"], seen.get["deleted"])], "inserted long, deleted long")
    manifest.write.mode("overwrite").parquet(f"{state}/manifest/batch_id={batch_id}")


def manifests(spark: SparkSession, state: str) -> DataFrame:
    """(batch_id, inserted, deleted) of the batches that count."""
    return spark.read.schema("inserted long, deleted long, batch_id long").parquet(f"{state}/manifest")


def read_state(spark: SparkSession, base: DataFrame, key: str, state: str, parts: int | None = None) -> DataFrame:
    """The table: base rows and inserted rows without those that a later set deleted (``parts``: see ``without_keys``)."""
    row = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in base.schema)
    log = spark.read.schema(f"refresh_set int, kind string, order_key bigint, row struct<{row}>, batch_id long").parquet(f"{state}/log")
    log = log.join(manifests(spark, state).select(c("batch_id").alias("counted")), c("batch_id") == c("counted"), "left_semi")
    rows = base.select(F.lit(0).alias("_set"), *base.columns)
    rows = rows.unionByName(log.where(c("kind") == INSERT).select(c("refresh_set").alias("_set"), "row.*"))
    gone = log.where(c("kind") == DELETE).groupBy(c("order_key").alias("_key")).agg(F.max("refresh_set").alias("_gone"))
    deleted = manifests(spark, state).agg(F.coalesce(F.sum("deleted"), F.lit(0))).first()[0]
    return without_keys(rows, key, gone, "_key", c("_set") < c("_gone"), n_keys=deleted, parts=parts).drop("_set")


def compact(spark: SparkSession, base: DataFrame, key: str, state: str, path: str) -> DataFrame:
    """``read_state`` written to a new folder as the next base; the old log stays for its readers."""
    read_state(spark, base, key, state).write.mode("errorifexists").parquet(path)
    return spark.read.schema(base.schema).parquet(path)
