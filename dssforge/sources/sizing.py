"""Task counts from the size of the data instead of fixed numbers."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Input bytes that one written file, bucket or shuffle partition should hold.
TARGET_BYTES = 256 << 20

#: The same for whole rows that one task shuffles and sorts: in memory they take more than ten times their Parquet bytes.
WRITTEN_BYTES = 32 << 20


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files under ``paths`` (their listing only; no content is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def parts_for(size: int, target: int = TARGET_BYTES) -> int:
    """How many parts of about ``target`` bytes ``size`` bytes make, 1 at least."""
    return max(1, -(-int(size) // target))


def size_shuffles(spark: SparkSession, *paths: str, target: int = TARGET_BYTES) -> int:
    """Set the shuffle partitions from the input's bytes (never fewer than the cores at hand); returns the number.

    Adaptive execution merges small partitions but makes no more of them, so
    the number has to follow the input.
    """
    n = max(parts_for(stored_bytes(spark, *paths), target), spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def written_parts(spark: SparkSession, path: str, target: int = WRITTEN_BYTES) -> int:
    """Parts for rewriting the files at ``path``."""
    return parts_for(stored_bytes(spark, path), target)


#: Bytes of a stored row, about, bits of a runtime filter for each of its items, and the most bits of one filter.
ROW_BYTES, BITS_PER_ITEM, MOST_FILTER_BITS = 64, 8, 1 << 30


def size_runtime_filters(spark: SparkSession, *paths: str) -> int:
    """Let runtime filters be made from sides as large as the tables at ``paths``; returns the items one is made for.

    Spark builds a Bloom filter of a join's smaller side only while that side is under a fixed
    10 MB, so at scale the filters in front of lineitem's shuffles vanish. The threshold and the
    filter's size follow the bytes here, up to ``MOST_FILTER_BITS`` (128 MB); a filter of more items than
    that holds is less selective, never wrong.
    """
    size = stored_bytes(spark, *paths)
    items = max(1_000_000, min(size // ROW_BYTES, MOST_FILTER_BITS // BITS_PER_ITEM))
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    for name, value in (("creationSideThreshold", max(10 << 20, size)), ("expectedNumItems", items), ("maxNumItems", items),
                        ("numBits", items * BITS_PER_ITEM), ("maxNumBits", max(67_108_864, items * BITS_PER_ITEM))):
        spark.conf.set(f"{prefix}.{name}", str(value))
    return items
