"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names.

Tables are written as Parquet and read back, so that a lost executor never
loses them and lineage stays short.  Only where the setting is absent (a
local session, tests) a temporary folder stands in for it.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL: dict[str, str] = {}

#: Most rows of ids that are broadcast (about 16 MB each side); beyond it joins shuffle.
BROADCAST_IDS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one where it is unset."""
    set_by = spark.conf.get("spark.checkpoint.dir", None)
    if set_by:
        return set_by.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="dssforge-llm-")
    return _LOCAL[app]


class Scratch:
    """Named tables of one operator run; ``drop`` removes those no longer needed."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/dssforge-llm/{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table."""
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            fs.delete(path, True)


#: Rows of a small intermediate table per task.
ROWS_PER_TASK = 250_000


def small(ids: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """``ids`` marked for broadcast when its counted rows stay within ``most``, else as it is."""
    return F.broadcast(ids) if ids.limit(most + 1).count() <= most else ids


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast when ``rows``, a counted bound of its rows, is within ``BROADCAST_IDS``."""
    return F.broadcast(df) if rows <= BROADCAST_IDS else df


def fewer_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as few tasks as a counted bound of its rows asks for, where that is few."""
    return df.coalesce(rows // ROWS_PER_TASK + 1) if rows <= BROADCAST_IDS else df


def quoted(name: str) -> Column:
    """A column by its exact name."""
    return F.col("`" + name.replace("`", "``") + "`")


def tidy(task: Callable) -> Callable:
    """``task`` over Arrow batches, whose worker then gives unused memory back: it stays for the stages to come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; other C libraries have none
        if trim:
            trim(0)

    return run


def mapped(df: DataFrame, task: Callable, extra: str) -> DataFrame:
    """``df`` through Arrow tasks that append the columns ``extra`` (a schema); columns of any name stay as they are."""
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    more = T._parse_datatype_string(extra).fields if extra else []
    return plain.mapInArrow(tidy(task), T.StructType([*plain.schema.fields, *more])).toDF(*df.columns, *(f.name for f in more))
