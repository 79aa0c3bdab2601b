"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (runtime join selection,
# partition coalescing, skew splitting), UTC dates, no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast size checks: the planner broadcasts a join side only when its
    # size estimate is under the threshold, and adaptive execution re-checks
    # with the measured shuffle size; beyond it the join stays sort-merge.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "dssforge", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for lineage cuts and rewritten tables.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``
    (read from the session, never changed here: Spark does not allow it at
    run time). Only a local session without the setting falls back to a
    temporary folder, one per application, also registered as the
    checkpoint directory of the context.
    """
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = sc.applicationId
    if app not in _LOCAL_FALLBACK:
        path = tempfile.mkdtemp(prefix="dssforge-ckpt-")
        sc.setCheckpointDir(path)
        _LOCAL_FALLBACK[app] = path
    return _LOCAL_FALLBACK[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one written table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"
