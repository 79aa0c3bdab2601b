"""Query plans as text: the analogue of running a query under EXPLAIN.

``plan_text`` returns what ``DataFrame.explain(mode)`` prints (``formatted``
shows the scans' PushedFilters and ReadSchema, the exchanges and the join
strategies). ``run_with_statistics`` runs the query in full through the ``noop``
sink, so no row reaches the driver, and returns the rows it made and the
seconds it took with its plan. ``plan_statistics`` runs a query and returns one
row per operator of its final adaptive plan, with the rows and the time that its own
metrics counted.
"""

from __future__ import annotations

import contextlib
import io
import re
import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def run_with_statistics(df: DataFrame, mode: str = "formatted") -> dict:
    """Rows, seconds and plan text of one whole run of a query."""
    seen = Observation()
    begun = time.perf_counter()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return {"rows": seen.get["rows"], "seconds": time.perf_counter() - begun, "plan": plan_text(df, mode)}


STATISTICS = "node int, parent int, depth int, operator string, relation string, rows_out long, time_ms double"
#: Metrics that give an operator's own time, by what a unit of theirs is in milliseconds.
_TIMINGS = {"timing": 1.0, "nsTiming": 1e-6}
#: Wrappers without work of their own, and the plan inside them.
_WRAPPERS = {"AdaptiveSparkPlanExec": "executedPlan", "ShuffleQueryStageExec": "plan", "BroadcastQueryStageExec": "plan",
             "TableCacheQueryStageExec": "plan", "ResultQueryStageExec": "plan"}


def _relation(node) -> str | None:
    """Name of a scanned table: the last part of its path, without the suffix or a written table's own number."""
    paths = node.relation().location().rootPaths()
    name = paths.head().getName() if paths.nonEmpty() else ""
    return re.sub(r"\.parquet$|^derived-|-[0-9a-f]{32}$", "", re.sub(r"-[0-9a-f]{32}$", "", name))


def operator_statistics(df: DataFrame) -> list[tuple]:
    """Run ``df`` in full on the executors and return ``STATISTICS`` rows of its final plan, the top operator first.

    rows_out is null for operators that count none. Reused exchanges are listed once, where they ran.
    """
    execution = df._jdf.queryExecution()
    execution.toRdd().count()  # rows stay on the executors; the plan's metrics are filled by this run
    found: list[tuple] = []

    def walk(node, parent: int | None, depth: int) -> None:
        kind = node.getClass().getSimpleName()
        if kind in _WRAPPERS:
            return walk(getattr(node, _WRAPPERS[kind])(), parent, depth)
        name = re.sub(r" \(\d+\)$", "", node.nodeName()).strip()
        if kind in ("InputAdapter", "AQEShuffleReadExec"):
            return walk(node.children().head(), parent, depth)
        rows, spent, metrics = None, None, node.metrics().iterator()
        while metrics.hasNext():
            entry = metrics.next()
            label, metric = entry._1(), entry._2()
            if label == "numOutputRows" or label == "shuffleRecordsWritten":
                rows = metric.value()
            elif metric.metricType() in _TIMINGS:
                spent = (spent or 0.0) + metric.value() * _TIMINGS[metric.metricType()]
        number = len(found)
        found.append((number, parent, depth, name, _relation(node) if kind == "FileSourceScanExec" else None, rows, spent))
        if kind == "ReusedExchangeExec":
            return None
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), number, depth + 1)
        return None

    walk(execution.executedPlan(), None, 0)
    return found


def plan_statistics(df: DataFrame) -> DataFrame:
    """One row per operator of a whole run of ``df`` (see ``STATISTICS``); as many rows as the plan has operators."""
    return df.sparkSession.createDataFrame(operator_statistics(df), STATISTICS)
