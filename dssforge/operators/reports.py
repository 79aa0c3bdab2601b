"""Reports over run logs (id, description, tuples, duration_ms).

``description`` is ``schema.step`` for single-user runs and
``session.query`` for multi-user runs. Seconds are derived from exact
millisecond sums (``sum(ms) / 1000.0``) so that results do not depend on
summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

c = F.col


def _seconds(ms):
    return ms.cast("double") / 1000.0


def report_queries(log: DataFrame) -> DataFrame:
    """Per query id (second part of description): max tuples, min seconds."""
    return (log.groupBy(F.split_part(c("description"), F.lit("."), F.lit(2)).alias("id"))
            .agg(F.max("tuples").alias("tuples"), _seconds(F.min("duration_ms")).alias("duration"))
            .orderBy("id"))


def report_loads(log: DataFrame) -> DataFrame:
    """Per table (second part of description), steps that loaded rows: sum tuples, sum seconds."""
    return (log.filter(c("tuples") > 0)
            .groupBy(F.split_part(c("description"), F.lit("."), F.lit(2)).alias("table_name"))
            .agg(F.sum("tuples").alias("tuples"), _seconds(F.sum("duration_ms")).alias("duration"))
            .orderBy("table_name"))


def report_analyze(log: DataFrame) -> DataFrame:
    """Steps that returned no rows, with their seconds."""
    return (log.filter(c("tuples") == 0)
            .select("description", _seconds(c("duration_ms")).alias("seconds"))
            .orderBy("description", "seconds"))


def report_gen_data(durations: DataFrame) -> DataFrame:
    """Each duration as three rows: Seconds, Minutes, Hours."""
    s = _seconds(c("duration_ms"))
    return durations.select(F.inline(F.array(
        F.struct(F.lit("Seconds").alias("time"), s.alias("value")),
        F.struct(F.lit("Minutes").alias("time"), (s / 60).alias("value")),
        F.struct(F.lit("Hours").alias("time"), (s / 3600).alias("value")))))


#: Sessions that have a column of their own, as in the benchmark's report.
SESSIONS = tuple(str(n) for n in range(1, 11))


def report_sessions(log: DataFrame, sessions: tuple[str, ...] | list[str] = SESSIONS) -> DataFrame:
    """Query x session matrix of seconds (sum per cell, 0 where a session did not run it).

    One aggregation over the log. Sessions that are not listed (or missing
    from the line) add up in ``session_other``, so nothing is dropped.
    """
    parts = log.select(F.split_part(c("description"), F.lit("."), F.lit(2)).alias("query_id"),
                       F.split_part(c("description"), F.lit("."), F.lit(1)).alias("session"),
                       "duration_ms")
    listed = F.coalesce(c("session").isin(*sessions), F.lit(False))
    cells = {f"session_{s}": c("session") == s for s in sessions} | {"session_other": ~listed}
    return (parts.groupBy("query_id")
            .agg(*[_seconds(F.coalesce(F.sum(F.when(which, c("duration_ms"))), F.lit(0))).alias(name)
                   for name, which in cells.items()])
            .orderBy("query_id"))
