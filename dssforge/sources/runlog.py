"""Run logs: one pipe-separated line per timed step.

Line format ``id|description|tuples|HH:MM:SS.F`` where the benchmark's
logger prints hours modulo 24 and, after the seconds, the *total*
milliseconds of the step (at least three digits). So ``00:01:05.65123``
means 65.123 s and ``01:00:00.90000000`` means 25 h: F alone is the duration,
which is kept as exact bigint milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

c = F.col

def format_duration(ms: Column) -> Column:
    """The logger's text for a duration in milliseconds (its printf format)."""
    s = (ms / 1000).cast("bigint")
    return F.format_string("%02d:%02d:%02d.%03d", F.pmod(s / 3600, F.lit(24)).cast("bigint"),
                           (s / 60).cast("bigint") % 60, s % 60, ms)


def parse_duration(text: Column) -> Column:
    """Milliseconds from ``HH:MM:SS.F``: F, the total; from the clock where F is missing."""
    parts = F.split(text, "[:.]")
    clock = (F.get(parts, F.lit(0)).cast("bigint") * 3600 + F.get(parts, F.lit(1)).cast("bigint") * 60
             + F.get(parts, F.lit(2)).cast("bigint"))
    return F.coalesce(F.get(parts, F.lit(3)).cast("bigint"), clock * 1000)


def parse_runlog(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse a frame of log text lines into (id, description, tuples, duration_ms)."""
    f = F.split(c(column), r"\|")
    return (lines.filter(F.length(F.trim(c(column))) > 0)
            .select(f.getItem(0).cast("bigint").alias("id"),
                    f.getItem(1).alias("description"),
                    f.getItem(2).cast("bigint").alias("tuples"),
                    parse_duration(f.getItem(3)).alias("duration_ms")))


def read_runlog(spark: SparkSession, path: str) -> DataFrame:
    """Read log files (a file, folder or glob); an empty file gives no rows."""
    return parse_runlog(spark.read.text(path))


def runlog_lines(rows: DataFrame) -> DataFrame:
    """Format (id, description, tuples, duration_ms) rows as log lines (column ``value``)."""
    return rows.select(F.concat_ws("|", c("id").cast("string"), c("description"),
                                   c("tuples").cast("string"), format_duration(c("duration_ms"))).alias("value"))


def events_runlog(events: DataFrame) -> DataFrame:
    """A run log derived from the events table.

    id = event_id, description = session '.' step with session
    ``user_id % 10 + 1`` and step = event_type, tuples = ``user_id % 3``,
    duration = value seconds as whole milliseconds.
    """
    return events.select(
        c("event_id").cast("bigint").alias("id"),
        F.concat((c("user_id") % 10 + 1).cast("string"), F.lit("."), c("event_type")).alias("description"),
        (c("user_id") % 3).cast("bigint").alias("tuples"),
        F.round(c("value") * 1000).cast("bigint").alias("duration_ms"))
