"""Text forms used by the sinks and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lines and headings of the reports.
LEVEL_HEADS = (
    "Total log lines processed: ",
    "Total lines with log levels: ",
    "Unique log levels found: ",
    "Log level distribution:",
)
CLUSTER_HEADS = (
    "Total unique clusters: ",
    "Total applications: ",
    "Average applications per cluster: ",
    "Most heavily used clusters:",
)
LEVEL_LINE = "  %-5s: %,12d (%6.2f%%)"
CLUSTER_LINE = "  Cluster %s: %d applications"


def time_text(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, and ``""`` for a missing time."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string").substr(1, 19), F.lit(""))


def text_time(c: Column | str) -> Column:
    """The way back: empty or bad text gives null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit("")).try_cast("timestamp_ntz")


def times_as_text(df: DataFrame) -> DataFrame:
    """All time columns of a table as text."""
    times = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))]
    return df.withColumns({name: time_text(name) for name in times}) if times else df


def count_text(c: Column | str) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(c, 0)
