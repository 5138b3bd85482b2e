"""Sweep lines: how many intervals are open at a time, and how much of a range intervals cover.

Both put the ends of intervals in order and carry a figure along. The order is distributed (see ``running``), so an
application with most of the tasks, or a file that most splits read, is spread over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.operators.running import AFTER, BEFORE, PART, parted, scanned


def concurrency(intervals: DataFrame, key: str = "application_id", start: str = "start_time", end: str = "finish_time") -> DataFrame:
    """``key, time_from, time_to, running``: how many intervals of a key are open, from each of their ends to the next.

    Intervals that lack an end, end before they start, or are empty take no part. Times at which as many start as
    end are ends as well. Equal times are counted first, so a key has one row for each time.
    """
    known = intervals.filter(F.col(start) < F.col(end))
    ends = F.explode(F.array(*[F.struct(F.col(c).alias("time"), F.lit(step).alias("step")) for c, step in ((start, 1), (end, -1))]))
    steps = known.select(key, ends.alias("x")).groupBy(key, F.col("x.time").alias("time_from")).agg(F.sum("x.step").alias("step"))
    kept = parted(steps, [key], ["time_from"], "sweep")
    found = scanned(kept, [key], ["time_from"], {"before": (F.sum, "step", BEFORE), "time_to": (F.min, "time_from", AFTER)})
    running = F.coalesce("before", F.lit(0)) + F.col("step")
    return found.filter("time_to is not null").select(key, "time_from", "time_to", running.alias("running"))


def peaks(busy: DataFrame, key: str = "application_id") -> DataFrame:
    """``key, peak, peak_from, busy_seconds``: most open intervals at once, since when, and for how long any was open."""
    seconds = (F.col("time_to") - F.col("time_from")).cast("interval second").cast("bigint")
    # The earliest of the times with most intervals.
    most = F.min(F.struct((-F.col("running")).alias("fewest"), "time_from"))
    return (
        busy.groupBy(key)
        .agg(most.alias("most"), F.coalesce(F.sum(F.when(F.col("running") > 0, seconds)), F.lit(0)).alias("busy_seconds"))
        .select(key, (-F.col("most.fewest")).alias("peak"), F.col("most.time_from").alias("peak_from"), "busy_seconds")
    )


def coverage(intervals: DataFrame, key: str = "path", start: str = "offset", length: str = "length") -> DataFrame:
    """``key, splits, bytes, covered``: intervals, their lengths added up, and how much of the range they cover at least once.

    Intervals that are read again count in ``splits`` and ``bytes`` only. A null or negative start or length covers nothing.
    """
    each = intervals.groupBy(key, start, length).agg(F.count("*").alias("times"))
    good = (F.col(start) >= 0) & (F.col(length) > 0)
    # One interval for each start is enough: the longest. Others lie inside of it.
    ends = each.groupBy(key, start).agg(
        F.sum("times").alias("times"),
        F.sum(F.col("times") * F.col(length)).alias("bytes"),
        F.max(F.when(good, F.col(start) + F.col(length))).alias("end"),
    )
    found = scanned(parted(ends, [key], [start], "splits"), [key], [start], {"reached": (F.max, "end", BEFORE)})
    new = F.col("end") - F.greatest(start, "reached")
    return found.groupBy(key).agg(
        F.sum("times").alias("splits"), F.sum("bytes").alias("bytes"), F.coalesce(F.sum(F.when(new > 0, new)), F.lit(0)).alias("covered")
    )
