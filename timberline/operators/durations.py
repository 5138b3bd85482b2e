"""Distribution of application durations: histogram, axis ticks and density of their logarithm.

The tables here are made in two steps, bounds first and then the figures. Give ``durations`` a timeline
that is written or cached (see ``materialize``), else the lines behind it are read once per step.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.operators.small import made_small

HISTOGRAM_BINS = 30
# Usual settings of a Gaussian density curve: points of the curve, and bandwidths it runs past the data.
DENSITY_POINTS = 200
DENSITY_CUT = 3


def durations(times: DataFrame, cluster: str | DataFrame | None = None) -> DataFrame:
    """Applications with a positive duration in seconds and its base 10 logarithm.

    ``cluster`` restricts them to one cluster, given as an id or as the one-row table of
    ``usage.largest``, which is small enough to be broadcast.
    """
    if isinstance(cluster, DataFrame):
        times = times.join(made_small(cluster.select("cluster_id").limit(1), 1), "cluster_id")
    elif cluster is not None:
        times = times.filter(F.col("cluster_id") == cluster)
    seconds = (F.col("end_time") - F.col("start_time")).cast("interval second").cast("bigint")
    return (
        times.select("cluster_id", "application_id", seconds.alias("duration"))
        .filter(F.col("duration") > 0)
        .withColumn("log_duration", F.log10("duration"))
    )


def bounds(d: DataFrame) -> DataFrame:
    """One row: ``n, lo, hi, sd`` of the logarithms."""
    return d.agg(
        F.count("*").alias("n"),
        F.min("log_duration").alias("lo"),
        F.max("log_duration").alias("hi"),
        F.stddev_samp("log_duration").alias("sd"),
    )


def _bounds_value(d: DataFrame) -> Column:
    # A scalar subquery: its one value is put into the plan of the tasks, no join is needed.
    b = bounds(d)
    return b.select(F.struct(*b.columns)).scalar()


def histogram(d: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """``bin, bin_from, bin_to, count, density_scale`` with equal bins from the least to the greatest value.

    The last bin includes the greatest value; bins without a row have count 0; where all values are
    equal, bin 1 holds them. ``density_scale`` turns the density curve into counts. No durations give no
    rows.
    """
    b = _bounds_value(d)
    x, lo, hi = F.col("log_duration"), F.col("b.lo"), F.col("b.hi")
    number = F.when(hi > lo, F.least(F.width_bucket(x, lo, hi, F.lit(bins)), F.lit(bins))).otherwise(F.lit(1))
    counted = (
        d.select("log_duration", b.alias("b"))
        .groupBy(number.cast("int").alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    width = (hi - lo) / bins
    domain = d.sparkSession.range(1, bins + 1, 1, numPartitions=1).select(
        F.col("id").cast("int").alias("bin"), b.alias("b")
    )
    return (
        domain.filter("b.n > 0")
        .join(made_small(counted, bins), "bin", "left")
        .select(
            "bin",
            (lo + (F.col("bin") - 1) * width).alias("bin_from"),
            (lo + F.col("bin") * width).alias("bin_to"),
            F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
            (F.col("b.n") * width).alias("density_scale"),
        )
    )


def ticks(d: DataFrame) -> DataFrame:
    """``tick, label``: whole powers of ten around the values."""
    b = bounds(d).filter("n > 0")
    return b.select(F.explode(F.sequence(F.floor("lo"), F.ceil("hi"))).alias("tick")).select(
        "tick", F.format_number(F.pow(F.lit(10.0), "tick"), 0).alias("label")
    )


def density(d: DataFrame, points: int = DENSITY_POINTS) -> DataFrame:
    """``point, x, density``: Gaussian density curve of the logarithms.

    Bandwidth is the sample deviation times n^(-1/5). Equal durations are counted first (they are whole
    seconds, so few are distinct); each distinct value is then spread over the points of the curve inside
    its task, and the points are summed before the shuffle. Needs two distinct values.
    """
    b = _bounds_value(d)
    h = F.col("b.sd") * F.pow(F.col("b.n").cast("double"), F.lit(-0.2))
    first = F.col("b.lo") - DENSITY_CUT * h
    x = first + F.col("point") * (F.col("b.hi") + DENSITY_CUT * h - first) / (points - 1)
    z = (x - F.col("log_duration")) / h
    values = d.groupBy("log_duration").agg(F.count("*").alias("weight"))
    return (
        values.select("log_duration", "weight", b.alias("b"))
        .filter("b.sd > 0")
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy("point")
        .agg(F.sum(F.col("weight") * F.exp(-0.5 * z * z)).alias("total"))
        .select("point", "total", b.alias("b"))
        .select("point", x.alias("x"), (F.col("total") / (F.col("b.n") * h * math.sqrt(2 * math.pi))).alias("density"))
    )
