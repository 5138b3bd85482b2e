"""Use of clusters by applications: timeline, catalog joins, rankings and report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timberline.functions import parse
from timberline.functions.text import CLUSTER_HEADS, CLUSTER_LINE, times_as_text

TIMELINE = ["cluster_id", "application_id", "app_number", "start_time", "end_time"]


def timeline(lines: DataFrame, by: str = "line") -> DataFrame:
    """First and last time of each application.

    ``by="line"`` takes the application a line names and leaves other lines out. ``by="path"`` takes the
    owner of the file, so every line counts; times are first reduced to one row per file there, and the
    path is parsed once per file. An application without any time keeps null bounds.

    Grouping is by the application id alone (it contains the cluster id), so a join on that id needs no
    further shuffle.
    """
    if by == "line":
        # Few lines name an application; the plain text test spares all others the patterns.
        line = F.col("value")
        times = (
            lines.filter(line.contains("application_") & line.rlike(parse.APPLICATION_ID))
            .select(parse.app_id("value").alias("application_id"), parse.ts("value").alias("time"))
            .groupBy("application_id")
            .agg(F.min("time").alias("start_time"), F.max("time").alias("end_time"))
        )
    elif by == "path":
        times = (
            lines.select("file_path", parse.ts("value").alias("time"))
            .groupBy("file_path")
            .agg(F.min("time").alias("first"), F.max("time").alias("last"), F.count("*").alias("n"))
            # With a count in it, the test of the id is not moved below the grouping, where it would run once per line.
            .select(F.when(F.col("n") > 0, parse.owner("file_path")).alias("application_id"), "first", "last")
            .filter(F.col("application_id") != "")
            .groupBy("application_id")
            .agg(F.min("first").alias("start_time"), F.max("last").alias("end_time"))
        )
    else:
        raise ValueError('by must be "line" or "path"')
    return _with_ids(times)


def _with_ids(times: DataFrame, *further: str) -> DataFrame:
    return times.select(
        parse.cluster_id("application_id").alias("cluster_id"),
        "application_id",
        parse.app_number("application_id").alias("app_number"),
        "start_time",
        "end_time",
        *further,
    )


def overview(lines: DataFrame) -> DataFrame:
    """Catalog and timeline of the same lines in one table, from one scan: a row per application.

    ``cluster_id, application_id, app_number, start_time, end_time, owned, named``: whether the application owns a
    file of the lines, and whether a line names it; the times are those of the lines that name it. Lines are reduced
    to one row per file and named application first, so ids are parsed from few rows after that.
    """
    line = F.col("value")
    named = F.when(line.contains("application_"), parse.app_id("value")).otherwise(F.lit(""))
    time = F.when(line.contains("application_"), parse.ts("value"))
    by_file = (
        lines.select("file_path", named.alias("says"), time.alias("time"))
        .groupBy("file_path", "says")
        .agg(F.min("time").alias("first"), F.max("time").alias("last"))
    )
    none, yes, no = F.lit(None).cast("timestamp_ntz"), F.lit(True), F.lit(False)

    def row(application, first, last, owned, says):
        values = (application, first, last, owned, says)
        return F.struct(*[v.alias(n) for v, n in zip(values, ("application_id", "first", "last", "owned", "named"))])

    both = F.array(
        row(parse.owner("file_path"), none, none, yes, no),
        row(F.col("says"), F.when(F.col("says") != "", F.col("first")), F.when(F.col("says") != "", F.col("last")), no, yes),
    )
    found = (
        by_file.select(F.explode(both).alias("x"))
        .groupBy("x.application_id")
        .agg(
            F.min("x.first").alias("start_time"),
            F.max("x.last").alias("end_time"),
            F.bool_or("x.owned").alias("owned"),
            F.bool_or("x.named").alias("named"),
        )
    )
    return _with_ids(found.filter(F.col("application_id") != ""), "owned", "named")


def padded_of(seen: DataFrame) -> DataFrame:
    """The padded timeline of an ``overview``."""
    return seen.select(*TIMELINE)


def missing_of(seen: DataFrame) -> DataFrame:
    """Applications of an ``overview`` that own files and that no line names."""
    return seen.filter(F.col("owned") & ~F.col("named")).select(*TIMELINE)


def summary_of(seen: DataFrame) -> DataFrame:
    """``cluster_summary`` of an ``overview``, with one grouping by cluster."""
    return (
        seen.groupBy("cluster_id")
        .agg(
            F.count_if("owned").alias("num_applications"),
            F.min("start_time").alias("cluster_first_app"),
            F.max("end_time").alias("cluster_last_app"),
        )
        .filter("num_applications > 0")
    )


def largest_of(seen: DataFrame) -> DataFrame:
    """``largest`` of an ``overview``, with one grouping by cluster."""
    return (
        seen.groupBy("cluster_id")
        .agg(F.count_if("owned").alias("num_applications"), F.count("start_time").alias("timed"))
        .orderBy(F.desc("timed"), F.desc("num_applications"), "cluster_id")
        .limit(1)
    )


def missing(catalog: DataFrame, times: DataFrame) -> DataFrame:
    """Applications of the catalog that the timeline does not know, with null bounds."""
    none = F.lit(None).cast("timestamp_ntz")
    return catalog.join(times.select("application_id"), "application_id", "left_anti").select(
        "cluster_id", "application_id", "app_number", none.alias("start_time"), none.alias("end_time")
    )


def pad(catalog: DataFrame, times: DataFrame) -> DataFrame:
    """The timeline plus ``missing``; applications outside the catalog stay.

    One full outer join instead of an anti join and a union, so the timeline is computed once. Both sides
    come grouped by the application id.
    """
    bounds = times.select("application_id", "start_time", "end_time")
    return _with_ids(catalog.select("application_id").join(bounds, "application_id", "full"))


def as_text(times: DataFrame) -> DataFrame:
    """Published form of the timeline: times as text, ``""`` where there is none, no number column."""
    return times_as_text(times.drop("app_number"))


def cluster_counts(catalog: DataFrame) -> DataFrame:
    """``cluster_id, num_applications``."""
    return (
        catalog.groupBy("cluster_id")
        .agg(F.count_distinct("application_id").alias("application_id"))
        .withColumnRenamed("application_id", "num_applications")
    )


def cluster_bounds(times: DataFrame) -> DataFrame:
    """First start and last end per cluster."""
    return times.groupBy("cluster_id").agg(
        F.min("start_time").alias("cluster_first_app"), F.max("end_time").alias("cluster_last_app")
    )


def cluster_summary(catalog: DataFrame, times: DataFrame) -> DataFrame:
    """``cluster_id, num_applications, cluster_first_app, cluster_last_app`` for the clusters of the catalog."""
    return cluster_counts(catalog).join(cluster_bounds(times), "cluster_id", "left")


def stats(counts: DataFrame) -> DataFrame:
    """One row: ``clusters, applications, avg_applications`` (0.0 without clusters)."""
    applications = F.coalesce(F.sum("num_applications"), F.lit(0))
    return counts.agg(
        F.count("*").alias("clusters"),
        applications.alias("applications"),
        F.coalesce(F.avg("num_applications"), F.lit(0.0)).alias("avg_applications"),
    )


def top(counts: DataFrame, n: int = 5) -> DataFrame:
    """The n clusters with most applications; ties by cluster id."""
    return counts.orderBy(F.desc("num_applications"), "cluster_id").limit(n)


def report(counts: DataFrame, n: int = 5, heading: str | None = None) -> DataFrame:
    """``ord, line``: the text report over ``cluster_counts``. ``heading`` is a first line of the caller's."""
    lines = [
        *([F.lit(heading)] if heading is not None else []),
        F.concat(F.lit(CLUSTER_HEADS[0]), F.col("clusters").cast("string")),
        F.concat(F.lit(CLUSTER_HEADS[1]), F.col("applications").cast("string")),
        F.concat(F.lit(CLUSTER_HEADS[2]), F.format_string("%.2f", "avg_applications")),
        F.lit(""),
        F.lit(CLUSTER_HEADS[3]),
    ]
    head = stats(counts).select(F.posexplode(F.array(*lines)).alias("ord", "line"))
    # The window numbers the n rows that the limit leaves.
    rank = F.row_number().over(Window.orderBy(F.desc("num_applications"), "cluster_id"))
    ranking = top(counts, n).select(
        (rank + F.lit(len(lines) - 1)).alias("ord"),
        F.format_string(CLUSTER_LINE, "cluster_id", "num_applications").alias("line"),
    )
    return head.unionByName(ranking)


def timed_counts(times: DataFrame) -> DataFrame:
    """``cluster_id, timed``: applications that have a start time, per cluster.

    A timeline has one row per application, so known starts are counted and nothing needs to be distinct.
    """
    return times.groupBy("cluster_id").agg(F.count("start_time").alias("timed"))


def largest(counts: DataFrame, times: DataFrame) -> DataFrame:
    """The cluster with most timed applications, or with most applications where none is timed; one row.

    Clusters known to only one of the two tables take part as well.
    """
    zero = F.lit(0).cast("bigint")
    return (
        counts.select("cluster_id", "num_applications")
        .join(timed_counts(times), "cluster_id", "full")
        .select(
            "cluster_id",
            F.coalesce("num_applications", zero).alias("num_applications"),
            F.coalesce("timed", zero).alias("timed"),
        )
        .orderBy(F.desc("timed"), F.desc("num_applications"), "cluster_id")
        .limit(1)
    )
