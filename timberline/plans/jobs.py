"""Whole jobs: from input folders to result folders. Each result is a folder below ``output_dir``.

A result that is there already is replaced; with ``mode="error"`` a job stops before it reads anything.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline import sinks, sources
from timberline.functions.parse import LEVELS
from timberline.operators import daily, durations, levels, states, usage
from timberline.operators.daily import TLC, TripColumns
from timberline.session import materialize
from timberline.sources import manifest

CHARTS = ("largest_cluster", "duration_histogram", "duration_density", "duration_ticks")


def log_levels(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    heading: str | None = None,
    sample_size: int = 10,
    seed: int = 42,
    repeatable: bool = False,
    words: Sequence[str] = LEVELS,
    header_only: bool = False,
    mode: str = "overwrite",
) -> None:
    """Level counts, a sample of lines and the report, over every file of every folder below ``input_dir``.

    The text is read twice: once for all counts, once for the sample. With ``repeatable`` the sample does
    not depend on the layout of the input, and the text is read a third time; see ``levels.sample_by_text``.
    """
    _ready(spark, mode, output_dir, "level_counts", "level_summary", "level_sample")
    lines = sources.read_logs(spark, input_dir, "*")
    grouped = materialize(levels.groups(lines, words, header_only), "levels")
    sinks.write_csv(levels.in_order(levels.counts_of(grouped, words)), f"{output_dir}/level_counts", mode)
    sinks.write_lines(levels.report_of(grouped, words, heading), f"{output_dir}/level_summary", mode)
    if repeatable:
        sample = levels.sample_by_text(lines, sample_size, seed, words, header_only)
    else:
        sample = levels.sample(lines, sample_size, seed, None, words, header_only)
    sinks.write_csv(sample, f"{output_dir}/level_sample", mode)


def cluster_usage(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    heading: str | None = None,
    catalog: DataFrame | None = None,
    by: str = "line",
    mode: str = "overwrite",
) -> None:
    """Timeline, cluster summary, report and the tables behind the charts.

    The text is read once, for the timeline, which is kept for all later steps. ``catalog`` replaces the
    file listing, for example where folders without files have to be known.
    """
    _ready(spark, mode, output_dir, "timeline", "cluster_summary", "stats", *[f"charts/{name}" for name in CHARTS])
    if catalog is None:
        catalog = sources.app_catalog(sources.file_inventory(spark, input_dir))
    catalog = materialize(catalog, "catalog")
    times = materialize(usage.pad(catalog, usage.timeline(sources.read_logs(spark, input_dir), by)), "timeline")
    counts = usage.cluster_counts(catalog)
    sinks.write_csv(usage.as_text(times), f"{output_dir}/timeline", mode)
    sinks.write_csv(usage.cluster_summary(catalog, times), f"{output_dir}/cluster_summary", mode)
    sinks.write_lines(usage.report(counts, heading=heading), f"{output_dir}/stats", mode)
    _chart_tables(times, counts, f"{output_dir}/charts", mode)


def chart_tables(spark: SparkSession, results_dir: str, output_dir: str, mode: str = "overwrite") -> None:
    """The tables behind the charts from the results of an earlier ``cluster_usage``; no log is read."""
    _ready(spark, mode, output_dir, *CHARTS)
    times = sources.read_results(spark, f"{results_dir}/timeline", sources.TIMELINE_SCHEMA)
    summary = sources.read_results(spark, f"{results_dir}/cluster_summary", sources.SUMMARY_SCHEMA)
    _chart_tables(times, summary, output_dir, mode)


def _chart_tables(times: DataFrame, counts: DataFrame, output_dir: str, mode: str) -> None:
    largest = usage.largest(counts, times)
    d = materialize(durations.durations(times, largest), "durations")
    sinks.write_csv(largest, f"{output_dir}/largest_cluster", mode)
    sinks.write_csv(durations.histogram(d), f"{output_dir}/duration_histogram", mode)
    sinks.write_csv(durations.density(d), f"{output_dir}/duration_density", mode)
    sinks.write_csv(durations.ticks(d), f"{output_dir}/duration_ticks", mode)


def daily_trips(
    spark: SparkSession,
    paths: Iterable[str],
    output_dir: str,
    year: int,
    columns: TripColumns = TLC,
    accuracy: int = 10000,
    merge_groups: int = daily.MERGE_GROUPS,
    mode: str = "overwrite",
) -> None:
    """Daily summary, latest day first, and its totals."""
    _ready(spark, mode, output_dir, "daily_summary", "daily_totals")
    rows = daily.daily_rows(sources.read_trips(spark, paths), year, columns, accuracy, merge_groups)
    summary = materialize(rows, "daily")
    sinks.write_csv(daily.by_day(summary), f"{output_dir}/daily_summary", mode)
    sinks.write_csv(daily.daily_totals(summary), f"{output_dir}/daily_totals", mode)


def update_usage(spark: SparkSession, input_dir: str, state_dir: str, glob: str = "*") -> int:
    """Bring the overview of all applications up to date with the files below ``input_dir``; returns the number of files read.

    Only files are read that the last version has not seen, or has seen with another length or time. Their rows are merged with
    the stored ones: bounds by the least and greatest time, so a file that has grown may be read again. What
    files that are gone have said stays. Without new files nothing is written.
    """
    version = manifest.latest(spark, state_dir)
    stored = {name: spark.read.parquet(f"{manifest.version_path(state_dir, version)}/{name}") for name in ("files", "overview")} if version else {}
    files = materialize(manifest.listing(spark, input_dir, glob), "files")
    new = materialize(manifest.new_files(files, stored.get("files")), "new-files")
    count = new.count()
    if not count:
        return 0
    overviews = [stored["overview"]] if version else []
    for paths in manifest.chunks(new):
        lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file_path"), "value")
        overviews.append(usage.overview(lines))
    # Applications own files without lines as well.
    none = F.lit(None).cast("timestamp_ntz")
    owners = sources.app_catalog(new).select("*", none.alias("start_time"), none.alias("end_time"), F.lit(True).alias("owned"), F.lit(False).alias("named"))
    everything = owners
    for one in overviews:
        everything = everything.unionByName(one)
    target = manifest.version_path(state_dir, version + 1)
    states.merged_overviews(everything).write.mode("overwrite").parquet(f"{target}/overview")
    files.write.mode("overwrite").parquet(f"{target}/files")
    manifest.complete(spark, state_dir, version + 1)
    return count


def usage_of(spark: SparkSession, state_dir: str) -> DataFrame:
    """The overview of the last complete version; see ``usage.padded_of``, ``summary_of``, ``missing_of`` and ``largest_of``."""
    return spark.read.parquet(f"{manifest.version_path(state_dir, manifest.latest(spark, state_dir))}/overview")


def add_trips(spark: SparkSession, paths: Iterable[str], state_dir: str, name: str, columns: TripColumns = TLC) -> None:
    """Store the daily states of some trip files, for example of a month, under a name. The same name replaces them."""
    states.daily_states(sources.read_trips(spark, paths), columns).write.mode("overwrite").parquet(f"{state_dir.rstrip('/')}/part={name}")


def daily_from_states(spark: SparkSession, state_dir: str, output_dir: str, year: int, mode: str = "overwrite") -> None:
    """Daily summary and totals from all stored states; no trip is read."""
    _ready(spark, mode, output_dir, "daily_summary", "daily_totals")
    summary = materialize(states.days_of(states.merged_days(spark.read.parquet(state_dir).drop("part")), year), "daily")
    sinks.write_csv(daily.by_day(summary), f"{output_dir}/daily_summary", mode)
    sinks.write_csv(daily.daily_totals(summary), f"{output_dir}/daily_totals", mode)


def _ready(spark: SparkSession, mode: str, output_dir: str, *names: str) -> None:
    if mode in ("error", "errorifexists"):
        sinks.refuse_existing(spark, [f"{output_dir}/{name}" for name in names])
