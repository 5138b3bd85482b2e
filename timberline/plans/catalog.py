"""The queries of the package over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline import sinks, sources
from timberline.functions import parse
from timberline.operators import basics, daily, durations, entries, levels, messages, states, sweep, usage
from timberline.plans import standins
from timberline.session import scratch_path

YEAR = 1997
DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals: their last bits depend on the order of summing."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(name, DIGITS) for name in doubles}) if doubles else df


def on_logs(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(operator(standins.logs(spark, sf_dir)))


def on_files(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return on_logs(lambda lines: operator(sources.files_of(lines)))


def on_trips(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(operator(standins.trips(spark, sf_dir)))


def catalog_of(lines: DataFrame) -> DataFrame:
    return sources.app_catalog(sources.files_of(lines))


def counts_of(lines: DataFrame) -> DataFrame:
    return usage.cluster_counts(catalog_of(lines))


def padded(lines: DataFrame) -> DataFrame:
    return usage.padded_of(usage.overview(lines))


def largest_durations(lines: DataFrame) -> DataFrame:
    # Both sides come from the same grouping, whose exchange is used again: the lines are read once.
    seen = usage.overview(lines)
    return durations.durations(usage.padded_of(seen), usage.largest_of(seen))


def drawn_at_random(lines: DataFrame) -> DataFrame:
    """Facts about a random draw that can be compared: its rows, those with a level, those that the lines hold."""
    drawn = levels.sample(lines)
    held = lines.select(F.col("value").alias("log_entry")).distinct().withColumn("held", F.lit(True))
    return drawn.join(held, "log_entry", "left").agg(
        F.count("*").alias("drawn"),
        F.count_if(F.expr("contains(log_entry, log_level) AND log_level <> ''")).alias("with_level"),
        F.count("held").alias("found"),
    )


def text_scan_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = standins.log_folder(spark, sf_dir, by=("app",))
    return levels.counts(sources.read_logs(spark, folder, standins.FOLDER_LOGS))


def text_scan_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = standins.log_folder(spark, sf_dir, by=("app",))
    lines = sources.read_logs(spark, folder, standins.FOLDER_LOGS)
    return usage.pad(sources.app_catalog(sources.file_inventory(spark, folder)), usage.timeline(lines))


def traced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries.entries(sources.read_log_splits(spark, standins.trace_folder(spark, sf_dir), standins.TRACE_LOGS))


def log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traced(spark, sf_dir).select(parse.container_id("file_path").alias("container_id"), "line_no", *entries.HEADER, "value")


def task_concurrency(lines: DataFrame) -> DataFrame:
    return sweep.concurrency(messages.task_times(messages.task_events(lines)))


def app_file_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.app_bytes(sources.file_inventory(spark, standins.log_folder(spark, sf_dir)))


def app_size_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(messages.app_size_stats(app_file_bytes(spark, sf_dir)))


def daily_totals(trips: DataFrame) -> DataFrame:
    totals = daily.daily_totals(daily.daily_summary(trips, YEAR))
    days = {name: F.date_format(name, "yyyy-MM-dd") for name in ("first_day", "last_day")}
    return totals.withColumns(days)


def _by_month(trips: DataFrame) -> DataFrame:
    return trips.groupBy("yyyy", "mm").agg(
        F.count("*").alias("num_trips"), F.min(daily.TLC.fare).alias("min_fare"), F.max(daily.TLC.fare).alias("max_fare")
    )


def month_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months of a year, given as a list of paths."""
    root = standins.trip_folder(spark, sf_dir)
    paths = sources.month_paths(root, YEAR, range(1, 13), standins.FOLDER_MONTH)
    return _by_month(sources.read_trips(spark, paths, base_path=root))


def year_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a filter on the folder columns."""
    return _by_month(sources.read_trips_below(spark, standins.trip_folder(spark, sf_dir), YEAR))


def daily_from_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily summary from states that were made month by month."""
    root = standins.trip_folder(spark, sf_dir)
    paths = sources.month_paths(root, YEAR, range(1, 13), standins.FOLDER_MONTH)
    parts = [states.daily_states(sources.read_trips(spark, [path], base_path=root)) for path in paths]
    return rounded(daily.by_day(states.days_of(states.merged_days(reduce(DataFrame.unionByName, parts)), YEAR)))


def counts_of_halves(lines: DataFrame) -> DataFrame:
    """Applications per cluster from the bitmaps of two halves of the lines."""
    halves = [states.application_bitmaps(catalog_of(lines.where(F.col("event_id") % 2 == half))) for half in (0, 1)]
    return states.counts_of(states.merged_bitmaps(halves[0].unionByName(halves[1])))


def even_doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basics.even_doubled(standins.table(spark, sf_dir, "events"), "event_id")


def sql_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.count_sql(standins.table(spark, sf_dir, "orders"))


def results_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "timeline-csv")
    sinks.write_csv(usage.as_text(padded(standins.logs(spark, sf_dir))), path)
    return sources.read_results(spark, path, sources.TIMELINE_SCHEMA)


QUERIES: dict[str, Query] = {
    # levels
    "log_totals": on_logs(levels.totals),
    "log_level_counts": on_logs(levels.counts),
    "log_level_share": on_logs(levels.share),
    "distinct_levels": on_logs(levels.distinct_levels),
    "log_level_report": on_logs(levels.report),
    "log_sample": on_logs(lambda lines: levels.sample(lines, key="event_id")),
    "log_sample_rand": on_logs(drawn_at_random),
    "log_sample_by_text": on_logs(levels.sample_by_text),
    "log_header_levels": on_logs(lambda lines: levels.counts(lines, header_only=True)),
    "log_header": on_logs(parse.with_header),
    "log_entries": log_entries,
    "log_entry_sizes": lambda spark, sf_dir: entries.entry_sizes(traced(spark, sf_dir)),
    "log_level_groups": on_logs(levels.groups),
    "level_occurrences": on_logs(levels.occurrences),
    # files and containers
    "app_catalog": on_logs(catalog_of),
    "log_inventory": on_logs(messages.inventory),
    "log_file_counts": on_files(messages.file_counts),
    "app_top_files": on_files(messages.top_apps_by_files),
    "container_parts": on_files(messages.containers),
    "app_file_bytes": app_file_bytes,
    "app_size_stats": app_size_stats,
    "text_scan_levels": text_scan_levels,
    "text_scan_timeline": text_scan_timeline,
    # use of clusters
    "app_timeline": on_logs(usage.timeline),
    "app_timeline_by_path": on_logs(lambda lines: usage.timeline(lines, by="path")),
    "apps_missing": on_logs(lambda lines: usage.missing_of(usage.overview(lines))),
    "app_timeline_padded": on_logs(padded),
    "app_timeline_text": on_logs(lambda lines: usage.as_text(padded(lines))),
    "cluster_counts": on_logs(counts_of),
    "cluster_counts_merged": on_logs(counts_of_halves),
    "cluster_summary": on_logs(lambda lines: usage.summary_of(usage.overview(lines))),
    "cluster_stats": on_logs(lambda lines: usage.stats(counts_of(lines))),
    "cluster_report": on_logs(lambda lines: usage.report(counts_of(lines))),
    "cluster_top5": on_logs(lambda lines: usage.top(counts_of(lines))),
    "cluster_largest": on_logs(lambda lines: usage.largest_of(usage.overview(lines))),
    # durations
    "app_durations": on_logs(largest_durations),
    "duration_histogram": on_logs(lambda lines: durations.histogram(largest_durations(lines))),
    "duration_ticks": on_logs(lambda lines: durations.ticks(largest_durations(lines))),
    "duration_density": on_logs(lambda lines: durations.density(largest_durations(lines))),
    # messages
    "component_top20": on_logs(messages.components),
    "component_frequent": on_logs(messages.frequent_components),
    "error_lines": on_logs(messages.error_lines),
    "error_counts": on_logs(messages.error_counts),
    "resource_requests": on_logs(messages.resource_requests),
    "container_sizes": on_logs(messages.container_sizes),
    "task_events": on_logs(messages.task_events),
    "task_times": on_logs(lambda lines: messages.task_times(messages.task_events(lines))),
    "task_time_by_app": on_logs(
        lambda lines: messages.task_time_by_app(messages.task_times(messages.task_events(lines)))
    ),
    "stage_spread": on_logs(lambda lines: messages.stage_spread(messages.task_events(lines))),
    "task_concurrency": on_logs(task_concurrency),
    "task_peaks": on_logs(lambda lines: sweep.peaks(task_concurrency(lines))),
    "python_times": on_logs(messages.python_times),
    "python_times_first20": on_logs(lambda lines: messages.first_python_times(messages.python_times(lines))),
    "stored_blocks": on_logs(messages.stored_blocks),
    "memory_blocks": on_logs(messages.memory_blocks),
    "memory_capacity": on_logs(messages.memory_capacity),
    "input_splits": on_logs(messages.input_splits),
    "input_coverage": on_logs(lambda lines: sweep.coverage(messages.split_reads(lines))),
    "broadcast_reads": on_logs(messages.broadcast_reads),
    # trips
    "daily_summary": on_trips(lambda trips: daily.daily_summary(trips, YEAR)),
    "daily_from_months": daily_from_months,
    "daily_top20": on_trips(lambda trips: daily.latest(daily.daily_summary(trips, YEAR))),
    "daily_totals": on_trips(daily_totals),
    "year_filter_count": on_trips(lambda trips: daily.year_count(trips, YEAR)),
    "trips_profile": on_trips(lambda trips: sources.profile(trips, "trips")),
    "month_scan": month_scan,
    "year_scan": year_scan,
    # session and results
    "even_doubled": even_doubled,
    "sql_count": sql_count,
    "results_reload": results_reload,
}
