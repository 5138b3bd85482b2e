"""Scans: log text, file listings, trip tables, result files."""

from timberline.sources.logs import BELOW, app_catalog, file_inventory, files_of, read_log_splits, read_logs
from timberline.sources.tables import SUMMARY_SCHEMA, TIMELINE_SCHEMA, count_sql, generated_range, preview, profile, read_results
from timberline.sources.trips import month_paths, read_trips, read_trips_below

__all__ = [
    "BELOW",
    "SUMMARY_SCHEMA",
    "TIMELINE_SCHEMA",
    "app_catalog",
    "count_sql",
    "file_inventory",
    "files_of",
    "generated_range",
    "month_paths",
    "preview",
    "profile",
    "read_log_splits",
    "read_logs",
    "read_results",
    "read_trips",
    "read_trips_below",
]
