"""Trip tables in Parquet, by file list or below a partitioned root."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Fixed value: place of a month below the root.
MONTH_FILE = "yyyy={year}/yellow_tripdata_{year}-{month:02d}.parquet"


def month_paths(root: str, year: int, months: Iterable[int], template: str = MONTH_FILE) -> list[str]:
    """Paths of the given months of a year."""
    return [f"{root.rstrip('/')}/{template.format(year=year, month=month)}" for month in months]


def read_trips(spark: SparkSession, paths: Iterable[str], base_path: str | None = None) -> DataFrame:
    """Union of Parquet files of one schema. With ``base_path`` the folder names below it become columns."""
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    return reader.parquet(*paths)


def read_trips_below(spark: SparkSession, root: str, year: int | None = None) -> DataFrame:
    """All trips below a root with ``yyyy=`` folders; with ``year`` only that folder is listed and read."""
    path = root if year is None else f"{root.rstrip('/')}/yyyy={year}"
    return spark.read.option("basePath", root).parquet(path)
