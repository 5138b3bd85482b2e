"""Daily summary of trips."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TripColumns:
    """Names of the six trip columns in use."""

    pickup: str = "tpep_pickup_datetime"
    distance: str = "trip_distance"
    tax: str = "mta_tax"
    fare: str = "fare_amount"
    tip: str = "tip_amount"
    passengers: str = "passenger_count"


TLC = TripColumns()
FARE_QUANTILE = 0.95
DAY = ["dt_year", "dt_month", "dt_day"]
MERGE_GROUPS = 64


def in_year(trips: DataFrame, year: int, columns: TripColumns = TLC) -> DataFrame:
    """Trips of one year, as a range on the time column, which the Parquet scan can use to skip data.

    A time with a zone is compared, and its day taken, in the session's zone; ``session`` sets UTC.
    """
    start, end = (F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp_ntz") for y in (year, year + 1))
    pickup = F.col(columns.pickup)
    return trips.filter((pickup >= start) & (pickup < end))


def _latest_first() -> list[Column]:
    return [F.desc(name) for name in DAY]


def daily_summary(
    trips: DataFrame,
    year: int,
    columns: TripColumns = TLC,
    accuracy: int = 10000,
    merge_groups: int = MERGE_GROUPS,
) -> DataFrame:
    """One row per day of ``year``, latest first; see ``daily_rows``."""
    return by_day(daily_rows(trips, year, columns, accuracy, merge_groups))


def daily_rows(
    trips: DataFrame,
    year: int,
    columns: TripColumns = TLC,
    accuracy: int = 10000,
    merge_groups: int = MERGE_GROUPS,
) -> DataFrame:
    """One row per day of ``year``, in no order.

    Trips are grouped by one date value; year, month and day are taken from it once per day.

    Each scan task has one sketch of the fares per day. So that no single task has to merge all sketches of
    a day with very many trips, the scan tasks fall into ``merge_groups``: counting these groups as distinct
    values makes Spark merge by day and group first, and by day alone after that. A first merge takes as many
    sketches as there are tasks in a group: give the square root of the number of scan tasks, 64 being right for
    about 4,000.

    A scan task holds a sketch for each of the 366 days at most. A sketch keeps up to about ``50 * accuracy``
    values before it is compressed, which is some hundred KB at 10,000, so allow for a few hundred MB in a task that
    reads trips of all days, or lower ``accuracy``. ``session.SETTINGS`` raises the number of groups up to which
    Spark hashes them to just above that; a session without it sorts the rest of each task's trips.
    """
    return (
        in_year(trips, year, columns)
        .withColumn("merge_group", F.spark_partition_id() % merge_groups)
        .groupBy(F.to_date(columns.pickup).alias("day"))
        .agg(
            F.count_distinct("merge_group").alias("merge_groups"),
            F.count("*").alias("num_trips"),
            F.avg(columns.distance).alias("mean_trip_distance"),
            F.max(columns.tax).alias("max_mta_tax"),
            F.percentile_approx(columns.fare, FARE_QUANTILE, accuracy).alias("q95_fare_amount"),
            F.min(columns.tip).alias("min_tip_amount"),
            F.ceil(F.avg(columns.passengers)).alias("mean_passenger_count"),
        )
        # Always true; a column nobody uses would be left out of the plan.
        .filter("merge_groups > 0")
        .select(
            F.year("day").alias("dt_year"),
            F.month("day").alias("dt_month"),
            F.dayofmonth("day").alias("dt_day"),
            "num_trips",
            "mean_trip_distance",
            "max_mta_tax",
            "q95_fare_amount",
            "min_tip_amount",
            "mean_passenger_count",
        )
    )


def by_day(daily: DataFrame) -> DataFrame:
    """A daily summary, latest day first."""
    return daily.orderBy(*_latest_first())


def latest(daily: DataFrame, n: int = 20) -> DataFrame:
    """The n latest days of a daily summary."""
    return by_day(daily).limit(n)


def daily_totals(daily: DataFrame) -> DataFrame:
    """One row: ``days, first_day, last_day, num_trips, mean_daily_trips``."""
    day = F.make_date(*DAY)
    return daily.agg(
        F.count("*").alias("days"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.coalesce(F.sum("num_trips"), F.lit(0)).alias("num_trips"),
        F.avg("num_trips").alias("mean_daily_trips"),
    )


def year_count(trips: DataFrame, year: int, columns: TripColumns = TLC) -> DataFrame:
    """One row: ``num_trips`` of a year."""
    return in_year(trips, year, columns).agg(F.count("*").alias("num_trips"))
