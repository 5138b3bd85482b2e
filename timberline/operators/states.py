"""Results kept as states that can be merged: a new month or folder is added without reading the others again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.functions import parse
from timberline.operators.daily import DAY, FARE_QUANTILE, MERGE_GROUPS, TLC, TripColumns

# Size of a quantile sketch: a quantile's rank is within about 0.4 % of the wanted one, and exact up to some 1,000 trips.
SKETCH_SIZE = 1024


def daily_states(trips: DataFrame, columns: TripColumns = TLC, sketch_size: int = SKETCH_SIZE, merge_groups: int = MERGE_GROUPS) -> DataFrame:
    """A row for each day of the trips: counts, sums, extremes and a sketch of the fares. See ``merged_days``.

    A day with very many trips is summed up by groups of scan tasks first. Trips without a time are left out.
    """
    day = F.to_date(columns.pickup).alias("day")
    group = (F.spark_partition_id() % merge_groups).alias("merge_group")
    number = lambda name: F.col(name).cast("double")
    parts = (
        trips.where(F.col(columns.pickup).isNotNull())
        .groupBy(day, group)
        .agg(
            F.count("*").alias("num_trips"),
            F.sum(number(columns.distance)).alias("distance"),
            F.count(columns.distance).alias("distances"),
            F.max(columns.tax).alias("max_mta_tax"),
            F.min(columns.tip).alias("min_tip_amount"),
            F.sum(number(columns.passengers)).alias("passengers"),
            F.count(columns.passengers).alias("passenger_trips"),
            F.kll_sketch_agg_double(number(columns.fare), F.lit(sketch_size)).alias("fares"),
        )
    )
    return merged_days(parts.drop("merge_group"), sketch_size)


def merged_days(states: DataFrame, sketch_size: int = SKETCH_SIZE) -> DataFrame:
    """One state for each day from any number of them, in any order of merging."""
    total = lambda name: F.sum(name).alias(name)
    return states.groupBy("day").agg(
        total("num_trips"),
        total("distance"),
        total("distances"),
        F.max("max_mta_tax").alias("max_mta_tax"),
        F.min("min_tip_amount").alias("min_tip_amount"),
        total("passengers"),
        total("passenger_trips"),
        F.kll_merge_agg_double("fares", F.lit(sketch_size)).alias("fares"),
    )


def days_of(states: DataFrame, year: int) -> DataFrame:
    """The daily summary of a year, in no order, from merged states; the columns are those of ``daily.daily_rows``."""
    start, end = (F.make_date(F.lit(y), F.lit(1), F.lit(1)) for y in (year, year + 1))
    mean = lambda total, n: F.when(F.col(n) > 0, F.col(total) / F.col(n))
    fare = F.when(F.kll_sketch_get_n_double("fares") > 0, F.kll_sketch_get_quantile_double("fares", F.lit(FARE_QUANTILE)))
    return states.where((F.col("day") >= start) & (F.col("day") < end)).select(
        *[part("day").alias(name) for part, name in zip((F.year, F.month, F.dayofmonth), DAY)],
        "num_trips",
        mean("distance", "distances").alias("mean_trip_distance"),
        "max_mta_tax",
        fare.alias("q95_fare_amount"),
        "min_tip_amount",
        F.ceil(mean("passengers", "passenger_trips")).alias("mean_passenger_count"),
    )


def application_bitmaps(catalog: DataFrame) -> DataFrame:
    """``cluster_id, bucket, bitmap``: which application numbers a cluster has, a bit for each. See ``merged_bitmaps``.

    Numbers of a cluster are dense, so a bucket of 32,768 of them is 4 KB. Applications whose numbers differ in leading
    zeros only count as one.
    """
    number = parse.app_number("application_id").try_cast("bigint")
    numbered = catalog.select(parse.cluster_id("application_id").alias("cluster_id"), number.alias("number")).where("number is not null")
    return numbered.groupBy("cluster_id", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.groupBy("cluster_id", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counts_of(bitmaps: DataFrame) -> DataFrame:
    """``cluster_id, num_applications`` from merged bitmaps: an exact count, of which no id was shuffled."""
    return bitmaps.groupBy("cluster_id").agg(F.sum(F.bitmap_count("bitmap")).alias("num_applications"))


def merged_overviews(overviews: DataFrame) -> DataFrame:
    """One row for each application from any number of rows of ``usage.overview``."""
    return overviews.groupBy("cluster_id", "application_id", "app_number").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.bool_or("owned").alias("owned"), F.bool_or("named").alias("named")
    )
