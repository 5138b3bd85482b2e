"""Global row numbers: ranks of all rows in a total order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timberline.session import materialize

PLACE_BITS = 33


def numbered(df: DataFrame, keys: list[str], name: str, column: str = "row") -> DataFrame:
    """``df`` with ``column``: its place from 0 in the order of ``keys``, nulls first.

    Rows are range-partitioned and sorted in their partition, and the result is written once, as the bounds
    of the ranges are sampled and would not be the same in another run. Only one count per partition is
    gathered, summed up and joined back. Rows that are equal in all keys are told apart by where they were
    read, so many of them are spread over several tasks; their numbers are interchangeable.
    """
    tie = "_tie"
    placed = (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*keys, tie)
        .sortWithinPartitions(*keys, tie)
        .drop(tie)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    kept = materialize(placed, name)
    part = F.shiftright("_id", PLACE_BITS)
    counts = kept.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row for each partition of the range shuffle: a bounded table, and the only one in a single task.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        kept.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(column, F.col("_start") + place)
        .drop("_part", "_start", "_id")
    )
