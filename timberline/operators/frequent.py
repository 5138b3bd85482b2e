"""The most frequent values of a column that may have any number of different ones, exactly and with a bounded shuffle.

Values are counted by cells of their hash first: a table of a fixed size. No value occurs more often than its cell. The values
of the fullest cells are counted one by one; the n-th of these counts is a bound from below, so only cells that reach
it can hold a value that belongs to the result, and all their values are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.operators.small import bounded
from timberline.session import materialize

CELLS = 1 << 16
# Cells that are looked at first, for each value that is asked for.
FIRST_CELLS = 4


def top(df: DataFrame, value: Column, name: str, n: int, cells: int = CELLS) -> DataFrame:
    """``name, count`` of the n most frequent values; ties by the value. A null value is one like any other.

    ``df`` is read three times, and each time only counts leave the tasks: one for each cell, then one for each value of
    the cells that are looked at. Where the n-th most frequent value is about as rare as all others, these are all cells.
    """
    cell = F.pmod(F.xxhash64(name), F.lit(cells)).alias("_cell")
    values = df.select(value.alias(name)).select(name, cell)
    filled = materialize(values.groupBy("_cell").agg(F.count("*").alias("_filled")), "cells")

    def counted(chosen: DataFrame) -> DataFrame:
        return values.join(bounded(chosen, cells), "_cell", "left_semi").groupBy(name).agg(F.count("*").alias("count"))

    def best(counts: DataFrame) -> DataFrame:
        return counts.orderBy(F.desc("count"), F.asc_nulls_first(name)).limit(n)

    fullest = materialize(filled.orderBy(F.desc("_filled"), "_cell").limit(FIRST_CELLS * n).select("_cell"), "fullest")
    first = best(counted(fullest)).agg(F.count("*").alias("found"), F.min("count").alias("least")).first()
    least = first.least if first.found == n else 0
    return best(counted(materialize(filled.where(F.col("_filled") >= least).select("_cell"), "likely")))
