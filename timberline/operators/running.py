"""Sums over the rows that come before, for groups of any size: no task needs all rows of a group.

Rows are range-partitioned by group and order, so a large group lies in several partitions, one behind the other. Each
partition is summed on its own; of each group and partition only the total is carried on to the next ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from timberline.session import materialize

PART = "_part"
# Rows that come before a row, and those that come after it: before it in the opposite order.
BEFORE, AFTER = F.asc, F.desc
EARLIER = (Window.unboundedPreceding, -1)


def parted(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``df`` with the number of its partition in the order of ``keys`` and ``order``, written once.

    The bounds of the partitions are sampled, so another run could draw them elsewhere; what reads the
    table reads the same partitions. Rows that are equal in all these columns lie in one partition: count them first
    if there may be many.
    """
    return materialize(df.repartitionByRange(*keys, *order).withColumn(PART, F.spark_partition_id()), name)


def sums_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, before: str, name: str = "running") -> DataFrame:
    """``df`` with ``before``: the sum of ``amount`` over the rows of the same ``keys`` that come earlier in ``order``.

    ``order`` has to tell the rows of a group apart. Null keys are a group of their own; the first row has 0.
    """
    zero = F.lit(0)
    found = scanned(parted(df, keys, order, name), keys, order, {before: (F.sum, amount, BEFORE)})
    return found.withColumn(before, F.coalesce(before, zero)).drop(PART)


def scanned(kept: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, tuple]) -> DataFrame:
    """``kept``, a table of ``parted``, with further columns from the rows of the same keys before or after each row.

    ``columns`` has ``name: (aggregate, column, BEFORE or AFTER)`` where the aggregate is ``F.sum``, ``F.min`` or ``F.max``.
    Null where no such row is. A group has one total for each partition that it touches, so the window over totals is
    small also where the group is not.
    """

    def inner(side) -> WindowSpec:
        return Window.partitionBy(*keys, PART).orderBy(*map(side, order)).rowsBetween(*EARLIER)

    def outer(side) -> WindowSpec:
        return Window.partitionBy(*keys).orderBy(side(PART)).rowsBetween(*EARLIER)

    totals = kept.groupBy(*keys, PART).agg(*[how(of).alias(f"_total_{name}") for name, (how, of, _) in columns.items()])
    carried = totals.select(*keys, PART, *[how(f"_total_{name}").over(outer(side)).alias(f"_far_{name}") for name, (how, _, side) in columns.items()])
    near = kept.withColumns({f"_near_{name}": how(of).over(inner(side)) for name, (how, of, side) in columns.items()})
    found = with_carry(near, carried, keys)
    for name, (how, _, _) in columns.items():
        found = found.withColumn(name, _both(how, F.col(f"_near_{name}"), F.col(f"_far_{name}")))
    return found.drop(*[f"_{side}_{name}" for side in ("near", "far") for name in columns])


def _both(how, near: Column, far: Column) -> Column:
    if how is F.sum:
        return F.coalesce(near + far, near, far)
    # Both skip nulls.
    return F.least(near, far) if how is F.min else F.greatest(near, far)


def with_carry(df: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with what its keys and partition carry; null keys meet as well."""
    names = [*keys, PART]
    right = carried.select(*[F.col(name).alias(f"_{i}") for i, name in enumerate(names)], *[c for c in carried.columns if c not in names])
    same = [F.col(name).eqNullSafe(F.col(f"_{i}")) for i, name in enumerate(names)]
    return df.join(right, same).drop(*[f"_{i}" for i in range(len(names))])
