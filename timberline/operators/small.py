"""Joins with a table that is expected to be small: its size is known or counted before it is sent to every task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Rows of a table that is sent to every task, at most, where a caller's argument says how many there are.
MOST_ROWS = 100_000


def made_small(small: DataFrame, rows: int, most: int = MOST_ROWS) -> DataFrame:
    """``small`` with the hint to broadcast it, for a table that cannot have more than ``rows`` rows by the way it is made.

    Beyond ``most`` it comes without the hint.
    """
    return F.broadcast(small) if rows <= most else small


def fits(small: DataFrame, rows: int) -> bool:
    """Whether a table has at most ``rows`` rows; no more than that and one are counted. Give a written table."""
    return small.limit(rows + 1).count() <= rows


def bounded(small: DataFrame, rows: int, strict: bool = False) -> DataFrame:
    """``small`` with the hint to broadcast it if it has at most ``rows`` rows.

    With more, it comes without the hint, so the join is a shuffled one; with ``strict`` that raises.
    """
    if fits(small, rows):
        return F.broadcast(small)
    if strict:
        raise ValueError(f"the table was expected to have at most {rows} rows")
    return small


def with_small(left: DataFrame, small: DataFrame, keys: list[str], rows: int, finish: Callable[[DataFrame], DataFrame], needs: Column) -> DataFrame:
    """``finish(left joined with small)``, a left join of which only the rows that meet ``needs`` can find a partner.

    Up to ``rows`` rows, ``small`` is broadcast. Beyond, only the rows that need it are shuffled to it, and the others are
    read a second time.
    """
    if fits(small, rows):
        return finish(left.join(F.broadcast(small), keys, "left"))
    met = F.coalesce(needs, F.lit(False))
    apart = left.filter(met).join(small.hint("shuffle_merge"), keys, "left")
    none = [F.lit(None).cast(field.dataType).alias(field.name) for field in small.schema.fields if field.name not in keys]
    return finish(apart).unionByName(finish(left.filter(~met).select("*", *none)))
