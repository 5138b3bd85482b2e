"""First operations of a new installation: even ids, doubled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def even_doubled(ids: DataFrame, column: str = "id") -> DataFrame:
    """``doubled``: twice each even id."""
    return ids.filter(F.col(column) % 2 == 0).select((F.col(column) * 2).alias("doubled"))
