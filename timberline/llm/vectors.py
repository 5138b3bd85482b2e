"""Vectors of Arrow batches as matrices, and sums of small tables in a tree of tasks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Small tables that one task of a tree puts together.
FAN_IN = 16


def finite(vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """``width: (rows, matrix)`` of the vectors that have components, all of them finite numbers."""
    offsets = np.asarray(vectors.offsets)
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    widths = np.diff(offsets)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = vectors.is_valid().to_numpy(zero_copy_only=False) & (widths > 0) & (bad[offsets[1:]] == bad[offsets[:-1]])
    out = {}
    for width in np.unique(widths[good]).tolist():
        rows = np.flatnonzero(good & (widths == width))
        out[width] = (rows, flat[offsets[rows][:, None] + np.arange(width)])
    return out


def floors(values: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x) as doubles; raises where one is not below ``limit`` in size."""
    out = np.floor(scale * values)
    if out.size and np.abs(out).max() >= limit:
        raise OverflowError(f"components have to stay below {limit / scale:.4g} in size")
    return out


def tree(tables: DataFrame, keys: list[str], parts: int, merge: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """One row for each of ``keys`` from rows numbered by ``part`` below ``parts``, a few at a time.

    ``merge`` takes rows of the same keys and gives one row with the same columns.
    """
    while parts > 1:
        parts = -(-parts // FAN_IN)
        tables = tables.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long"))
        tables = tables.groupBy(*keys, "part").applyInPandas(merge, tables.schema)
    return tables


def record(schema: str, *values) -> pa.RecordBatch:
    """A batch of one row."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    names, types = zip(*(part.split() for part in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array([x], kinds[kind]) for x, kind in zip(values, types)], names=list(names))
