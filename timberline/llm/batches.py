"""Arrow batches of texts as flat numpy arrays, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# Bytes of text that are worked on at once; one longer text is a piece of its own.
PIECE_BYTES = 512 << 10
# Bytes of an Arrow batch, about, that comes to a worker at once, and the setting that says so.
BATCH_BYTES = 2 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lets the session send texts to workers in batches of BATCH_BYTES, unless it was given a smaller size.

    By default a batch has up to 10,000 rows and 64 MB, which a worker and the JVM beside it both hold.
    """
    given = spark.conf.get(ARROW_BYTES, "64MB")
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(given)
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the places between its rows; null is an empty text."""
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return everything[at[0] : at[-1]], at - at[0]


def pieces(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, row after the last, bytes, places``: runs of rows with about ``most`` bytes."""
    data, at = flat(texts)
    first, rows = 0, len(texts)
    while first < rows:
        last = int(np.searchsorted(at, at[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def ramps(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length n, one after the other."""
    total = int(lengths.sum())
    starts = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) - np.repeat(starts, lengths)
