"""Tables of counters of a fixed width, counted in each task and merged by ranges of cells.

A sketch has a fixed number of cells whatever the size of the data, so it may be sent to the driver and to all
tasks. Cells can only be shared by several keys: counts are never too low.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 14
# Tasks whose counts meet in the first level of merging.
FAN_IN = 64

_SCHEMA = "chunk int, part int, cells binary"


def counted(texts: DataFrame, cells_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], width: int) -> np.ndarray:
    """Number of times that ``cells_of`` gave each cell below ``width``, over all batches of ``texts``.

    Each task counts for itself and sends ranges of cells that were met; these are added up by range and group of
    tasks first and by range after that. ``width`` is a power of two and bounds what reaches the driver, in one job: an iterator
    over the rows would start a job for each partition.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = np.zeros(width, np.uint32)
        for batch in batches:
            for cells in cells_of(batch):
                # Few cells are added one by one, many in one sweep over the table.
                if cells.size * 8 < width:
                    np.add.at(table, cells, np.uint32(1))
                else:
                    table += np.bincount(cells, minlength=width).astype(np.uint32)
        chunks = table.reshape(-1, min(CHUNK, width))
        met = np.flatnonzero(chunks.any(axis=1))
        part = TaskContext.get().partitionId() // FAN_IN
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(met, pa.int32()),
                pa.array(np.full(met.size, part), pa.int32()),
                pa.array([chunks[i].astype("<u8").tobytes() for i in met], pa.binary()),
            ],
            names=["chunk", "part", "cells"],
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(cells, "<u8") for cells in frame["cells"])
        return pd.DataFrame({"chunk": frame["chunk"][:1], "part": frame["part"][:1], "cells": [total.tobytes()]})

    merged = texts.mapInArrow(count, _SCHEMA).groupBy("chunk", "part").applyInPandas(add, _SCHEMA)
    merged = merged.groupBy("chunk").applyInPandas(add, _SCHEMA)
    out = np.zeros((width // min(CHUNK, width), min(CHUNK, width)), np.uint64)
    for row in merged.select("chunk", "cells").collect():
        out[row.chunk] = np.frombuffer(row.cells, "<u8")
    return out.reshape(-1)
