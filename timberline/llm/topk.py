"""Exact top-k search by tiled matrix products.

Vectors are packed into shards of bounded size, and the queries among them into blocks. A tile is a block of
queries and a shard: one matrix product gives all scores, of which each query keeps its k best. Tiles of a block
are dealt out in groups; a task goes through the shards of its group and carries the best so far along; the
lists of the groups are merged in a tree, a fixed number of lists at a time, until one is left for each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timberline.session import materialize

K = 5
SCALE = 256
QUERY_STEP = 50
# Bytes and rows at most of a shard; queries of a block, about; queries and shard that make a tile at once.
SHARD_BYTES = 2 << 20
SHARD_ROWS = 4096
BLOCK_ROWS = 4096
TILE_ROWS = 1024
# Shards that one task goes through, about, and lists that one task merges.
FAN_IN = 16
# Integers up to this are exact in a double.
EXACT = 1 << 53
MISSING = -np.inf

_SHARD = "shard long, width int, queries int, ids binary, vectors binary"
_BEST = "block long, part long, query long, query_id long, vec_id long, score long"


def quantised(vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows that take part, by the number of components: ``width: rows`` and their floor(SCALE * x).

    Rows that are null, hold a null or a number that is not finite are left out. So are empty vectors, which
    have no components to multiply.
    """
    offsets = np.asarray(vectors.offsets)
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    good = vectors.is_valid().to_numpy(zero_copy_only=False).copy()
    widths = np.diff(offsets)
    good &= widths > 0
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good &= bad[offsets[1:]] == bad[offsets[:-1]]
    out = {}
    for width in np.unique(widths[good]).tolist():
        rows = np.flatnonzero(good & (widths == width))
        values = flat[offsets[rows][:, None] + np.arange(width)]
        out[width] = (rows, np.floor(SCALE * values))
    return out


def shards(vectors: DataFrame, query_step: int) -> DataFrame:
    """Packed vectors: each row has a number of vectors of one width, as they were read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for width, (rows, values) in quantised(batch.column(1)).items():
                step = max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * width)))
                for start in range(0, rows.size, step):
                    own = ids[rows[start : start + step]].astype("<i8")
                    made = (number, width, int((own % query_step == 0).sum()), own.tobytes(), values[start : start + step].tobytes())
                    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                    names = ["shard", "width", "queries", "ids", "vectors"]
                    yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(made, kinds)], names=names)
                    number += 1

    rows = vectors.where("vec_id is not null")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, _SHARD)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of each row, ties to the smaller id. Missing places have the id -1."""
    if scores.shape[1] > 4 * k:
        # All that reach the k-th score stay, so that ties are decided by id.
        line = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        row, column = np.nonzero(scores >= line[:, None])
    else:
        row, column = np.nonzero(np.ones(scores.shape, bool))
    own_ids, own = (ids[row, column] if ids.ndim == 2 else ids[column]), scores[row, column]
    order = np.lexsort((own_ids, -own, row))
    row, own_ids, own = row[order], own_ids[order], own[order]
    place = np.arange(row.size) - np.searchsorted(row, row)
    keep = place < k
    out_ids = np.full((scores.shape[0], k), -1, np.int64)
    out = np.full((scores.shape[0], k), MISSING)
    out_ids[row[keep], place[keep]] = own_ids[keep]
    out[row[keep], place[keep]] = own[keep]
    return out_ids, out


def product(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products as doubles.

    Raises where a product could lie beyond the integers that a double holds exactly; with components below
    2**18 in size, that is beyond a million components.
    """
    most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1]
    if most >= EXACT:
        raise OverflowError("inner products may exceed 2**53 and would not be exact")
    return queries @ vectors.T


def top_k(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP) -> DataFrame:
    """``query_id, rank, vec_id, score`` for each query of ``vec_id, embedding``.

    Queries are the rows whose id is divisible by ``query_step``; all rows with another id are candidates. Rows that
    are null or hold a null or a number that is not finite take no part, nor do rows without an id; vectors are
    compared with those of their own length; a repeated row is a candidate and a query of its own each time; fewer
    than k candidates are all returned; an empty table gives an empty result; other columns are ignored.
    """
    packed = materialize(shards(vectors, query_step), "shards")
    found = packed.agg(F.count("*").alias("shards"), F.sum("queries").alias("queries")).first()
    parts = max(1, -(-found.shards // FAN_IN))
    blocks = max(1, -(-(found.queries or 0) // BLOCK_ROWS))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                own = np.flatnonzero(ids % query_step == 0)
                values = np.frombuffer(row["vectors"], "<f8").reshape(ids.size, row["width"])[own]
                made = (row["shard"], row["width"], (row["shard"] * SHARD_ROWS + own).tobytes(), ids[own].tobytes(), values.tobytes())
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                names = ["shard", "width", "rows", "ids", "vectors"]
                yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(made, kinds)], names=names)

    # Shards are dealt out by hash to parts and, as far as they have queries, to blocks. A tile needs one of each:
    # a block is copied to all parts, and a part to all blocks.
    dealt = lambda number, seed: F.pmod(F.xxhash64("shard", F.lit(seed)), F.lit(number).cast("long"))
    every = lambda number: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long")))
    queries = packed.where("queries > 0").mapInArrow(pick, "shard long, width int, rows binary, ids binary, vectors binary")
    queries = queries.withColumn("block", dealt(blocks, 1)).withColumn("part", every(parts)).groupBy("width", "block", "part")
    candidates = packed.withColumn("part", dealt(parts, 2)).withColumn("block", every(blocks)).groupBy("width", "block", "part")

    def tiles(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        width, block, part = (int(x) for x in key)
        rows, ids, values = _joined(left["rows"], "<i8"), _joined(left["ids"], "<i8"), _joined(left["vectors"], "<f8").reshape(-1, width)
        made = []
        for top in range(0, ids.size, TILE_ROWS):
            own = slice(top, top + TILE_ROWS)
            at, found = np.full((ids[own].size, k), -1, np.int64), np.full((ids[own].size, k), MISSING)
            for other_ids, other in zip(right["ids"], right["vectors"]):
                other_ids = np.frombuffer(other_ids, "<i8")
                scores = product(values[own], np.frombuffer(other, "<f8").reshape(-1, width))
                scores[ids[own][:, None] == other_ids[None, :]] = MISSING
                new_at, new = best(other_ids, scores, k)
                at, found = best(np.hstack([at, new_at]), np.hstack([found, new]), k)
            row, column = np.nonzero(np.isfinite(found))
            made.append(
                pd.DataFrame(
                    {"block": block, "part": part, "query": rows[own][row], "query_id": ids[own][row], "vec_id": at[row, column], "score": found[row, column].astype(np.int64)}
                )
            )
        return pd.concat(made) if made else _none()

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["query", "score", "vec_id"], ascending=[True, False, True])
        return frame[frame.groupby("query").cumcount() < k]

    lists = queries.cogroup(candidates).applyInPandas(tiles, _BEST)
    while parts > 1:
        parts = -(-parts // FAN_IN)
        lists = lists.withColumn("part", F.pmod("part", F.lit(parts))).groupBy("block", "part").applyInPandas(merge, _BEST)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return lists.select("query_id", rank.alias("rank"), "vec_id", "score")


def _joined(parts: pd.Series, kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in parts] or [np.zeros(0, kind)])


def _none() -> pd.DataFrame:
    return pd.DataFrame({part.split()[0]: pd.Series(dtype="int64") for part in _BEST.split(", ")})


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
