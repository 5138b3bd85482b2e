"""Sharding by a Feistel permutation of global row numbers.

Every row gets a number in the order of its id. A balanced Feistel network permutes the numbers, with cycle
walking down to the exact row count; the permuted place gives shard and slot. So the shuffle is the same in
every run, shards differ by one row at most, and place and row number can be computed from each other without
any table: ``shard_and_slot`` and ``row_of``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.llm.order import numbered

ROUNDS = 6
SEED = 20_240_601
LAW = "rows"
SIZE_OVERHEAD = 8

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _half_bits(n: int) -> int:
    """Bits of one half: the smallest domain of an even number of bits that holds n numbers."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round(half: np.ndarray, key: np.uint64, mask: np.uint64) -> np.ndarray:
    x = half + key
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return (x ^ (x >> np.uint64(31))) & mask


def _keys(seed: int) -> list[np.uint64]:
    return [np.uint64((seed * 0x9E3779B97F4A7C15 + r * 0xD1342543DE82EF95 + 1) % 2**64) for r in range(ROUNDS)]


def _once(x: np.ndarray, bits: int, keys: list[np.uint64]) -> np.ndarray:
    shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    left, right = x >> shift, x & mask
    for key in keys:
        left, right = right, left ^ _round(right, key, mask)
    return (right << shift) | left


def permute(rows, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """Places of row numbers below ``n`` (or row numbers of places, if ``inverse``).

    A number that leaves the range is permuted again until it is back in it (cycle walking). The domain has
    fewer than 4n numbers, so that takes fewer than four steps on average. With the halves swapped at the
    end, the network is its own inverse under the keys in reverse order.
    """
    out = np.array(rows, dtype=np.uint64)
    if out.size and int(out.max()) >= n:
        raise ValueError("row numbers have to be below the row count")
    bits, keys = _half_bits(n), _keys(seed)
    keys = keys[::-1] if inverse else keys
    todo = np.arange(out.size)
    with np.errstate(over="ignore"):
        while todo.size:
            out[todo] = _once(out[todo], bits, keys)
            todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def shard_and_slot(row: int, n: int, shards: int, seed: int = SEED) -> tuple[int, int]:
    """Where a row number goes, without looking at any data."""
    place = int(permute([row], n, seed)[0])
    return place % shards, place // shards


def row_of(shard: int, slot: int, n: int, shards: int, seed: int = SEED) -> int:
    """The row number that lies in a slot of a shard."""
    return int(permute([slot * shards + shard], n, seed, inverse=True)[0])


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32``: what is needed of a document; texts are not shuffled."""
    data = F.encode(F.col("text"), "UTF-8")
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + SIZE_OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(data), F.lit(0)).cast("long").alias("text_crc32"),
    )


def shard(docs: DataFrame, shards: int = 24, seed: int = SEED, keys: tuple[str, ...] = ("doc_id", "size", "text_crc32")) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``doc_id, text``.

    Law ``rows``: shards differ by one row at most; ``grown_shard`` is null, as it belongs to another law.
    A null text has size 8 and crc32 0, as an empty one; rows without an id are numbered first; repeated rows
    get a slot each; an empty table gives an empty result; columns beside the two are ignored.
    """
    rows = numbered(digest(docs), list(keys), "shard-rows")
    n = rows.count()

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, seed))

    return (
        rows.withColumn("_place", place("row"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit(LAW).alias("law"),
            (F.col("_place") % shards).cast("int").alias("shard"),
            F.floor(F.col("_place") / shards).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
