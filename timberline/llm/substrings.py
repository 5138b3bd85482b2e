"""Substring dedup: words in windows that an earlier document has as well are removed.

First pass: every task counts the hashes of its windows in a count-min sketch of two rows; the sketches are sent
as ranges of cells and added up. What is kept of the sum is one bit per cell, set if the cell was met twice.
As cells can only be shared, a window that occurs twice has both bits set: none is lost. Second pass: only
windows with both bits set are grouped, by 96 bits of hash, for the smallest document that has them; partial results
are built in each task, so a window of very many documents is one row per task. A document gets back the windows
that it may keep, and removes its other windows that have both bits.

The hash space is worked on in a few slices, one after the other, so that sketch and shuffle files are those of a
slice at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.llm.batches import pieces, small_batches
from timberline.llm.words import SPACED, Powers, Words, mixed
from timberline.session import materialize

WINDOW = 13
SLICES = 2
# Bits of a sketch's row: about one cell for each ROW_BYTES bytes of text, up to MOST_BITS. With more text than
# that, more windows are grouped in vain, but none is lost.
ROW_BYTES = 2
LEAST_BITS, MOST_BITS = 20, 28
ROWS = 2
# Cells of a range, in which a cell is two bytes; windows that a task holds before it sends its cells.
RANGE_BITS = 16
HELD = 1 << 21

_CELLS = "range int, once binary, twice binary"
_BITS = "range int, bits binary"


def sketch_bits(text_bytes: int, slices: int = SLICES) -> int:
    wanted = max(1, text_bytes // ROW_BYTES // slices)
    return min(max(int(wanted - 1).bit_length(), LEAST_BITS), MOST_BITS)


def row_cells(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Cells of windows in each row of the sketch; the rows lie one after the other."""
    mask = np.uint64((1 << bits) - 1)
    return [(hashes & mask) + np.uint64(0), (mixed(hashes, 7) & mask) + np.uint64(1 << bits)]


class Windows:
    """Windows of the texts in a batch, in one slice of the hash space."""

    def __init__(self, window: int, slices: int, part: int):
        self.words, self.window = Words(SPACED), window
        self.slices, self.part = np.uint64(slices), np.uint64(part)

    def of(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First word and hash of each window, hashes of words, first words of rows."""
        starts, ends, first = self.words.split(data, at)
        hashes = self.words.hashes(data, starts, ends)
        begin, keys = self.words.windows(hashes, first, self.window)
        if self.slices > 1:
            own = np.flatnonzero((keys >> np.uint64(48)) % self.slices == self.part)
            begin, keys = begin[own], keys[own]
        return begin, keys, hashes, first


def repeated_cells(docs: DataFrame, bits: int, window: int, slices: int, part: int) -> np.ndarray:
    """One bit for each cell of both rows: whether it was met more than once."""
    ranges = (ROWS << bits) >> RANGE_BITS
    kind = np.uint32 if bits < 31 else np.uint64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Windows(window, slices, part)
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for _, _, data, at in pieces(batch.column(0)):
                _, keys, _, _ = found.of(data, at)
                held += [cells.astype(kind) for cells in row_cells(keys, bits)]
                size += keys.size
                if size >= HELD:
                    yield sent(held)
                    held, size = [], 0
        if size:
            yield sent(held)

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        cells = np.concatenate(held)
        cells.sort()
        new = np.append(True, cells[1:] != cells[:-1])
        twice = np.unique(cells[~new])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(ranges), pa.int32()), _by_range(cells[new], ranges), _by_range(twice, ranges)],
            names=["range", "once", "twice"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Messages come in the order of their ranges: one table at a time.
        table, now = np.zeros(1 << RANGE_BITS, np.uint8), None

        def done() -> pa.RecordBatch:
            packed = np.packbits(table >> 1, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed], pa.binary())], names=["range", "bits"])

        for batch in batches:
            for number, once, twice in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if number != now:
                    if now is not None:
                        yield done()
                    table[:] = 0
                    now = number
                # Bit 0: met, bit 1: met twice. Cells of one message are all different.
                cells = np.frombuffer(once.as_buffer(), "<u2")
                table[cells] = 1 | (table[cells] & 1) << 1 | table[cells]
                table[np.frombuffer(twice.as_buffer(), "<u2")] = 3
        if now is not None:
            yield done()

    out = np.zeros((ranges, (1 << RANGE_BITS) // 8), np.uint8)
    merged = docs.select("text").mapInArrow(count, _CELLS).repartition("range").sortWithinPartitions("range").mapInArrow(add, _BITS)
    for row in materialize(merged, "sketch").toLocalIterator():
        out[row.range] = np.frombuffer(row.bits, np.uint8)
    return out.reshape(-1)


def _by_range(cells: np.ndarray, ranges: int) -> pa.Array:
    """Sorted cells as one binary of two-byte places for each range."""
    bounds = np.searchsorted(cells, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(RANGE_BITS))
    low = (cells & ((1 << RANGE_BITS) - 1)).astype("<u2")
    return pa.Array.from_buffers(pa.binary(), ranges, [None, pa.py_buffer((bounds * 2).astype(np.int32)), pa.py_buffer(low)])


def is_set(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bits[(cells >> np.uint64(3)).astype(np.int64)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1 == 1


def flagged(keys: np.ndarray, sketch: np.ndarray, bits: int) -> np.ndarray:
    """Places of the windows that both rows of the sketch have seen twice."""
    first, second = row_cells(keys, bits)
    some = np.flatnonzero(is_set(sketch, first))
    return some[is_set(sketch, second[some])]


def kept_windows(docs: DataFrame, sketch, bits: int, window: int, slices: int, part: int) -> DataFrame:
    """``doc_id, key``: for each window that the sketch takes for repeated, the smallest document that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, other = Windows(window, slices, part), Powers(0x9FB21C651E98DF25)
        for batch in batches:
            ids = batch.column(0)
            for top, _, data, at in pieces(batch.column(1)):
                begin, keys, hashes, first = found.of(data, at)
                some = flagged(keys, sketch.value, bits)
                begin, keys = begin[some], keys[some]
                up, down = other.to(hashes.size)
                sums = np.zeros(hashes.size + 1, np.uint64)
                np.cumsum(hashes * up[: hashes.size], out=sums[1:])
                second = mixed((sums[begin + window] - sums[begin]) * down[begin]) >> np.uint64(32)
                row = np.searchsorted(first, begin, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(second.astype(np.uint32).view(np.int32)), ids.take(pa.array(top + row))],
                    names=["key", "more", "doc_id"],
                )

    rows = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "key long, more int, doc_id long")
    return rows.groupBy("key", "more").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "key")


def deduplicated(docs: DataFrame, window: int = WINDOW, slices: int = SLICES, columns: list | None = None) -> DataFrame:
    """``row`` with all columns of ``docs``, ``kept`` text, ``n_words`` and ``n_removed``; or what ``columns`` makes of them.

    ``docs`` needs ``doc_id, text``. Windows are judged on the input. The kept words are joined by one blank. A null
    text has no words and an empty kept text; a text of fewer words than a window is kept; a document without an
    id is left as it is and takes nothing from others; rows with the same id count as the same document; an empty
    table gives an empty result. No text is cut.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    bits = sketch_bits(size, slices)
    sketches, kept = [], []
    for part in range(slices):
        sketch = spark.sparkContext.broadcast(repeated_cells(texts, bits, window, slices, part))
        kept.append(materialize(kept_windows(texts, sketch, bits, window, slices, part), "kept-windows"))
        sketches.append(sketch)
    keep = reduce(DataFrame.unionAll, kept).groupBy("doc_id").agg(F.collect_list("key").alias("_keep"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("_id"))
    joined = rows.join(keep.withColumnRenamed("doc_id", "_id"), "_id", "left").select("row", "_id", "_keep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Windows(window, 1, 0)
        for batch in batches:
            texts, keys_of = pc.struct_field(batch.column(0), "text"), batch.column(2)
            named = pc.is_valid(batch.column(1)).to_numpy(zero_copy_only=False)
            text_out, counts, removed = [], np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for top, last, data, at in pieces(texts):
                begin, keys, hashes, first = found.of(data, at)
                some = []
                for part, sketch in enumerate(sketches):
                    own = np.flatnonzero((keys >> np.uint64(48)) % np.uint64(slices) == part) if slices > 1 else np.arange(keys.size)
                    some.append(own[flagged(keys[own], sketch.value, bits)])
                some = np.sort(np.concatenate(some))
                begin, keys = begin[some], keys[some]
                bounds = np.searchsorted(begin, first)
                counts[top:last] = np.diff(first)
                raw = data.tobytes()
                for i in range(last - top):
                    words = raw[at[i] : at[i + 1]].split()
                    a, b = bounds[i], bounds[i + 1]
                    if b > a and named[top + i]:
                        may = keys_of[top + i]
                        may = may.values.to_numpy(zero_copy_only=False).view(np.uint64) if may.is_valid else np.zeros(0, np.uint64)
                        hit = begin[a:b][~np.isin(keys[a:b], may)] - first[i]
                        if hit.size:
                            change = np.zeros(len(words) + 1, np.int64)
                            np.add.at(change, hit, 1)
                            np.add.at(change, hit + window, -1)
                            stay = np.cumsum(change[:-1]) == 0
                            removed[top + i] = stay.size - int(stay.sum())
                            words = [words[j] for j in np.flatnonzero(stay).tolist()]
                    text_out.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(text_out, pa.binary()).cast(pa.string()), pa.array(counts), pa.array(removed)],
                names=["row", "kept", "n_words", "n_removed"],
            )

    schema = T.StructType(
        [
            rows.schema["row"],
            T.StructField("kept", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
        ]
    )
    result = joined.mapInArrow(run, schema)
    result = materialize(result if columns is None else result.select(*columns), "deduplicated")
    for sketch in sketches:
        sketch.destroy()
    return result


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each row of ``documents``; see ``deduplicated`` for nulls, repeated rows and empty tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicated(docs, columns=["row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")])
