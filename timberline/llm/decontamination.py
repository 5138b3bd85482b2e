"""Benchmark decontamination by a prefix-filtered set join.

A window of an item is contained in a document only if all of its words are, so the prefix that has to be joined
is one word, and the rarest one gives the fewest candidates. Words are ordered by their frequency in the corpus.
The join looks up each word of a document among the rarest words of the windows. A candidate is the place where
the window would have to begin; it is dropped where the window would not lie inside of the document (bounds of
position and length), then by the hash of the run, and what is left is compared word by word.

The windows come in blocks of bounded size, each of which is sent to all tasks. Texts are split and hashed once for a few
blocks, and a document meets all of them in the same task, so there is one scan and no shuffle of texts, however large the
benchmark is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.llm.batches import flat, pieces, ramps, small_batches
from timberline.llm.sketches import counted
from timberline.llm.words import LOWER, PLAIN, Words

WINDOW = 10
# Cells of the table of word frequencies. Words that share a cell only seem more frequent.
FREQUENCY_CELLS = 1 << 18
# Bytes of item text in a block that is sent to the tasks, and blocks that a worker holds at once.
BLOCK_BYTES = 4 << 20
PASS_BLOCKS = 4
_FILTER_BITS = 20

_BETWEEN = bytes(b if PLAIN[b] else 0x20 for b in LOWER.tolist())


def plain_words(text: bytes) -> tuple[bytes, ...]:
    """Words of a text, for the comparison of single candidates."""
    return tuple(text.translate(_BETWEEN).split())


def frequencies(docs: DataFrame) -> np.ndarray:
    """Occurrences of words in all documents, by hashed cell."""

    def cells(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        words = Words(PLAIN, LOWER)
        for _, _, data, at in pieces(batch.column(0)):
            starts, ends, _ = words.split(data, at)
            yield (words.hashes(data, starts, ends) & np.uint64(FREQUENCY_CELLS - 1)).astype(np.int64)

    return counted(docs.select(F.col("text").cast("string").alias("text")), cells, FREQUENCY_CELLS)


class Split:
    """Words of texts: their places, the first one of each text, their hashes and the sums that runs are hashed from."""

    def __init__(self, words: Words, data: np.ndarray, at: np.ndarray):
        self.starts, self.ends, self.first = words.split(data, at)
        self.hashes = words.hashes(data, self.starts, self.ends)
        self.sums = words.sums(self.hashes)


class Index:
    """Windows of a block of items by their rarest word."""

    def __init__(self, items: list[tuple[str, str]], frequency: np.ndarray, window: int):
        words = Words(PLAIN, LOWER)
        data, at = flat(pa.array([text for _, text in items], pa.large_string()))
        starts, ends, first = words.split(data, at)
        hashes = words.hashes(data, starts, ends)
        sums = words.sums(hashes)
        counts = np.diff(first)
        number = np.where(counts > 0, np.maximum(counts - window + 1, 1), 0)
        item = np.repeat(np.arange(counts.size), number)
        begin = first[:-1][item] + ramps(number)
        length = np.minimum(counts[item], window)
        # The rarest word of each window; of equally rare ones the one with the smallest hash.
        inside = np.repeat(begin, length) + ramps(length)
        rank = np.empty(hashes.size, np.int64)
        rank[np.lexsort((hashes, frequency[(hashes & np.uint64(FREQUENCY_CELLS - 1)).astype(np.int64)]))] = np.arange(hashes.size)
        of_window = np.repeat(np.arange(begin.size), length)
        best = np.lexsort((rank[inside], of_window))
        rarest = inside[best[np.searchsorted(of_window, np.arange(begin.size))]] if begin.size else begin
        keys = words.run(sums, begin, begin + length)
        # Items that share a window share its row.
        order = np.lexsort((item, keys, hashes[rarest]))
        self.items = [name for name, _ in items]
        self.word, self.key, self.item = hashes[rarest][order], keys[order], item[order]
        self.ahead, self.length = (rarest - begin)[order], length[order]
        raw = data.tobytes()
        self.words = [plain_words(raw[a:b]) for a, b in zip(starts[begin][order].tolist(), ends[begin + length - 1][order].tolist())]
        new = np.ones(order.size, bool)
        new[1:] = (self.word[1:] != self.word[:-1]) | (self.key[1:] != self.key[:-1]) | (self.ahead[1:] != self.ahead[:-1])
        self.window_at = np.flatnonzero(new)  # first row of each distinct window
        self.window_rows = np.diff(np.append(self.window_at, order.size))
        anchor = self.word[self.window_at]
        self.anchors, self.anchor_at = np.unique(anchor, return_index=True)
        self.anchor_windows = np.diff(np.append(self.anchor_at, anchor.size))
        self.same = dict(zip(self.window_at.tolist(), self.window_rows.tolist()))
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.anchors >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def names(self, windows: set[int]) -> set[str]:
        """Items that have any of the distinct windows, given by their first rows."""
        return {self.items[i] for w in windows for i in self.item[w : w + self.same[w]].tolist()}

    def hits(self, words: Words, data: np.ndarray, texts: Split) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, first word and word after the last of each window found, in the order of rows, and its place in the index."""
        starts, ends, first, hashes, sums = texts.starts, texts.ends, texts.first, texts.hashes, texts.sums
        may = np.flatnonzero(self.filter[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        place = np.searchsorted(self.anchors, hashes[may])
        place[place == self.anchors.size] = 0
        found = self.anchors[place] == hashes[may] if self.anchors.size else np.zeros(may.size, bool)
        may, place = may[found], place[found]
        number = self.anchor_windows[place]
        window = self.window_at[np.repeat(self.anchor_at[place], number) + ramps(number)]
        begin = np.repeat(may, number) - self.ahead[window]
        row = np.repeat(np.searchsorted(first, may, side="right") - 1, number)
        end = begin + self.length[window]
        inside = (begin >= first[row]) & (end <= first[row + 1])
        begin, end, window, row = begin[inside], end[inside], window[inside], row[inside]
        same = words.run(sums, begin, end) == self.key[window]
        begin, end, window, row = begin[same], end[same], window[same], row[same]
        left, right = starts[begin].tolist(), ends[end - 1].tolist()
        exact = [plain_words(data[a:b].tobytes()) == self.words[w] for a, b, w in zip(left, right, window.tolist())]
        keep = np.array(exact, bool)
        return row[keep], begin[keep] - first[row[keep]], end[keep] - first[row[keep]], window[keep]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


_SPAN = T.StructType().add("start", T.LongType()).add("end", T.LongType())
_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(_SPAN)),
    T.StructField("items", T.ArrayType(T.StringType())),
]
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def matched(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` as column ``row``, with ``n_words``, ``spans`` of words that a window hits, and ``items`` found.

    ``docs`` needs ``text``, ``benchmark`` needs ``item_id, text``. A null or empty text has no words; a null or
    empty item has no window, and an item without an id takes no part; equal items are all named; repeated
    documents are each judged; other columns are kept inside ``row``. No text is cut.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    frequency = frequencies(docs)
    columns = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    schema = T.StructType([columns.schema["row"], *_FOUND])
    for start in range(0, blocks, PASS_BLOCKS):
        sent = []
        for block in range(start, min(start + PASS_BLOCKS, blocks)):
            # A block has about BLOCK_BYTES, as items are dealt out by hash.
            own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().collect()
            sent.append(spark.sparkContext.broadcast(Index([(row.item_id, row.text) for row in own], frequency, window)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            words = Words(PLAIN, LOWER)
            for batch in batches:
                counts = np.zeros(batch.num_rows, np.int64)
                spans, names = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                spans = [[(x["start"], x["end"]) for x in own] for own in spans]
                for top, _, data, at in pieces(pc.struct_field(batch.column(0), "text")):
                    texts = Split(words, data, at)
                    counts[top : top + texts.first.size - 1] = np.diff(texts.first)
                    for index in sent:
                        row, begin, end, at_index = index.value.hits(words, data, texts)
                        # Hits are in the order of the rows.
                        hit, where = np.unique(row, return_index=True)
                        for r, a, b in zip(hit.tolist(), where.tolist(), [*where[1:].tolist(), row.size]):
                            own = slice(a, b)
                            spans[top + r] = merged(spans[top + r] + list(zip(begin[own].tolist(), end[own].tolist())))
                            names[top + r] = sorted({*names[top + r], *index.value.names(set(at_index[own].tolist()))})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(counts),
                        pa.array([[{"start": a, "end": b} for a, b in own] for own in spans], _SPANS),
                        pa.array(names, pa.list_(pa.string())),
                    ],
                    names=["row", "n_words", "spans", "items"],
                )

        columns = columns.mapInArrow(run, schema)
    return columns


def judged(found: DataFrame) -> DataFrame:
    """The columns of ``matched`` as figures, without the documents' own columns but their id."""
    length = lambda total, span: total + span.end - span.start
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), length).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window occurs, with their columns; nulls, empty texts and empty tables as in ``matched``."""
    return matched(docs, benchmark, window).where(F.size("spans") == 0).select("row.*")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of each row of ``documents``; see ``matched`` for nulls, repeated rows and empty tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judged(matched(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
