"""Best-fit packing of tokenised documents into sequences of a fixed length.

The pieces of all documents are range-sorted by length, the longest first, and numbered. Pieces of one length
are alike, and so are gaps of one size, so the sorted order is held run by run: as many runs at most as the
sequence has tokens. A superstep takes one run of pieces; all of them look for their successor, the
smallest gap that holds them, at once; runs that want the same gaps are served in the order of their rank; the
gaps are updated, and the next superstep follows. The result is that of best fit taken piece by piece,
longest first. Then all pieces find their sequence by rank, in parallel: each task sweeps over its own range.
Only the histogram of lengths and the runs go through the driver, and the capacity bounds both.
"""

from __future__ import annotations

import bisect
import os
import sys
import zlib
from collections.abc import Iterator
from itertools import repeat
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.llm.batches import pieces, ramps, small_batches
from timberline.llm.order import numbered
from timberline.session import materialize

CAPACITY = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Ids and words that a worker keeps, some 30 MB; beyond that it starts anew, which costs time only.
CACHED_IDS = 1 << 20
CACHED_WORDS = 150_000
# New words that are tokenised as one text.
GROUP = 256


# The start of special tokens; ASCII marks that always begin a token of their own after a letter or
# digit (all but the apostrophe); letters of Latin-1 in UTF-8, all but two signs, and the offset of their small forms.
SPECIAL = b"<|"
MARKS = b"""!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"""
LATIN, SIGNS = 0xC3, (0x97, 0xB7)
CAPITALS, SMALL = (0x80, 0x9E), 0x20

_IS_MARK = np.isin(np.arange(256), list(MARKS))
_IS_WORD = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz0123456789"))
_LATIN_LETTER = np.isin(np.arange(256), [x for x in range(0x80, 0xC0) if x not in SIGNS])
_LATIN_SMALL = np.arange(256, dtype=np.uint8)
_LATIN_SMALL[[x for x in range(CAPITALS[0], CAPITALS[1] + 1) if x not in SIGNS]] += SMALL


def set_apart(data: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Texts in lower case, with a blank before each mark that follows a letter or digit, and their new places.

    This vocabulary folds case, drops white space and ends a token there, so the ids stay the same, while
    there are fewer different words. Texts that may have special tokens, which are not folded, stay as they are.
    """
    raw = data.tobytes()
    if SPECIAL in raw:
        return raw, at
    low = np.frombuffer(raw.lower(), np.uint8).copy()
    second = np.flatnonzero(low[:-1] == LATIN) + 1
    low[second] = _LATIN_SMALL[low[second]]
    letter = _IS_WORD[low]
    letter[second] = _LATIN_LETTER[low[second]]
    apart = _IS_MARK[low]
    apart[1:] &= letter[:-1]
    apart[:1] = False
    moved = np.cumsum(apart)
    out = np.full(low.size + int(moved[-1]) if low.size else 0, 0x20, np.uint8)
    out[np.arange(low.size) + moved] = low
    # A blank before the first mark of a text falls to the text before it, which does not mind.
    return out.tobytes(), at + np.concatenate([[0], moved])[at]


class WordIds:
    """Ids of words, each of which is tokenised once.

    White space is dropped by this vocabulary and no token crosses it, so the ids of a text are those of its
    words, split at ASCII white space.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not os.path.isabs(vocabulary):
            import public_tokenizers

            vocabulary = public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, words: list[bytes]) -> None:
        """Tokenise new words, a few hundred at a time; a token belongs to the word in which it begins."""
        texts = [word.decode() for word in words]
        lengths = np.zeros(len(words), np.int64)
        ids: list[int] = []
        groups = range(0, len(texts), GROUP)
        encoded = self.tokenizer.encode_batch([" ".join(texts[i : i + GROUP]) for i in groups], add_special_tokens=False)
        for i, one in zip(groups, encoded):
            own = np.fromiter(map(len, texts[i : i + GROUP]), np.int64) + 1
            begins = np.fromiter((start for start, _ in one.offsets), np.int64)
            lengths[i : i + GROUP] = np.bincount(np.searchsorted(np.cumsum(own) - 1, begins, side="right"), minlength=own.size)
            ids += one.ids
        known = len(self.place)
        self.place.update(zip(words, range(known, known + len(words))))
        self.starts = np.concatenate([self.starts, self.ids.size + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])

    def of(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, and the places between the texts."""
        if self.ids.size > CACHED_IDS or len(self.place) > CACHED_WORDS:
            self._clear()
        raw, at = set_apart(data, at)
        words: list[bytes] = []
        counts = np.zeros(at.size - 1, np.int64)
        for i, (start, end) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            own = raw[start:end].split()
            counts[i] = len(own)
            words += own
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if new.size:
            self._learn(list({words[i] for i in new}))
            at[new] = [self.place[words[i]] for i in new]
        lengths = self.lengths[at]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(counts)
        sizes = sums[ends] - sums[ends - counts] + 1
        places = np.concatenate([[0], np.cumsum(sizes)])
        out = np.full(int(places[-1]), END_ID, np.uint32)
        own = np.ones(out.size, bool)
        own[places[1:] - 1] = False
        out[own] = self.ids[np.repeat(self.starts[at], lengths) + ramps(lengths)]
        return out, places


def word_ids(vocabulary: str) -> WordIds:
    """The worker's own ``WordIds``; a worker that is used again keeps the words it knows.

    Functions come to a worker by value, anew for each task, so what is to stay lies in a module of its own.
    """
    kept = sys.modules.setdefault("timberline_worker", ModuleType("timberline_worker"))
    known = kept.__dict__.setdefault("word_ids", {})
    if vocabulary not in known:
        known.clear()
        known[vocabulary] = WordIds(vocabulary)
    return known[vocabulary]


def tokenised(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents, as in ``PIECES``; ``with_ids`` adds their ids.

    Only a document of more than ``capacity`` ids is cut, into pieces of that length and a rest.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(vocabulary)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for first, last, data, at in pieces(texts):
                ids, places = words.of(data, at)
                sizes = np.diff(places)
                cuts = -(-sizes // capacity)
                doc = np.repeat(np.arange(last - first), cuts)
                piece = ramps(cuts)
                start = piece * capacity
                length = np.minimum(capacity, sizes[doc] - start)
                begin = places[doc] + start
                bounds = list(zip(begin.tolist(), (begin + length).tolist()))
                little = ids.astype("<u4", copy=False)
                crcs = [zlib.crc32(little[a:b]) for a, b in bounds]
                columns = [doc_ids.slice(first, last - first).take(pa.array(doc))]
                columns += [pa.array(x, kind) for x, kind in zip((piece, start, length, crcs), kinds[1:])]
                if with_ids:
                    # Pieces of a document lie one after the other, and so do documents.
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, ids.size), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[pd.DataFrame, int]:
    """Where runs of pieces go, and the number of sequences.

    ``counts`` has the number of pieces of each length. A row ``row, bin, each, offset, length`` says: from the
    row with this number on, ``each`` pieces after another go to the same sequence, from ``offset`` on; the first
    of them to sequence ``bin``, the next to the one after it.
    """
    gaps: list[int] = []  # sizes of gaps, ascending
    open_bins: dict[int, list[tuple[int, int]]] = {}  # by size of gap: first sequence, number of sequences
    plan: list[tuple[int, int, int, int, int]] = []
    bins = row = 0

    def give(size: int, first: int, number: int) -> None:
        if size and number:
            if size not in open_bins:
                bisect.insort(gaps, size)
                open_bins[size] = []
            open_bins[size].append((first, number))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                size = gaps[at]
                first, number = open_bins[size].pop()
                if not open_bins[size]:
                    del open_bins[size], gaps[at]
            else:
                size = capacity
                first, number = bins, -(-left // (capacity // length))
                bins += number
            each = size // length
            full = min(number, left // each)
            plan.append((row, first, each, capacity - size, length))
            taken = min(left, number * each)
            rest = taken - full * each
            give(size - each * length, first, full)
            if rest:
                give(size - rest * length, first + full, 1)
            give(size, first + full + bool(rest), number - full - bool(rest))
            row, left = row + taken, left - taken
    return pd.DataFrame(plan, columns=["row", "bin", "each", "offset", "length"]), bins


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for each piece of ``doc_id, text``.

    A null or empty text is the end id alone. Rows without an id are packed as well, repeated rows each for
    itself; an empty table gives an empty result; other columns are ignored. ``with_ids`` adds the ids.
    """
    small_batches(docs.sparkSession)
    found = materialize(tokenised(docs, capacity, vocabulary, with_ids), "pieces")
    found = found.withColumn("_less", capacity - F.col("length"))
    rows = numbered(found, ["_less", "doc_id", "piece"], "packed").drop("_less")
    counts = {row.length: row.n for row in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan, _ = best_fit(counts, capacity)
    runs = {name: plan[name].to_numpy(np.int64) for name in plan}

    @F.pandas_udf("sequence_id long, offset long")
    def place(numbers: pd.Series) -> pd.DataFrame:
        number = numbers.to_numpy()
        run = np.searchsorted(runs["row"], number, side="right") - 1
        turn = number - runs["row"][run]
        each = runs["each"][run]
        return pd.DataFrame({"sequence_id": runs["bin"][run] + turn // each, "offset": runs["offset"][run] + turn % each * runs["length"][run]})

    return rows.withColumn("_to", place("row")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "_to.sequence_id", "_to.offset", *(["ids"] if with_ids else [])
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
