"""Toxicity by maximum-scoring segments.

Words are weighed by their log-odds between toxic and other documents, with a Dirichlet prior that has the
frequencies of all labelled documents. Each word costs ``DRIFT``, and a word that is significant for toxic documents
earns its log-odds; the linear-time scan of Ruzzo and Tompa finds all maximal segments of a document. The score of a
segment is set against what the best segment of so long a text reaches by chance (an extreme-value distribution, whose
scale solves the equation of Karlin and Altschul over the words of other documents). What the significant segments have
beyond that is added up, and a logistic curve makes a probability of it.

Only rows of ``labels`` outside of the held-out fifth are learned from, and only texts enter a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.llm.batches import pieces, small_batches
from timberline.llm.words import LOWER, PLAIN, Words
from timberline.session import materialize

FOLDS = 5
# Labelled rows to learn from, about, at most; taken by the hash of the id.
LABELLED_ROWS = 50_000
# Weight of the prior, as a share of the words counted; z-score from which a word counts.
PRIOR_SHARE = 0.05
LEAST_Z = 2.5
DRIFT = 1.0
# Karlin and Altschul's K, a factor on the number of places in which a segment may begin.
PLACES = 0.1
# Expected number by chance up to which a segment is significant.
SIGNIFICANT = 0.05
RIDGE = 1e-2


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids that nothing is learned from; no id is not held out, as it has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass
class Model:
    """Sorted hashes of words with what they earn, the scale of chance scores, and the logistic curve."""

    words: np.ndarray
    scores: np.ndarray
    scale: float
    intercept: float = 0.0
    slope: float = 0.0

    def surplus(self, score: float, words: int) -> float:
        """Minus the logarithm of how often so good a segment is expected by chance in a text of so many words."""
        return self.scale * score - math.log(PLACES * max(words, 1))

    def probability(self, total):
        return 1.0 / (1.0 + np.exp(-(self.intercept + self.slope * np.log1p(total))))


def segments(places: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``first, after last, score`` of a text.

    ``places`` are the words that earn something, ascending, and ``scores`` what they earn, beyond their own cost;
    all other words cost ``drift``. Candidates lie on a stack with the sums before and after them. Each is looked at
    a fixed number of times, as the candidates that it passes over are linked away.
    """
    stack: list[tuple[int, int, float, float, int]] = []  # first, after, sum before, sum after, last one with a smaller sum before
    total, word = 0.0, 0
    for place, score in zip(places, scores):
        total -= drift * (place - word)
        first, before = place, total
        total += score
        word = place + 1
        at = len(stack) - 1
        while True:
            while at >= 0 and stack[at][2] >= before:
                at = stack[at][4]
            if at < 0 or stack[at][3] >= total:
                break
            first, before = stack[at][0], stack[at][2]
            del stack[at:]
            at -= 1
        stack.append((first, word, before, total, at))
    return [(first, after, high - low) for first, after, low, high, _ in stack]


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of the labelled documents to learn from. The label table is cut to its documented size, so it is sent to all tasks."""
    own = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, LABELLED_ROWS / max(1, labels.count()))
    own = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(own), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def word_counts(rows: DataFrame) -> DataFrame:
    """``word, toxic, other``: occurrences of each word, by hash, in toxic and in other documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(PLAIN, LOWER)
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False) > 0
            for top, _, data, at in pieces(batch.column(0)):
                starts, ends, first = words.split(data, at)
                hashes = words.hashes(data, starts, ends)
                of_toxic = np.repeat(toxic[top : top + first.size - 1], np.diff(first))
                found, where = np.unique(hashes, return_inverse=True)
                every, bad = np.bincount(where, minlength=found.size), np.bincount(where[of_toxic], minlength=found.size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(bad.astype(np.int64)), pa.array((every - bad).astype(np.int64))],
                    names=["word", "toxic", "other"],
                )

    counts = rows.mapInArrow(run, "word long, toxic long, other long")
    return counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def weighed(counts: DataFrame, toxic: int, other: int) -> DataFrame:
    """``word, toxic, other, odds, z``: log-odds with an informative Dirichlet prior, and how sure they are."""
    prior = PRIOR_SHARE * (F.col("toxic") + F.col("other"))
    weight = PRIOR_SHARE * (toxic + other)
    side = lambda name, total: F.log((F.col(name) + prior) / (total + weight - F.col(name) - prior))
    odds = side("toxic", toxic) - side("other", other)
    spread = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("other") + prior))
    return counts.select("word", "toxic", "other", odds.alias("odds"), (odds / spread).alias("z"))


def chance_scale(scores: np.ndarray, shares: np.ndarray, drift: float = DRIFT) -> float:
    """The positive solution of sum(share * exp(scale * score)) = 1, where words outside of the table score minus drift."""
    rest = 1.0 - float(shares.sum())
    excess = lambda x: float((shares * np.exp(np.minimum(x * scores, 700.0))).sum()) + rest * math.exp(-x * drift) - 1.0
    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def passages(model: Model, words: Words, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, list[tuple[int, int, float, float]]]]:
    """Row, its number of words and its significant segments ``first, after, score, surplus``, for each row."""
    starts, ends, first = words.split(data, at)
    hashes = words.hashes(data, starts, ends)
    place = np.searchsorted(model.words, hashes)
    place[place == model.words.size] = 0
    hit = np.flatnonzero(model.words[place] == hashes) if model.words.size else np.zeros(0, np.int64)
    earned = model.scores[place[hit]] if hit.size else np.zeros(0)
    bounds = np.searchsorted(hit, first)
    for row in range(first.size - 1):
        size, a, b = int(first[row + 1] - first[row]), bounds[row], bounds[row + 1]
        found = []
        if b > a:
            for start, after, score in segments((hit[a:b] - first[row]).tolist(), earned[a:b].tolist()):
                surplus = model.surplus(score, size)
                if surplus >= -math.log(SIGNIFICANT):
                    found.append((start, after, score, surplus))
        yield row, size, found


def learned(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of the labelled documents; none where one of the classes has no document or no words."""
    rows = labelled(docs, labels)
    counts = materialize(word_counts(rows), "word-counts")
    totals = counts.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).first()
    if not totals.toxic or not totals.other:
        return None
    # All words that count: the labelled documents are bounded, and so are their words.
    table = weighed(counts, totals.toxic, totals.other).where(F.col("z") >= LEAST_Z).toPandas()
    table = table.assign(word=table["word"].to_numpy(np.int64).view(np.uint64)).sort_values("word")
    scores = table["odds"].to_numpy(float) - DRIFT
    good = scores > 0
    shares = (table["other"].to_numpy(float) + 0.5) / (totals.other + 0.5 * max(len(table), 1))
    model = Model(table["word"].to_numpy(np.uint64)[good], scores[good], chance_scale(scores[good], shares[good]))

    def totals_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(PLAIN, LOWER)
        for batch in batches:
            total = [sum(x[3] for x in found) for _, _, data, at in pieces(batch.column(0)) for _, _, found in passages(model, words, data, at)]
            yield pa.RecordBatch.from_arrays([pa.array(total, pa.float64()), batch.column(1)], names=["total", "toxic"])

    # One row for each labelled document: bounded by LABELLED_ROWS.
    seen = rows.mapInArrow(totals_of, "total double, toxic int").groupBy(F.round("total", 1).alias("total"), "toxic").agg(F.count("*").alias("n")).toPandas()
    model.intercept, model.slope = _logistic(np.log1p(seen["total"].to_numpy(float)), seen["toxic"].to_numpy(float) > 0, seen["n"].to_numpy(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton's method with a small ridge; the slope is not negative."""
    design, at = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ at, -30, 30)))
        gradient = design.T @ (n * (p - y)) + RIDGE * at
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + RIDGE * np.eye(2), gradient)
        at -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(max(at[1], 0.0))


_PASSAGE = T.StructType().add("start", T.LongType()).add("end", T.LongType()).add("score", T.DoubleType()).add("surplus", T.DoubleType())


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``row`` with all columns of ``docs``, ``score`` from 0 to 1, and ``passages``: words of each significant segment.

    ``docs`` needs ``doc_id, text``, ``labels`` needs ``doc_id, toxic``. A null or empty text has no passage and so the
    lowest score; repeated rows are each scored; a document with several labels is toxic if one of them says so; where
    nothing can be learned all scores are 0; an empty table gives an empty result. Texts are scanned whole.
    """
    small_batches(docs.sparkSession)
    model = learned(docs, labels)
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("passages", T.ArrayType(_PASSAGE))])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("surplus", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(PLAIN, LOWER)
        for batch in batches:
            found = [[]] * batch.num_rows
            if model is not None:
                for top, _, data, at in pieces(pc.struct_field(batch.column(0), "text")):
                    for row, _, own in passages(model, words, data, at):
                        if own:
                            found[top + row] = [dict(zip(("start", "end", "score", "surplus"), x)) for x in own]
            totals = np.array([sum(x["surplus"] for x in own) for own in found])
            score = np.zeros(batch.num_rows) if model is None else model.probability(totals)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array(found, kind)], names=["row", "score", "passages"])

    return rows.mapInArrow(run, schema)


def predicted() -> Column:
    return F.when(F.col("score") >= 0.5, 1).otherwise(0)


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic, with their columns; nulls, empty texts and empty tables as in ``scored``."""
    return scored(docs, labels).where(predicted() == 0).select("row.*")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of each row of ``documents``; see ``scored`` for nulls, repeated rows and empty tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", predicted().alias("predicted"))
