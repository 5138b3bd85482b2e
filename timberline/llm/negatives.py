"""Hard negatives by threshold joins with an inverted index that norms keep small.

A request asks for the best candidates of an anchor with a score between two bounds, of the anchor's label or of any
other. Requests are answered by joins that know a least score, and in rounds: a round looks for scores down to a
threshold, and only requests that it does not fill come again with a lower one, for what is still lacking. The last
threshold is the request's own bound, so nothing is left out.

Inside of a task dimensions are put in the order of their size. The index lists a candidate under a dimension only as
long as the norm of its remaining components, times the largest anchor, reaches the least score asked for; dimensions
behind that are not indexed. Scores are accumulated dimension by dimension; a pair goes as soon as its
partial score and the product of the remaining norms stay below the anchor's threshold, and what the index
lacks is added for the pairs that are left.

Anchors and candidates are packed into shards and dealt out by hash, so a label with a third of all rows is spread
like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timberline.llm.vectors import finite, floors, record
from timberline.session import Workspace, materialize

SCALE = 256
ANCHOR_STEP, NOISE_STEP, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
# Hundredths of the positive's score between which a negative's has to lie.
LEAST, MOST = 30, 90
# Thresholds of rounds: of an anchor's norm times the root mean square of all norms, and in hundredths of the positive.
ALIKE = (0.8, 0.5, 0.2)
WINDOWS = (75, 55)

# Bytes and rows at most of a shard; anchors of a block, about; anchors that meet a shard at once; shards of a task, about.
SHARD_BYTES, SHARD_ROWS = 2 << 20, 4096
BLOCK_ROWS, TILE_ROWS = 8192, 128
PART_SHARDS = 16
# Dimensions between two looks at the bounds.
STEP = 8
# Integers up to this are exact in a double; bounds of norms are rounded up by SLACK.
EXACT = 1 << 53
SLACK = 1 + 1e-9
# No bound of a score: all scores are smaller in size. The score of a place that nobody takes.
ANY = 1 << 62
MISSING = -np.inf

_SHARD = "shard long, width int, anchors int, squares double, ids binary, labels binary, vectors binary"
_ANCHOR = "row long, anchor_id long, width int, norm double, label long, vector binary"
_FOUND = "row long, request int, other long, score long"


def prepared(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, embedding``: rows that can take part, with the label shifted where the id is divisible by NOISE_STEP."""
    ids, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    return embeddings.where("vec_id is not null and label is not null and embedding is not null").select(
        ids.alias("vec_id"),
        F.when(ids % NOISE_STEP == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


def packed(rows: DataFrame, anchor_step: int) -> DataFrame:
    """Shards of vectors of one width, in the order they were read. Components are floor(SCALE * x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for width, (own, values) in finite(batch.column(2)).items():
                whole = floors(values, SCALE, EXACT)
                if whole.size and np.abs(whole).max() ** 2 * width >= EXACT:
                    raise OverflowError("inner products may exceed 2**53 and would not be exact")
                step = max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * width)))
                for start in range(0, own.size, step):
                    at, part = own[start : start + step], whole[start : start + step]
                    anchors = int((ids[at] % anchor_step == 0).sum())
                    squares = float((part * part).sum())
                    yield record(_SHARD, number, width, anchors, squares, *(x.astype("<i8").tobytes() for x in (ids[at], labels[at])), part.astype("<f8").tobytes())
                    number += 1

    return rows.mapInArrow(run, _SHARD)


def anchors_of(shards: DataFrame, anchor_step: int) -> DataFrame:
    """A row for each anchor; ``row`` is the place of its vector in the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line in batch.to_pylist():
                ids, labels = (np.frombuffer(line[name], "<i8") for name in ("ids", "labels"))
                own = np.flatnonzero(ids % anchor_step == 0)
                values = np.frombuffer(line["vectors"], "<f8").reshape(ids.size, line["width"])[own]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(line["shard"] * SHARD_ROWS + own, pa.int64()),
                        pa.array(ids[own]),
                        pa.array(np.full(own.size, line["width"], np.int32)),
                        pa.array(np.sqrt((values * values).sum(1))),
                        pa.array(labels[own]),
                        pa.array([v.tobytes() for v in values], pa.binary()),
                    ],
                    names=[part.split()[0] for part in _ANCHOR.split(", ")],
                )

    return shards.where("anchors > 0").mapInArrow(run, _ANCHOR)


def remaining(vectors: np.ndarray) -> np.ndarray:
    """Norms of what follows each number of leading components, rounded up: one column more than the vectors."""
    squares = np.cumsum((vectors * vectors)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([squares, np.zeros((len(vectors), 1))])) * SLACK


class Index:
    """Candidates of a shard by dimension, as far as a least score and a largest norm of anchors need them."""

    def __init__(self, vectors: np.ndarray, least: float, largest: float):
        self.order = np.argsort(-(vectors * vectors).sum(0), kind="stable")
        self.vectors = vectors[:, self.order]
        self.norms = remaining(self.vectors)
        # A candidate is listed under its leading dimensions only, until the rest cannot reach the least score alone.
        width = vectors.shape[1]
        needed = self.norms[:, :-1] * largest * SLACK >= least
        self.listed = np.where(needed.any(1), width - np.argmax(needed[:, ::-1], axis=1), 0) if least > 0 else np.full(len(vectors), width)

    def scores(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``anchor, candidate, score`` of all pairs that reach the anchor's threshold, and some that do not."""
        anchors = anchors[:, self.order]
        norms, width = remaining(anchors), anchors.shape[1]
        rows = np.arange(len(anchors))
        columns = np.flatnonzero(self.listed > 0)
        partial = np.zeros((rows.size, columns.size))
        done = 0
        for start in range(0, width, STEP):
            stop = min(start + STEP, width)
            # Lists of these dimensions; the norms take the place of components that are not listed.
            listed = np.flatnonzero(self.listed[columns] > start)
            if listed.size == 0:
                break
            partial[:, listed] += anchors[rows, start:stop] @ self.vectors[columns[listed], start:stop].T
            # A candidate without entries here keeps the bound of the place where its list ended.
            ends = np.minimum(-(-self.listed[columns] // STEP) * STEP, stop)
            bound = partial + norms[rows[:, None], np.minimum(ends, width)[None, :]] * self.norms[columns, np.minimum(ends, width)] * SLACK
            alive = bound + 0.5 >= thresholds[rows, None]
            keep_rows, keep = alive.any(1), alive.any(0)
            rows, columns, partial, alive = rows[keep_rows], columns[keep], partial[np.ix_(keep_rows, keep)], alive[np.ix_(keep_rows, keep)]
            done = stop
            if not rows.size or not columns.size:
                return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
            if alive.mean() < 1 / STEP:
                break
        if not rows.size or not columns.size:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        left, right = np.nonzero(alive)
        found = partial[left, right]
        left, right = rows[left], columns[right]
        # What lists lack, for the pairs that are left: from where a candidate's own list ended.
        begin = np.minimum(-(-self.listed[right] // STEP) * STEP, done)
        for start in range(0, width, STEP):
            stop = min(start + STEP, width)
            open_pairs = np.flatnonzero(begin <= start)
            if open_pairs.size:
                found[open_pairs] += np.einsum("ij,ij->i", anchors[left[open_pairs], start:stop], self.vectors[right[open_pairs], start:stop])
                bound = found + norms[left, np.maximum(stop, begin)] * self.norms[right, np.maximum(stop, begin)] * SLACK
                stay = bound + 0.5 >= thresholds[left]
                left, right, found, begin = left[stay], right[stay], found[stay], begin[stay]
        return left, right, found


def lists(ids: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``most`` of each row of ``scores``, ties to the smaller id; places that are left have MISSING."""
    wanted = scores > MISSING
    if scores.shape[1] > most:
        # All that reach the last place stay, so that ties are decided by id.
        wanted &= scores >= np.partition(scores, scores.shape[1] - most, axis=1)[:, scores.shape[1] - most, None]
    row, column = np.nonzero(wanted)
    own_ids, own = (ids[row, column] if ids.ndim == 2 else ids[column]), scores[row, column]
    order = np.lexsort((own_ids, -own, row))
    row, own_ids, own = row[order], own_ids[order], own[order]
    place = np.arange(row.size) - np.searchsorted(row, row)
    first = place < most
    out_ids, out = np.full((len(scores), most), -1, np.int64), np.full((len(scores), most), MISSING)
    out_ids[row[first], place[first]], out[row[first], place[first]] = own_ids[first], own[first]
    return out_ids, out


def answer(shards: DataFrame, asked: DataFrame, most: int, same_label: bool) -> DataFrame:
    """``row, request, other, score``: for each request its best ``need`` candidates from ``low`` to ``high``, or more.

    ``asked`` has the columns of an anchor and ``requests``, a list of ``request, low, high, need``. Candidates are of
    the anchor's own label or of other ones; the anchor's own row is none. Ties go to the smaller id.
    """
    number, queries = shards.count(), asked.count()
    blocks = max(1, -(-queries // BLOCK_ROWS))
    parts = max(1, -(-number // PART_SHARDS), min(number, shards.sparkSession.sparkContext.defaultParallelism))

    def tiles(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        width = int(key[0])
        if not len(left) or not len(right):
            return pd.DataFrame({part.split()[0]: pd.Series(dtype="int64") for part in _FOUND.split(", ")})
        vectors = np.stack([np.frombuffer(x, "<f8") for x in left["vector"]])
        labels, rows, largest = left["label"].to_numpy(), left["row"].to_numpy(), float(left["norm"].max())
        slots = max(len(x) for x in left["requests"])
        low, high, need, name = (np.full((len(left), slots), x, np.int64) for x in (ANY, -ANY, 1, -1))
        for i, requests in enumerate(left["requests"]):
            for j, request in enumerate(requests):
                low[i, j], high[i, j], need[i, j], name[i, j] = (request[x] for x in ("low", "high", "need", "request"))
        at, scores = np.full((len(left), slots, most), -1, np.int64), np.full((len(left), slots, most), MISSING)
        for shard, ids, other_labels, values in zip(right["shard"], right["ids"], right["labels"], right["vectors"]):
            ids, other_labels = np.frombuffer(ids, "<i8"), np.frombuffer(other_labels, "<i8")
            # A request that is full asks for nothing below its last score.
            last = np.take_along_axis(scores, need[:, :, None] - 1, axis=2)[:, :, 0]
            thresholds = np.maximum(low, last).min(1)
            index = Index(np.frombuffer(values, "<f8").reshape(ids.size, width), float(thresholds.min()), largest)
            for top in range(0, len(left), TILE_ROWS):
                tile = slice(top, top + TILE_ROWS)
                anchor, other, found = index.scores(vectors[tile], thresholds[tile])
                fits = (labels[tile][anchor] == other_labels[other]) == same_label
                fits &= rows[tile][anchor] != shard * SHARD_ROWS + other
                anchor, other, found = anchor[fits], other[fits], found[fits]
                if not anchor.size:
                    continue
                columns, place = np.unique(other, return_inverse=True)
                table = np.full((len(rows[tile]), columns.size), MISSING)
                table[anchor, place] = found
                for j in range(slots):
                    inside = (table >= low[tile, j, None]) & (table <= high[tile, j, None])
                    new_at, new = lists(ids[columns], np.where(inside, table, MISSING), most)
                    at[tile, j], scores[tile, j] = lists(np.hstack([at[tile, j], new_at]), np.hstack([scores[tile, j], new]), most)
        i, j, place = np.nonzero(scores > MISSING)
        return pd.DataFrame({"row": rows[i], "request": name[i, j], "other": at[i, j, place], "score": scores[i, j, place].astype(np.int64)})

    dealt = lambda column, count, seed: F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(count).cast("long"))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    keys = ["width", "block", "part"]
    asked = asked.withColumn("block", dealt("row", blocks, 1)).withColumn("part", every(parts)).groupBy(*keys)
    candidates = shards.select("shard", "width", "ids", "labels", "vectors")
    candidates = candidates.withColumn("part", dealt("shard", parts, 2)).withColumn("block", every(blocks)).groupBy(*keys)
    return best(asked.cogroup(candidates).applyInPandas(tiles, _FOUND), "request").where(F.col("rank") <= most)


def best(found: DataFrame, *request: str) -> DataFrame:
    """``rank``, from 1, of each answer to a request: higher scores first, ties to the smaller id."""
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("row", *request).orderBy(F.desc("score"), "other")))


def rounds(kept: Workspace, shards: DataFrame, anchors: DataFrame, requests: DataFrame, most: int, levels: int, same_label: bool) -> DataFrame:
    """Answers to ``row, request, low, high, levels``: ``row, request, other, score``, the best ``most`` from low to high.

    A round looks from below the last threshold (``high`` in the first one) down to the next one of ``levels``. Requests that have
    fewer than ``most`` answers then go on, for what they lack; the last round goes down to ``low``.
    """
    found = []
    todo = requests.select("*", F.lit(most).alias("need"))
    for level in range(levels + 1):
        bottom = F.col("low") if level == levels else F.greatest("low", F.get("levels", F.lit(level)))
        todo = kept(todo.withColumn("bottom", bottom), f"requests-{level}")
        own = F.struct("request", F.col("bottom").alias("low"), "high", "need")
        asked = todo.where("bottom <= high").groupBy("row").agg(F.collect_list(own).alias("requests"))
        new = kept(answer(shards, kept(asked.join(anchors, "row"), f"asked-{level}"), most, same_label), f"answers-{level}")
        found.append(new.join(todo.select("row", "request", "need"), ["row", "request"]).where("rank <= need").select("row", "request", "other", "score"))
        if level == levels:
            break
        have = new.groupBy("row", "request").agg(F.count("*").cast("int").alias("have"))
        todo = todo.join(have, ["row", "request"], "left").select(
            "row", "request", "low", F.least("high", F.col("bottom") - 1).alias("high"), "levels", (F.col("need") - F.coalesce("have", F.lit(0))).alias("need")
        )
        todo = kept(todo.where("need > 0 and low <= high"), f"open-{level}")
        if todo.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def hard_negatives(embeddings: DataFrame, anchor_step: int = ANCHOR_STEP, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vec_id, embedding, label``.

    Anchors are the rows whose id is divisible by ``anchor_step``. Rows without id or label take no part, nor do those whose
    vector is null, empty, or holds a null or a number that is not finite. Vectors are compared with those of their own
    length. Repeated rows count as often as they occur: each is an anchor, a positive and a negative of its own. An anchor
    without positives, a positive without a row in its window, and an empty table give no rows. Other columns are ignored.
    Numbers beyond 2**53 raise.
    """
    with Workspace(embeddings.sparkSession, "negatives") as kept:
        shards = kept(packed(prepared(embeddings), anchor_step), "shards")
        total = shards.agg(F.sum("squares").alias("squares"), F.sum(F.octet_length("ids") / 8).alias("rows")).first()
        typical = (total.squares / total.rows) ** 0.5 if total.rows else 0.0
        anchors = kept(anchors_of(shards, anchor_step), "anchors")
        least = [F.floor(F.col("norm") * (part * typical)).cast("long") for part in ALIKE]
        alike = anchors.select("row", F.lit(0).alias("request"), F.lit(-ANY).alias("low"), F.lit(ANY).alias("high"), F.array(*least).alias("levels"))
        found = best(rounds(kept, shards, anchors, alike, positives, len(ALIKE), True))
        chosen = found.select("row", F.col("rank").cast("int").alias("request"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
        chosen = kept(chosen, "positives")
        # In whole numbers: the first n with 100 n >= LEAST * score, and the last with 100 n <= MOST * score.
        below = lambda part: F.expr(f"(positive_score * {part} - pmod(positive_score * {part}, 100)) div 100")
        low = below(LEAST) + F.expr(f"if(pmod(positive_score * {LEAST}, 100) > 0, 1, 0)")
        windows = chosen.select("row", "request", low.alias("low"), below(MOST).alias("high"), F.array(*[below(part) for part in WINDOWS]).alias("levels"))
        found = rounds(kept, shards, anchors, windows.where("low <= high"), negatives, len(WINDOWS), False)
        result = (
            best(found, "request")
            .join(chosen, ["row", "request"])
            .join(anchors.select("row", "anchor_id"), "row")
            .select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        )
        return materialize(result, "negatives")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of the anchors of ``embeddings``; see ``hard_negatives`` for nulls, ties and empty tables."""
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
