"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A shingle is a run of five words; its weight in a document is its count there times an inverse document frequency,
which lies between 1 and 2, so that common passages count less but a large group of near copies still matches. It follows
from the share of all documents that have the shingle, counted in a table of fixed width (see ``inverse``).

Consistent weighted sampling draws, for each of a number of hash functions, one shingle and a level of its weight; two
documents draw the same with the probability of their weighted Jaccard similarity. The draws are banded. Documents
that share a band meet in a bucket, and pairs are verified by the exact weighted Jaccard similarity of their
shingles. Equal documents are put together first. A bucket does not give all its pairs: first its members are
compared with its smallest one, which makes most of a group of copies one component. Then the members outside of a
bucket's largest component are compared with all others inside of a task. There a pair is left out only where a bound
shows that it is not alike enough: by the weights of both, or because they share none of the rarer shingles, of which
alike documents share one. The share of equal draws only orders the comparisons. So no link that the buckets show is
lost, save links inside of a component that is known already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.llm.batches import pieces, small_batches
from timberline.llm.components import components
from timberline.llm.sketches import counted
from timberline.llm.words import SPACED, Words, mixed
from timberline.session import Workspace, materialize

SHINGLE = 5
SIMILARITY = 0.8
# 12 bands of 5 draws find a pair of similarity 0.8 with 0.992, of 0.9 with 0.99998.
BANDS, DRAWS = 12, 5
# Cells of the table of document frequencies. Shingles in a smaller share of the documents than this weigh the same.
CELLS = 1 << 20
RARE_SHARE = 0.002
# Rounds in which the members of a bucket are compared with its smallest one only, before all pairs of different
# components are.
LEADER_ROUNDS = 2
# Members of a bucket that meet in one task; a larger bucket is dealt out to several.
BLOCK_ROWS = 4096
# Bytes of comparisons that a task holds at once.
_HELD = 16 << 20
# Bounds leave so much room for rounding.
_ROOM = 1 - 1e-6

_DRAWN = "doc_id long, high long, low long, bands array<long>, draws binary"
_STEPS = 1 << 16


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the gamma distribution with shape 2, and their logarithms."""
    x = np.concatenate([np.geomspace(1e-6, 1, 40_000), np.linspace(1, 40, 200_000)[1:]])
    quantile = np.interp((np.arange(_STEPS) + 0.5) / _STEPS, -np.expm1(-x) - x * np.exp(-x), x)
    return quantile.astype(np.float32), np.log(quantile).astype(np.float32)


class Shingles:
    """Distinct shingles of the texts in a batch with their counts."""

    def __init__(self):
        self.words = Words(SPACED)

    def of(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, shingles as 32-bit numbers and their counts, in the order of rows and numbers.

        A text of fewer words than a shingle has one shingle of all of them.
        """
        starts, ends, first = self.words.split(data, at)
        hashes = self.words.hashes(data, starts, ends)
        begin, keys = self.words.windows(hashes, first, SHINGLE)
        row = np.searchsorted(first, begin, side="right") - 1
        sizes = np.diff(first)
        short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
        if short.size:
            whole = self.words.run(self.words.sums(hashes), first[short], first[short] + sizes[short])
            row, keys = np.concatenate([row, short]), np.concatenate([keys, whole])
        both = np.sort((row.astype(np.uint64) << np.uint64(32)) | (keys >> np.uint64(32)))
        new = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if both.size else np.zeros(0, np.int64)
        counts = np.diff(np.append(new, both.size))
        both = both[new]
        return (both >> np.uint64(32)).astype(np.int64), both & np.uint64(0xFFFFFFFF), counts


def document_frequencies(texts: DataFrame) -> np.ndarray:
    def cells(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        shingles = Shingles()
        for _, _, data, at in pieces(batch.column(0)):
            _, own, _ = shingles.of(data, at)
            yield (own & np.uint64(CELLS - 1)).astype(np.int64)

    return counted(texts.select("text"), cells, CELLS)


def inverse(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """Between 1, for what is in all documents, and 2, for what is in RARE_SHARE of them or fewer.

    A weight follows from the share of documents, so a corpus of any size gives the same pair the same similarity. Shingles
    that share a cell stray into its count; as many do for a document on average as there are cells for, whatever the number of
    documents, and their mean is taken off. What is left of them is a share of about the square root of
    (shingles of a document / cells / documents), which lies far below RARE_SHARE from some thousand documents on.
    """
    counts = frequencies.astype(np.float64)
    stray = (counts.sum() - counts) / max(counts.size - 1, 1)
    share = np.clip((counts - stray) / max(documents, 1), RARE_SHARE, 1.0)
    return (1.0 + np.log(share) / np.log(RARE_SHARE)).astype(np.float32)


def drawn(texts: DataFrame, idf) -> DataFrame:
    """What each document is compared by, as in ``_DRAWN``: two numbers that equal documents share, its bands and
    its draws. Documents without words have nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, (gamma, log_gamma) = Shingles(), _tables()
        total = BANDS * DRAWS
        seeds = mixed(np.arange(total, dtype=np.uint64), 3)
        for batch in batches:
            for top, last, data, at in pieces(batch.column(1)):
                row, own, counts = shingles.of(data, at)
                there, begin, sizes = np.unique(row, return_index=True, return_counts=True)
                draws = np.zeros((there.size, total), np.uint32)
                if there.size:
                    log_weight = np.log(counts * idf.value[(own & np.uint64(CELLS - 1)).astype(np.int64)]).astype(np.float32)
                    place = np.repeat(np.arange(there.size), sizes)
                    spread = own * np.uint64(0x9E3779B97F4A7C15)
                    for k in range(total):
                        x = (spread ^ seeds[k]) * np.uint64(0xBF58476D1CE4E5B9)
                        x ^= x >> np.uint64(32)
                        x *= np.uint64(0x94D049BB133111EB)
                        r = gamma[(x >> np.uint64(48)).astype(np.int64)]
                        beta = ((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(1 / _STEPS)
                        level = np.floor(log_weight / r + beta)
                        chance = log_gamma[((x >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int64)] - r * (level - beta + 1)
                        least = np.flatnonzero(chance == np.minimum.reduceat(chance, begin)[place])
                        chosen = np.empty(there.size, np.int64)
                        chosen[place[least][::-1]] = least[::-1]
                        draws[:, k] = (mixed(own[chosen] ^ (level[chosen].astype(np.int64).view(np.uint64) << np.uint64(32)), 11) >> np.uint64(32)).astype(np.uint32)
                    bands = np.zeros((there.size, BANDS), np.uint64)
                    for k in range(total):
                        bands[:, k // DRAWS] = mixed(bands[:, k // DRAWS] + draws[:, k] + np.uint64(k // DRAWS), 5)
                    each = mixed(own + (counts.astype(np.uint64) << np.uint64(32)), 13)
                    high, low = np.add.reduceat(mixed(each, 17), begin), np.add.reduceat(mixed(each, 19), begin)
                full = np.full(last - top, -1)
                full[there] = np.arange(there.size)
                index = pa.array(full, pa.int64(), mask=full < 0)
                take = lambda array: array.take(index)
                if not there.size:
                    bands, high, low = np.zeros((0, BANDS), np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(top, last - top),
                        take(pa.array(high.view(np.int64))),
                        take(pa.array(low.view(np.int64))),
                        take(pa.ListArray.from_arrays(pa.array(np.arange(there.size + 1) * BANDS, pa.int32()), pa.array(bands.reshape(-1).view(np.int64)))),
                        take(pa.array([x.tobytes() for x in draws], pa.binary())),
                    ],
                    names=["doc_id", "high", "low", "bands", "draws"],
                )

    return texts.select("doc_id", "text").mapInArrow(run, _DRAWN)


def looked_at(texts: DataFrame, members: DataFrame) -> DataFrame:
    """``doc_id, shingles`` of the documents among ``members`` and a few more: 32-bit numbers, each as often as it occurs.

    Which documents these are is sent to the tasks as a table of fixed width, so only their shingles are made and moved.
    """

    def cells_of(ids: pa.Array) -> np.ndarray:
        numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        return (mixed(numbers, 23) & np.uint64(CELLS - 1)).astype(np.int64)

    def cells(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield cells_of(batch.column(0))

    wanted = texts.sparkSession.sparkContext.broadcast(counted(members.select("doc_id").distinct(), cells, CELLS) > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            batch = batch.take(pa.array(np.flatnonzero(wanted.value[cells_of(batch.column(0))])))
            for top, last, data, at in pieces(batch.column(1)):
                row, own, counts = shingles.of(data, at)
                flat = np.repeat(own.astype("<u4"), counts)
                ends = np.cumsum(np.bincount(row, weights=counts, minlength=last - top)).astype(np.int64)
                bounds = zip([0, *ends[:-1].tolist()], ends.tolist())
                made = pa.array([flat[a:b].tobytes() for a, b in bounds], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(top, last - top), made], names=["doc_id", "shingles"])

    return texts.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "doc_id long, shingles binary")


def similarity(a: np.ndarray, b: np.ndarray, idf: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted lists of shingles with repeats."""
    everything = np.concatenate([a, b])
    keys, where = np.unique(everything, return_inverse=True)
    left, right = np.bincount(where[: a.size], minlength=keys.size), np.bincount(where[a.size :], minlength=keys.size)
    weight = idf[(keys & np.uint32(CELLS - 1)).astype(np.int64)].astype(np.float64)
    most = float((np.maximum(left, right) * weight).sum())
    return float((np.minimum(left, right) * weight).sum()) / most if most else 0.0


def heads(texts: list[np.ndarray], idf: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight of each sorted list of shingles; and the heads of the lists, as list numbers and shingles.

    Shingles are ordered by the number of lists that have them, the rarest first. A pair whose first common shingle in
    this order is at some place has no more in common than either list weighs from there on, and has to have ``least`` of
    its weight in common. So the head of a list ends where less than that is left, and alike lists have heads that meet.
    """
    sizes = [x.size for x in texts]
    keys = np.concatenate([*texts, np.zeros(0, "<u4")])
    lists = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    new = np.append(True, (keys[1:] != keys[:-1]) | (lists[1:] != lists[:-1]))[: keys.size]
    begin = np.flatnonzero(new)
    counts = np.diff(np.append(begin, keys.size))
    keys, lists = keys[begin], lists[begin]
    weight = counts * idf[(keys & np.uint32(CELLS - 1)).astype(np.int64)].astype(np.float64)
    _, which, often = np.unique(keys, return_inverse=True, return_counts=True)
    order = np.lexsort((which, often[which], lists))
    keys, lists, weight = keys[order], lists[order], weight[order]
    totals = np.bincount(lists, weights=weight, minlength=len(texts))
    # What a list weighs from each of its places on.
    up_to = np.cumsum(weight)
    left = np.cumsum(totals)[lists] - up_to + weight
    head = left >= least * totals[lists] * _ROOM - 1e-9 * (up_to[-1] if up_to.size else 0.0)
    return totals, lists[head], keys[head]


def verified(pairs: DataFrame, own: DataFrame, idf, least: float) -> DataFrame:
    """Those of the pairs ``a, b`` whose similarity is ``least`` or more."""
    side = lambda name: own.select(F.col("doc_id").alias(name), F.col("shingles").alias(f"shingles_{name}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ([np.frombuffer(x.as_buffer(), "<u4") for x in batch.column(i)] for i in (2, 3))
            keep = [i for i, (x, y) in enumerate(zip(*texts)) if similarity(x, y, idf.value) >= least]
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "shingles_a", "shingles_b").mapInArrow(compare, "a long, b long")


def linked(members: DataFrame, own: DataFrame, idf, least: float, kept: Workspace) -> DataFrame:
    """``node, root`` of the documents that are linked, from ``key, doc_id, root`` of the buckets."""
    now, stars = members, None
    for _ in range(LEADER_ROUNDS):
        leader = now.groupBy("key").agg(F.min("doc_id").alias("lead"), F.min_by("root", "doc_id").alias("lead_root"))
        with_leader = now.join(leader, "key")
        pairs = with_leader.where("root <> lead_root").select(F.col("lead").alias("a"), F.col("doc_id").alias("b")).distinct()
        stars = components(and_stars(verified(pairs, own, idf, least), stars), kept)
        now = kept(open_buckets(rooted(with_leader.where("doc_id <> lead").select("key", "doc_id"), stars)), "open")
    return components(and_stars(links_left(now, own, idf, least), stars), kept)


def and_stars(edges: DataFrame, stars: DataFrame | None) -> DataFrame:
    return edges if stars is None else edges.unionAll(stars.select(F.col("node").alias("a"), F.col("root").alias("b")))


def links_left(members: DataFrame, own: DataFrame, idf, least: float) -> DataFrame:
    """Links ``a, b`` between members of a bucket of different components, from ``key, doc_id, root``.

    Of two members of different components one at least is outside of the bucket's largest component. Those outside
    are copied to each block of their bucket and compared there with its members, by their shingles, those first whose
    draws agree most. Pairs that the bounds of ``heads`` rule out are not compared. A link joins two components, so that no
    other pair of these two is compared in the block. Only links leave the task.
    """
    sizes = members.groupBy("key", "root").agg(F.count("*").alias("n"))
    buckets = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.max_by("root", F.struct("n", "root")).alias("main"))
    buckets = buckets.select("key", "main", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks"))
    rows = members.join(buckets, "key").join(own, "doc_id")
    rows = rows.withColumn("outside", F.col("root") != F.col("main"))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks")).withColumn("copy", F.lit(False))
    copies = rows.where("outside").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("copy", F.lit(True))
    columns = ["key", "block", "copy", "outside", "doc_id", "root", "draws", "shingles"]
    both = dealt.select(*columns).unionByName(copies.select(*columns)).repartition("key", "block").sortWithinPartitions("key", "block")

    def pairs_of(group: pa.Table) -> pa.RecordBatch:
        copy, outside, ids, roots = (group.column(i).to_numpy() for i in (2, 3, 4, 5))
        draws = np.frombuffer(b"".join(group.column(6).to_pylist()), "<u4").reshape(ids.size, -1)
        x, y = np.flatnonzero(copy), np.flatnonzero(~copy)
        texts = [np.frombuffer(x, "<u4") for x in group.column(7).to_pylist()]
        parent: dict[int, int] = {}

        def top_of(root: int) -> int:
            while parent.get(root, root) != root:
                root = parent[root]
            return root

        links = []
        weights, lists, keys = heads(texts, idf.value, least)
        place = np.full(ids.size, -1)
        place[y] = np.arange(y.size)
        of_y = np.flatnonzero(place[lists] >= 0)
        of_y = of_y[np.argsort(keys[of_y], kind="stable")]
        keys_y, place_y = keys[of_y], place[lists[of_y]]
        step = max(1, _HELD // max(1, y.size * draws.shape[1]))
        for top in range(0, x.size, step):
            own_x = x[top : top + step]
            # The heads of a list are together.
            entries = np.concatenate([np.arange(*np.searchsorted(lists, [n, n + 1])) for n in own_x])
            rows = np.searchsorted(own_x, lists[entries])
            start = np.searchsorted(keys_y, keys[entries], "left")
            number = np.searchsorted(keys_y, keys[entries], "right") - start
            may = np.zeros((own_x.size, y.size), bool)
            cuts = np.searchsorted(np.cumsum(number), np.arange(_HELD // 8, number.sum(), _HELD // 8)).tolist()
            for low, high in zip([0, *cuts], [*cuts, number.size]):
                n = number[low:high]
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[low:high], n)
                may[np.repeat(rows[low:high], n), place_y[at]] = True
            w_x, w_y = weights[own_x][:, None], weights[y][None, :]
            may &= np.minimum(w_x, w_y) >= least * np.maximum(w_x, w_y) * _ROOM
            may &= roots[own_x][:, None] != roots[y][None, :]
            # Two members outside meet twice.
            may &= ~outside[y][None, :] | (ids[own_x][:, None] < ids[y][None, :])
            i, j = np.nonzero(may)
            agree = np.concatenate([(draws[own_x[i[n : n + 65536]]] == draws[y[j[n : n + 65536]]]).mean(axis=1) for n in range(0, i.size, 65536)] or [np.zeros(0)])
            for k in np.argsort(-agree, kind="stable").tolist():
                a, b = own_x[i[k]], y[j[k]]
                left, right = top_of(int(roots[a])), top_of(int(roots[b]))
                if left != right and similarity(texts[a], texts[b], idf.value) >= least:
                    parent[left] = right
                    links.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, block = (batch.column(i).to_numpy() for i in (0, 1))
            changes = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            if held and (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) != (key[0], block[0]):
                yield pairs_of(pa.Table.from_batches(held))
                held = []
            bounds = [0, *changes.tolist(), batch.num_rows]
            for start, end in zip(bounds[:-1], bounds[1:]):
                held.append(batch.slice(start, end - start))
                if end < batch.num_rows:
                    yield pairs_of(pa.Table.from_batches(held))
                    held = []
        if held:
            yield pairs_of(pa.Table.from_batches(held))

    return both.mapInArrow(compare, "a long, b long").distinct()


def rooted(rows: DataFrame, stars: DataFrame) -> DataFrame:
    return rows.join(stars, rows.doc_id == stars.node, "left").select("key", "doc_id", F.coalesce("root", "doc_id").alias("root"))


def open_buckets(rows: DataFrame) -> DataFrame:
    """The rows of buckets with members of several components."""
    several = rows.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    return rows.join(several, "key", "left_semi")


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id`` for each row of ``doc_id, text``; ``class_id`` is the smallest id of the class.

    A null or empty text is like no other and a class of its own, as is a row without an id, whose class is null;
    rows with the same id are the same document; an empty table gives an empty result; other columns are ignored.
    Texts are compared whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    documents = texts.count()
    idf = spark.sparkContext.broadcast(inverse(document_frequencies(texts), documents))
    with Workspace(spark, "near-duplicates") as kept:
        every = kept(drawn(texts, idf), "drawn")
        first = kept(every.where("high is not null and doc_id is not null").groupBy("high", "low").agg(F.min("doc_id").alias("first")), "first")
        bands = every.select("doc_id", "bands").join(first.select(F.col("first").alias("doc_id")), "doc_id", "left_semi")
        keys = bands.select("doc_id", F.explode("bands").alias("key")).distinct()
        members = kept(open_buckets(keys.select("key", "doc_id", F.col("doc_id").alias("root"))), "members")
        # Only what shares a bucket is looked at again.
        own = looked_at(texts, members).join(every.select("doc_id", "draws"), "doc_id")
        stars = linked(members, kept(own.dropDuplicates(["doc_id"]), "compared"), idf, least, kept)
        named = first.join(stars, first["first"] == stars.node, "left").select("high", "low", F.coalesce("root", "first").alias("class_id"))
        return materialize(
            every.select("doc_id", "high", "low").join(named, ["high", "low"], "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id")),
            "classes",
        )


def representatives(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class, the one with the smallest id, with its columns.

    Of rows that repeat with an id and text, and of equal texts without an id, one stays; which one is open where they differ
    in other columns. Rows of one id with different texts are one document and stay. Null and empty texts are like no
    other: each id keeps one row of them, and so do rows without an id. An empty table gives an empty result.
    """
    others = classes(docs.select("doc_id", "text"), least).where("doc_id <> class_id").select("doc_id").distinct()
    # Of a corpus, too many ids to be sent to every task: the same plan for a small one, so that what is moved grows with the input.
    return once(docs).join(others.hint("shuffle_merge"), "doc_id", "left_anti").select(*docs.columns)


def once(docs: DataFrame) -> DataFrame:
    """``docs`` with one row for each id and text. Only texts of rows that repeat are moved, a row of each task."""
    own = docs.withColumns({"_own_id": F.col("doc_id"), "_own_text": F.md5("text")})
    repeated = own.groupBy("_own_id", "_own_text").agg(F.count("*").alias("n")).where("n > 1")
    repeated = materialize(repeated.select(F.col("_own_id").alias("_i"), F.col("_own_text").alias("_t")), "repeated")
    if repeated.isEmpty():
        return docs
    same = F.col("_own_id").eqNullSafe(F.col("_i")) & F.col("_own_text").eqNullSafe(F.col("_t"))
    first = own.join(repeated, same, "left_semi").dropDuplicates(["_own_id", "_own_text"])
    return own.join(repeated, same, "left_anti").unionByName(first).select(*docs.columns)


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each row of ``documents``; see ``classes`` for nulls, repeated rows and empty tables."""
    found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.withColumn("is_first", F.col("doc_id") == F.col("class_id"))
