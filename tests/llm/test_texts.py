"""Decontamination, substring dedup and near-dedup against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, prose
from timberline.llm import decontamination, neardup, substrings
from timberline.llm.batches import flat
from timberline.llm.components import components
from timberline.llm.sketches import counted
from timberline.session import Workspace

SHARED = prose(77, 40)


def plain(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(docs, items, size=10):
    wanted = defaultdict(set)
    for item_id, text in items:
        words = plain(text)
        if item_id is not None and words:
            for i in range(max(1, len(words) - size + 1)):
                wanted[tuple(words[i : i + size])].add(str(item_id))
    lengths = {len(window) for window in wanted}
    out = []
    for doc_id, text in docs:
        words, hit, names = plain(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                own = wanted.get(tuple(words[i : i + n]))
                if own:
                    hit |= set(range(i, i + n))
                    names |= own
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(names), digest, bool(hit)))
    return out


ITEMS = [(1, SHARED), (10, SHARED), (2, "Row, of TEN words!"), (3, None), (4, ""), (None, prose(1, 30)), (5, "... !!"), (6, prose(1, 15)), (7, "ten words ten words")]
DOCS = [*ODD, (20, prose(5, 30) + " " + SHARED.upper() + "; " + prose(6, 10)), (21, SHARED), (22, "Row, of TEN words!"), (23, " ".join(SHARED.split()[:9])), (24, "ten words ten words ten words")]


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_BYTES, 100])
def test_decontamination_of_odd_rows(spark, docs_of, monkeypatch, block_bytes):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, spans string")
    docs = docs_of(DOCS)
    got = decontamination.judged(decontamination.matched(docs, benchmark)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(contamination(DOCS, ITEMS), key=str)
    left = decontamination.clean(docs, benchmark)
    assert left.columns == docs.columns
    assert left.count() == sum(not row.contaminated for row in got)


def test_decontamination_of_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.matched(docs_of([]), none).collect() == []
    assert decontamination.judged(decontamination.matched(docs_of(DOCS), none)).where("contaminated").collect() == []


def removed(docs, size=13):
    first = {}
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if doc_id is not None:
                first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(words) - size + 1):
            if doc_id is not None and first[tuple(words[i : i + size])] < doc_id:
                gone |= set(range(i, i + size))
        kept = " ".join(word for i, word in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), kept))
    return out


@pytest.mark.parametrize("slices,least_bits", [(1, 20), (3, 20), (2, 17)])
def test_substrings_of_odd_rows(docs_of, monkeypatch, slices, least_bits):
    monkeypatch.setattr(substrings, "LEAST_BITS", least_bits)
    monkeypatch.setattr(substrings, "MOST_BITS", least_bits)  # far too few cells lose nothing
    docs = [*DOCS, (30, SHARED + " " + SHARED), (31, prose(9, 20) + "\n" + SHARED), (32, prose(9, 20) + " " + prose(10, 5))]
    table = docs_of(docs)
    got = substrings.deduplicated(table, slices=slices)
    assert sorted(map(tuple, got.select("row.doc_id", "n_words", "n_removed", "kept").collect()), key=str) == sorted(removed(docs), key=str)
    assert got.select("row.*").columns == table.columns


def test_substrings_of_an_empty_table(docs_of):
    assert substrings.deduplicated(docs_of([])).collect() == []


def test_weights_do_not_depend_on_the_number_of_documents():
    draw = np.random.default_rng(4)
    counts = draw.integers(0, 9, 4096).astype(np.uint64)
    counts[:40] = draw.integers(500, 1000, 40)
    for factor in (10, 1_000_000):
        assert np.abs(neardup.inverse(counts * np.uint64(factor), 1000 * factor) - neardup.inverse(counts, 1000)).max() < 1e-6
    weights = neardup.inverse(counts, 1000)
    assert weights.min() >= 1 and weights[40:].min() == weights.max() == 2 and weights[:40].max() < 1.2


def test_one_document_of_each_class_stays(docs_of):
    """Of rows that repeat with id and text, and of equal texts without an id, one stays as well."""
    rows = [*ODD, (None, prose(3, 40)), (None, prose(3, 40)), (20, prose(3, 40)), (21, None), (21, None), (22, ""), (4, "another text of the same id")]
    kept = [(row.doc_id, row.text) for row in neardup.representatives(docs_of(rows)).collect()]
    assert len(kept) == len(set(kept))
    # 6 is a copy of 5; a text without an id is no copy of one that has one.
    assert set(kept) == set(rows) - {(6, prose(1, 120))}
    assert neardup.representatives(docs_of([])).collect() == []


def brute_classes(docs, idf, least=0.8):
    shingles, found = neardup.Shingles(), {}
    for doc_id, text in docs:
        if doc_id is not None:
            _, own, counts = shingles.of(*flat(pa.array([text], pa.string())))
            found[doc_id] = np.repeat(own.astype(np.uint32), counts)
    parent = {i: i for i in found}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(found)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if found[a].size and found[b].size and neardup.similarity(found[a], found[b], idf) >= least:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: top(i) for i in ids}


def changed(text, every):
    return " ".join(f"new{i}" if i % every == every - 1 else word for i, word in enumerate(text.split()))


def near_docs():
    docs = list(ODD)
    for base in range(6):
        text = prose(100 + base, 150)
        docs += [(100 + 10 * base, text), (101 + 10 * base, text), (102 + 10 * base, changed(text, 100)), (103 + 10 * base, changed(text, 75)), (104 + 10 * base, changed(text, 12))]
    # A chain, whose ends are not alike, and documents that share a passage only.
    words = prose(500, 160).split()
    docs += [(300 + i, " ".join(words[i * 10 : i * 10 + 110])) for i in range(5)]
    docs += [(400 + i, SHARED + " " + prose(600 + i, 200)) for i in range(30)]
    return docs


def test_near_duplicates_against_all_pairs(spark, docs_of):
    docs = near_docs()
    table = docs_of(docs)
    texts = table.select("doc_id", "text")
    idf = neardup.inverse(neardup.document_frequencies(texts), len(docs))
    got = neardup.classes(table).collect()
    assert len(got) == len(docs)
    want = brute_classes(docs, idf)
    assert {row.doc_id: row.class_id for row in got if row.doc_id is not None} == want
    assert all(row.class_id is None for row in got if row.doc_id is None)
    assert want[102] == 100 and want[411] == 411
    left = neardup.representatives(table)
    assert left.columns == table.columns
    assert sorted(row.doc_id for row in left.collect() if row.doc_id is not None and row.doc_id != 4) == sorted(i for i in want if want[i] == i and i != 4)


def test_a_large_group_of_near_copies(docs_of):
    text = prose(7, 80)
    docs = [(i, changed(text, 40) + f" tail{i}") for i in range(400)] + [(1000 + i, prose(i, 60)) for i in range(100)]
    found = neardup.classes(docs_of(docs)).collect()
    assert {row.class_id for row in found if row.doc_id < 1000} == {0}
    assert all(row.class_id == row.doc_id for row in found if row.doc_id >= 1000)


def test_a_bucket_in_blocks_gives_the_same(docs_of, monkeypatch):
    docs = docs_of(near_docs())
    want = sorted(map(tuple, neardup.classes(docs).collect()), key=str)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 2)
    monkeypatch.setattr(neardup, "LEADER_ROUNDS", 0)
    assert sorted(map(tuple, neardup.classes(docs).collect()), key=str) == want


def test_near_duplicates_of_an_empty_table(docs_of):
    assert neardup.classes(docs_of([])).collect() == []
    assert neardup.classes(docs_of([(1, None), (2, "")])).count() == 2


def test_draws_agree_as_often_as_documents_are_alike(spark):
    text = prose(3, 3000)
    pairs = [(1, text), (2, changed(text, 30)), (3, changed(text, 12))]
    table = spark.createDataFrame(pairs, "doc_id long, text string")
    idf = neardup.inverse(neardup.document_frequencies(table), 3)
    drawn = neardup.drawn(table, spark.sparkContext.broadcast(idf)).join(neardup.looked_at(table, table), "doc_id")
    rows = {r.doc_id: r for r in drawn.collect()}
    draws = {i: np.frombuffer(r.draws, "<u4") for i, r in rows.items()}
    for other in (2, 3):
        exact = neardup.similarity(*(np.frombuffer(rows[i].shingles, "<u4") for i in (1, other)), idf)
        assert abs((draws[1] == draws[other]).mean() - exact) < 0.25


def test_components_of_stars_take_no_step(spark):
    edges = [(i, i % 5) for i in range(5, 60)]
    with Workspace(spark, "test") as kept:
        found = components(spark.createDataFrame(edges, "a long, b long"), kept)
        assert sorted(map(tuple, found.collect())) == edges
        assert kept.number == 1


def test_counters_reach_the_driver_in_few_jobs(spark):
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("counters", "counters")
    try:
        found = counted(spark.range(1000), lambda batch: iter([batch.column(0).to_numpy() % 64]), 64)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found.tolist() == [16] * 40 + [15] * 24
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("counters")) < 10


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7), (200, 300), (300, 200)]
    with Workspace(spark, "test") as kept:
        found = components(spark.createDataFrame(edges, "a long, b long"), kept)
        roots = {row.node: row.root for row in found.collect()}
    assert roots == {**{i: 0 for i in range(1, 41)}, 101: 100, 103: 100, 300: 200}


def test_repeated_links_of_a_bucket_are_found_beyond_its_leader(spark, docs_of):
    """Two pairs of near copies whose buckets have an unrelated leader."""
    text = prose(11, 100)
    docs = [(1, prose(12, 100)), (5, text), (6, changed(text, 60)), (7, prose(13, 90)), (8, changed(prose(13, 90), 50))]
    table = docs_of(docs).select("doc_id", "text")
    idf = spark.sparkContext.broadcast(neardup.inverse(neardup.document_frequencies(table), 5))
    with Workspace(spark, "test") as kept:
        own = kept(neardup.drawn(table, idf).join(neardup.looked_at(table, table), "doc_id"), "drawn")
        members = table.select(F.lit(1).cast("long").alias("key"), "doc_id", F.col("doc_id").alias("root"))
        roots = {r.node: r.root for r in neardup.linked(members, own, idf, 0.8, kept).collect()}
    assert roots == {6: 5, 8: 7}


@pytest.mark.parametrize("rounds,block_rows", [(2, 4096), (0, 4096), (0, 2)])
def test_a_pair_whose_draws_hardly_agree_is_compared_nevertheless(spark, docs_of, monkeypatch, rounds, block_rows):
    monkeypatch.setattr(neardup, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block_rows)
    text = prose(21, 100)
    docs = [(1, text), (2, changed(text, 60)), (3, changed(text, 6)), (4, prose(22, 100)), (5, SHARED + " " + prose(23, 100))]
    table = docs_of(docs).select("doc_id", "text")
    idf = neardup.inverse(neardup.document_frequencies(table), 5)
    with Workspace(spark, "test") as kept:
        shown = neardup.looked_at(table, table)
        # Draws of which no two documents have one in common.
        none = F.udf(lambda i: np.full(neardup.BANDS * neardup.DRAWS, i, "<u4").tobytes(), "binary")
        own = kept(shown.withColumn("draws", none("doc_id")), "drawn")
        members = table.select(F.lit(1).cast("long").alias("key"), "doc_id", F.col("doc_id").alias("root"))
        found = {r.doc_id: np.frombuffer(r.shingles, "<u4") for r in own.collect()}
        assert neardup.similarity(found[1], found[2], idf) >= 0.8 > neardup.similarity(found[1], found[3], idf)
        roots = {r.node: r.root for r in neardup.linked(members, own, spark.sparkContext.broadcast(idf), 0.8, kept).collect()}
    assert roots == {2: 1}


def test_heads_of_alike_lists_meet():
    draw = np.random.default_rng(5)
    idf = (1 + draw.random(neardup.CELLS)).astype(np.float32)
    base = draw.integers(0, 1 << 32, 60, dtype=np.uint32)
    texts = []
    for _ in range(60):
        own = base.copy()
        new = draw.random(60) < draw.choice([0.02, 0.05, 0.1, 0.15])
        own[new] = draw.integers(0, 1 << 32, int(new.sum()), dtype=np.uint32)
        texts.append(np.sort(np.concatenate([own, own[: draw.integers(0, 8)]])))
    weights, lists, keys = neardup.heads(texts, idf, 0.8)
    shown = [set(keys[lists == i].tolist()) for i in range(60)]
    alike = 0
    for i in range(60):
        for j in range(i):
            if neardup.similarity(texts[i], texts[j], idf) >= 0.8:
                alike += 1
                assert shown[i] & shown[j] and min(weights[i], weights[j]) >= 0.8 * max(weights[i], weights[j])
    assert 100 < alike < 1770
