"""The mix of sources: targets in plain Python, quotas, permutations, blocks and their texts."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, prose
from timberline.llm import mixing
from timberline.session import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """By the rounds of the contract: shares by weight, what is above goes to the others by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = dict.fromkeys(order, 0.0), [s for s in order]
    left = share * sum(sizes.values())
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - most * sizes[s]) for s in open_)
        target = {s: min(t, most * sizes[s]) for s, t in target.items()}
        open_ = [s for s in open_ if target[s] < most * sizes[s]]
    return target


def documents():
    rows = [(i, prose(i, 40 + i * 7 % 300), f"s{i % 7}" if i % 3 else "big") for i in range(240)]
    rows += [(1000 + i, prose(i, 3), "tiny") for i in range(4)] + [(2000, prose(5, 900), None), (2001, prose(6, 20_000), "long"), (2002, None, "nothing")]
    rows += [(3000, prose(8, 77), "s1")] * 5 + [(None, prose(9, 50), "s2"), (None, prose(10, 50), "s2"), (3001, "", ""), (3002, "ä b \x0b c", "Ü")]
    return rows


def table(spark, rows, parts=4):
    schema = "doc_id long, text string, source string, size string, block string, place string"
    return spark.createDataFrame([(*row, "x", "y", "z") for row in rows], schema).repartition(parts)


def query(spark, rows, tmp_path, parts=4):
    table(spark, rows, parts).write.parquet(f"{tmp_path}/documents.parquet")
    return mixing.op13_mixing(spark, str(tmp_path))


def test_mix(spark, tmp_path, monkeypatch):
    for name, value in (("BUCKET_ROWS", 16), ("GROUP", 2), ("CELLS", 8)):
        monkeypatch.setattr(mixing, name, value)
    rows = documents()
    got = query(spark, rows, tmp_path / "a")
    assert dict(got.dtypes) == {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}
    lines = list(map(tuple, got.collect()))
    sizes, count = Counter(), Counter()
    for doc_id, text, source in rows:
        n = len(WORD.findall(text or ""))
        sizes[source] += n
        count[doc_id, n] += 1
    assert Counter((line[0], line[1]) for line in lines) == count
    targets = brute_targets(sizes)
    want = Counter((i, len(WORD.findall(text or "")), sizes[s]) for i, text, s in rows)
    assert Counter(line[:3] for line in lines) == want
    # A source is known by its size here, or by its target.
    by_size, taken = defaultdict(set), Counter()
    for source, n in sizes.items():
        by_size[n].add(round(targets[source], 6))
    for doc_id, size, source_size, target, words in lines:
        assert round(target, 6) in by_size[source_size]
        assert 0 <= words <= 2 * size
        taken[source_size, round(target, 6)] += words
    for (source_size, target), words in taken.items():
        same = sum(1 for s, n in sizes.items() if n == source_size and round(targets[s], 6) == target)
        assert abs(words - same * target) <= same * 1.5 * mixing.BLOCK
    again = query(spark, rows[::-1], tmp_path / "b", parts=7)
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_targets_against_rounds(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 30, None: 500}, {"a": 1, "b": 1, "c": 1}, {"a": 0, "b": 7}, {"a": 0}, {"b": 1, "a": 100, "ab": 50, "c": 2, "d": 900}):
        rows = [(name, n, i) for i, (name, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[0] is None, x[0] or "")))]
        sources = spark.createDataFrame(rows, "source string, source_size long, source_no long")
        weight = F.element_at(F.array(F.lit(3), F.lit(1), F.lit(2)), (F.col("source_no") % 3 + 1).cast("int"))
        got = {row.source: row.target for row in mixing.targets(sources.withColumn("weight", weight), 1.5, 2).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_empty_table_and_texts_without_words(spark, tmp_path):
    assert query(spark, [], tmp_path / "a").collect() == []
    lines = query(spark, [(1, None, "a"), (2, " ", None), (2, " ", None)], tmp_path / "b").collect()
    assert [(row.size, row.source_size, row.target, row.taken) for row in lines] == [(0, 0, 0.0, 0)] * 3


def test_odd_texts(spark, tmp_path):
    rows = [(i, text, "a" if i and i % 2 else None) for i, text in ODD]
    lines = query(spark, rows, tmp_path / "a").collect()
    assert Counter((row.doc_id, row.size) for row in lines) == Counter((i, len(WORD.findall(text or ""))) for i, text, _ in rows)
    assert all(0 <= row.taken <= 2 * row.size for row in lines)


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000])
def test_permutation(spark, n):
    ids = spark.range(n)
    both = ids.select(*[mixing.permuted(F.col("id"), F.lit(n), F.lit(key)).alias(f"p{key}") for key in (1, 2)]).collect()
    assert sorted(row.p1 for row in both) == sorted(row.p2 for row in both) == list(range(n))
    if n > 60:
        assert sum(row.p1 == row.p2 for row in both) < n / 8
        assert sum(a.p1 + 1 == b.p1 for a, b in zip(both, both[1:])) < n / 8


def test_slots_and_texts(spark):
    rows = documents()
    docs = table(spark, rows)
    with Workspace(spark, "test") as kept:
        made = mixing.mix(docs, kept, block=16, shard_slots=32)
        facts = {row.source_no: row for row in made.sources.collect()}
        slots = made.slots.collect()
        total = sum(row.quota for row in facts.values())
        assert sorted((row.shard, row.slot) for row in slots) == [(i // 32, i % 32) for i in range(total)]
        assert Counter(row.source_no for row in slots) == Counter({no: row.quota for no, row in facts.items() if row.quota})
        # A pass takes each block once, and passes follow each other.
        assert max(Counter((row.source_no, row["pass"], row.block) for row in slots).values()) == 1
        for no, row in facts.items():
            for turn in range(row.quota // row.blocks if row.blocks else 0):
                assert {s.block for s in slots if s.source_no == no and s["pass"] == turn} == set(range(row.blocks))
        # Counts of shards differ as draws do, and follow the shares.
        whole = [Counter(s.source_no for s in slots if s.shard == shard) for shard in range(total // 32)]
        assert len({tuple(sorted(c.items())) for c in whole}) > len(whole) // 2
        pieces = made.contents().collect()
        filled = Counter()
        for row in pieces:
            filled[row.shard, row.slot] += row.length
        assert max(filled.values()) == 16 and sorted(filled) == sorted((row.shard, row.slot) for row in slots)
        texts = {(row.shard, row.slot): row.text for row in made.texts(docs).collect()}
        assert {key: len(WORD.findall(text)) for key, text in texts.items()} == dict(filled)
        words = {}
        for doc_id, text, _ in rows:
            words.setdefault(doc_id, []).append(WORD.findall(text or ""))
        for row in pieces:
            own = WORD.findall(texts[row.shard, row.slot])[row.offset : row.offset + row.length]
            assert any(w[row.start : row.start + row.length] == own for w in words[row.doc_id])
