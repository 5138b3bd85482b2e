from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD
from timberline.llm import packing, sharding
from timberline.llm.batches import flat


@pytest.mark.parametrize("n", [1, 2, 3, 23, 24, 25, 1000, 4097])
def test_permutation_and_its_inverse(n):
    places = sharding.permute(np.arange(n), n)
    assert sorted(places.tolist()) == list(range(n))
    assert sharding.permute(places, n, inverse=True).tolist() == list(range(n))


def test_order_is_shuffled_and_depends_on_the_seed():
    first, second = sharding.permute(np.arange(5000), 5000), sharding.permute(np.arange(5000), 5000, seed=1)
    assert (first != second).mean() > 0.9
    assert abs(np.corrcoef(first, np.arange(5000))[0, 1]) < 0.1


def test_row_numbers_have_to_be_in_range():
    with pytest.raises(ValueError):
        sharding.permute([5], 5)


def test_shard_query_against_the_formula(spark, sf_dir):
    rows = sharding.op1_sharding(spark, sf_dir).collect()
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    number = {doc_id: i for i, doc_id in enumerate(sorted(texts))}
    for row in rows:
        data = (texts[row.doc_id] or "").encode()
        assert (row.shard, row.slot) == sharding.shard_and_slot(number[row.doc_id], len(rows), 24)
        assert sharding.row_of(row.shard, row.slot, len(rows), 24) == number[row.doc_id]
        assert (row.size, row.text_crc32) == (len(data) + 8, zlib.crc32(data))
        assert row.law == "rows" and row.grown_shard is None


def test_shards_of_odd_rows(docs_of):
    rows = sharding.shard(docs_of(ODD), 5).collect()
    assert Counter(row.doc_id for row in rows) == Counter(doc_id for doc_id, _ in ODD)
    slots = defaultdict(list)
    for row in rows:
        slots[row.shard].append(row.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert {row.size for row in rows if row.doc_id in (1, 2)} == {8}


def test_shards_do_not_depend_on_the_layout(docs_of):
    rows = [(i, f"text {i % 7}") for i in range(500)]
    results = [sorted(map(tuple, sharding.shard(docs_of(rows).repartition(n)).collect()), key=str) for n in (1, 8)]
    assert results[0] == results[1]


def test_empty_tables(docs_of):
    assert sharding.shard(docs_of([])).collect() == []
    assert packing.pack(docs_of([])).collect() == []


@pytest.fixture(scope="module")
def words():
    return packing.WordIds(packing.VOCABULARY)


SIGNS = "aAbBzZ019 .,;!?'\"<|>-_*$\n\t\x1c\x1f\x85 éÉÀßẞçÇñ×÷ÿÞ́̇̈İıΣσςµ中あ\U0001f642‍´»«…　ǅﬁ½²"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(SIGNS), max_size=25) | st.just("it's <|endoftext|> here"), min_size=1, max_size=4))
def test_ids_of_words_are_those_of_the_text(words, texts):
    import pyarrow as pa

    ids, places = words.of(*flat(pa.array(texts)))
    for i, text in enumerate(texts):
        want = words.tokenizer.encode(text, add_special_tokens=False).ids + [packing.END_ID]
        assert ids[places[i] : places[i + 1]].tolist() == want


def check_packed(rows, texts, words, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append((row.offset, row.length))
    for doc_id, text in texts.items():
        ids = words.tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        own = sorted(by_doc[doc_id], key=lambda row: row.piece)
        assert [row.start for row in own] == list(range(0, len(ids), capacity))
        for row in own:
            part = np.array(ids[row.start : row.start + capacity], "<u4")
            assert (row.length, row.ids_crc32) == (len(part), zlib.crc32(part.tobytes()))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence), -(-sum(row.length for row in rows) // capacity)


def test_packing_query(spark, small_dir, words):
    rows = packing.op3_packing(spark, small_dir).collect()
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    sequences, bound = check_packed(rows, texts, words, packing.CAPACITY)
    assert sequences <= bound * 1.02 + 1


def test_packing_odd_rows(docs_of, words):
    once = [x for i, x in enumerate(ODD) if x not in ODD[:i]]
    rows = packing.pack(docs_of(once), capacity=64).collect()
    check_packed(rows, dict(once), words, 64)
    again = packing.pack(docs_of(ODD), capacity=64, with_ids=True).collect()
    assert Counter(row.doc_id for row in again)[4] == 2 * Counter(row.doc_id for row in rows)[4]
    assert all(len(row.ids) == row.length for row in again)
    assert all(zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32 for row in again)


def best_fit_one_by_one(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, gap in enumerate(gaps) if gap >= length]
        if fitting:
            i = min(fitting, key=lambda i: gaps[i])
            gaps[i] -= length
        else:
            gaps.append(capacity - length)
    return len(gaps)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120))
def test_runs_fill_as_many_sequences_as_piece_by_piece(lengths):
    plan, bins = packing.best_fit(dict(Counter(lengths)), 30)
    assert bins == best_fit_one_by_one(lengths, 30)
    used = defaultdict(list)
    order = sorted(lengths, reverse=True)
    for number, length in enumerate(order):
        run = plan[plan["row"] <= number].iloc[-1]
        turn = number - run["row"]
        assert run["length"] == length
        used[run["bin"] + turn // run["each"]].append((run["offset"] + turn % run["each"] * length, length))
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 30
