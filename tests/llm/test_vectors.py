"""Whitening and hard negatives against plain numpy and plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from timberline.llm import negatives, vectors, whitening

# --- whitening


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 40), st.integers(0, 10_000))
def test_rank_one_updates(width, count, seed):
    draw = np.random.default_rng(seed)
    rows = draw.integers(-30, 30, (count, width)).astype(float) + whitening.SHIFT
    rows[count // 3 : count // 2] = rows[0]
    rows[:, width // 2 :] = np.where(seed % 2, rows[:, width // 2 :], rows[:, :1])
    parts = [whitening.Spectrum.empty(width) for _ in range(3)]
    for i, row in enumerate(rows):
        parts[i % 3].add(row)
    for other in parts[1:]:
        parts[0].combine(other)
    own, away = parts[0], rows - rows.mean(0)
    scatter = away.T @ away
    scale = max(scatter.max(), 1)
    assert own.n == count
    assert np.abs(own.mean - rows.mean(0)).max() < 1e-6
    assert np.abs(own.basis.T @ own.basis - np.eye(width)).max() < 1e-11
    assert np.abs(own.basis * own.values @ own.basis.T - scatter).max() < 1e-8 * scale
    assert (np.diff(own.values) >= 0).all()


def test_roots_lie_behind_their_poles():
    poles, squares = np.array([0.0, 1e-9, 1.0, 1.0 + 1e-12, 5.0]), np.array([1.0, 1e-18, 2.0, 1e-3, 1e-14])
    roots, gaps = whitening.secular(poles, squares, 0.7)
    matrix = np.diag(poles) + 0.7 * np.outer(np.sqrt(squares), np.sqrt(squares))
    assert np.abs(roots - np.linalg.eigvalsh(matrix)).max() < 1e-13
    assert (np.diag(gaps) < 0).all() and (np.diag(gaps, 1) > 0).all()


def expected(rows, components):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good], dtype=object)
    n, sums = len(x), x.sum(0)
    away = x * n - sums
    centred = (away / n).astype(float)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    return [i for i, _ in good], [int((row * row).sum()) for row in away], centred, values, basis[:, :components], n


def test_whitening(spark, monkeypatch):
    monkeypatch.setattr(vectors, "FAN_IN", 2)
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 1 + j) for j in range(6)]) for i in range(300)]
    rows += [(400, None), (401, []), (402, [1.0, None] + [0.0] * 4), (403, [math.nan] + [0.0] * 5), (404, [math.inf] * 6)]
    rows += [(7, rows[7][1]), (None, [0.5] * 6), (500, [0.25] * 6), (501, [0.25] * 6)]
    schema = "vec_id long, embedding array<float>, n string, component string"
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], schema).repartition(5)
    kept = [(row.vec_id, row.embedding) for row in table.collect()]
    got = whitening.whiten(table, 4).collect()
    ids, away, centred, values, basis, n = expected(kept, 4)
    assert len(got) == 4 * n and {row.n for row in got} == {n}
    own = {}
    for row in got:
        own.setdefault((row.vec_id or -1, row.deviation), {}).setdefault(row.component, []).append(row.whitened)
    turned = centred @ (basis / np.sqrt(values[:4]))
    signs = np.sign([turned[0, c] * own[ids[0] or -1, away[0]][c + 1][0] for c in range(4)])
    for i, a, line in zip(ids, away, turned * signs):
        for c in range(4):
            assert np.abs(np.array(own[i or -1, a][c + 1]) - line[c]).max() < 1e-9
    for row in got:
        assert abs(row.explained - values[row.component - 1] / values.sum()) < 1e-12
        assert 0 <= row.identity_error < 1e-10


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []


def test_whitening_of_two_widths(spark):
    rows = [(i, [float(i), float(i * i % 7)]) for i in range(9)] + [(20, [1.0]), (21, [2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {row.vec_id for row in got} == set(range(9)) and {row.n for row in got} == {9}


def test_sums_that_do_not_fit_raise():
    with pytest.raises(OverflowError):
        whitening.entries(np.array([[1e300]]))
    with pytest.raises(OverflowError):
        whitening.deviations(np.array([[1 << 61, 1 << 61]], dtype=np.int64))
    assert whitening.deviations(np.array([[3_000_000_000, 1]], dtype=np.int64)).tolist() == [9 * 10**18 + 1]


# --- hard negatives


def labelled(count, seed, width=8, spread=1.0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(count):
        centre = centres[0 if draw.random() < 0.4 else draw.randrange(4)]
        rows.append((i, [c + draw.gauss(0, spread) for c in centre], draw.choice([0, 0, 0, 1, 2, 9])))
    return rows


ODD_VECTORS = [
    (900, None, 1), (1000, [1.0] * 8, None), (1100, [], 1), (1200, [1.0, None] + [0.0] * 6, 1), (1300, [math.nan] * 8, 1),
    (None, [1.0] * 8, 1), (1400, [0.0] * 8, 1), (1500, [1.0, 2.0], 0), (1501, [1.0, 2.5], 0), (1502, [0.5, 1.5], 1),
    (1600, [0.5] * 8, 0), (1600, [0.5] * 8, 0), (1601, [0.5] * 8, 0), (1602, [0.4] * 8, 1), (1602, [0.4] * 8, 1), (1603, [0.4] * 8, 2),
    (1700, [3.0] * 3, 77), (1800, [-1.0] * 8, 5), (1801, [1.0] * 8, 5), (2100, [0.25] * 8, 9), (2101, [0.25] * 8, 0),
]


def brute_negatives(rows, step, positives, negatives_):
    good = []
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (anchor, label, v) in enumerate(good):
        if anchor % step:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, own == label) for b, (i, own, w) in enumerate(good) if b != a and len(w) == len(v)]
        for score, i, _ in sorted(x for x in scored if x[2])[:positives]:
            inside = sorted(x for x in scored if not x[2] and -30 * score <= -100 * x[0] <= -90 * score)
            out += [(anchor, i, rank + 1, j, -score, -other) for rank, (other, j, _) in enumerate(inside[:negatives_])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block_rows,part_shards,step", [(4096, 8192, 16, 8), (13, 3, 2, 3)])
def test_hard_negatives(spark, monkeypatch, shard_rows, block_rows, part_shards, step):
    for name, value in (("SHARD_ROWS", shard_rows), ("BLOCK_ROWS", block_rows), ("PART_SHARDS", part_shards), ("STEP", step), ("TILE_ROWS", 5)):
        monkeypatch.setattr(negatives, name, value)
    rows = labelled(400, 5) + ODD_VECTORS
    table = spark.createDataFrame([(*row, "x", "y") for row in rows], "vec_id long, embedding array<double>, label int, rank string, request string")
    got = negatives.hard_negatives(table.repartition(4), 20, 5, 10)
    want = brute_negatives(rows, 20, 5, 10)
    assert len(want) > 500
    assert sorted(map(tuple, got.collect())) == want
    assert [kind for _, kind in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_hard_negatives_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(100, [1.0], 1)], [(100, [1.0], 1), (101, [1.0], 1)], [(100, [1.0], 1), (101, [0.5], 2)]):
        assert negatives.hard_negatives(spark.createDataFrame(rows, schema)).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.floats(-0.5, 1), st.integers(1, 20))
def test_index_loses_no_pair(seed, part, width):
    draw = np.random.default_rng(seed)
    vectors_, anchors = (np.floor(256 * draw.normal(size=(n, width)) * draw.exponential(1, width) ** 2) for n in (60, 7))
    norms = np.sqrt((anchors**2).sum(1))
    thresholds = np.floor(part * norms * np.sqrt((vectors_**2).sum(1)).max())
    index = negatives.Index(vectors_, float(thresholds.min()), float(norms.max()))
    left, right, found = index.scores(anchors, thresholds)
    exact = anchors @ vectors_.T
    assert (found == exact[left, right]).all()
    assert {(i, j) for i, j in zip(*np.nonzero(exact >= thresholds[:, None]))} <= set(zip(left.tolist(), right.tolist()))
    assert len(set(zip(left.tolist(), right.tolist()))) == left.size


def test_index_omits_what_norms_cover():
    vectors_ = np.array([[100.0, 0, 0, 0], [0.0, 1, 0, 0], [60.0, 60, 1, 1]])
    index = negatives.Index(vectors_, 5_000.0, 100.0)
    assert index.listed.tolist() == [1, 0, 2]
