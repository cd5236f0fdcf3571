"""Hard negatives: the tree search against brute force, on clustered and odd tables."""

import random
from math import floor, isfinite

import numpy as np
import pytest

from refloom.llm import hard_negatives as N
from refloom.llm import treesearch as TS

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """The contract by loops; rows with one id: the smallest label, then the smallest packed vector."""
    one = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not isfinite(x) for x in vector):
            continue
        whole = [floor(256 * x) for x in np.array(vector, dtype=np.float32).astype(float)]
        key = (label, TS.pack(np.array(whole, dtype=float)))
        if vec_id not in one or key < one[vec_id][:2]:
            one[vec_id] = (*key, whole)
    out = set()
    for a, (label, _, v) in one.items():
        if a % 50:
            continue
        score = {b: sum(x * y for x, y in zip(v, w)) for b, (_, _, w) in one.items() if b != a}
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if one[b][0] == label][:5]:
            fit = [b for b in order if one[b][0] != label and 50 * score[p] <= 100 * score[b] <= 95 * score[p]]
            out |= {(a, p, k + 1, b, score[p], score[b]) for k, b in enumerate(fit[:3])}
    return out


def run(spark, rows, schema=SCHEMA):
    found = [tuple(r) for r in N.hard_negatives(spark.createDataFrame(rows, schema)).collect()]
    assert len(found) == len(set(found))
    return set(found)


def clusters(n, dim, labels, seed, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    rows = []
    for k in range(n):
        v = middle[rng.integers(centres)] + 0.3 * rng.normal(size=dim)
        rows.append((k, [float(x) for x in v.astype(np.float32)], int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("block,leaf", [(16_384, 4_096), (64, 16)])
def test_against_brute_force(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(TS, "BLOCK", block)
    monkeypatch.setattr(TS, "LEAF_ROWS", leaf)
    monkeypatch.setattr(TS, "SAMPLE", 300)
    rows = clusters(1_500, 6, 4, 1)
    assert run(spark, rows) == brute(rows)


def test_copies_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(TS, "LEAF_ROWS", 8)
    rng = random.Random(5)
    rows = [(k, [float(rng.randrange(3)), float(rng.randrange(2))], rng.randrange(3)) for k in range(300)]  # ties everywhere
    rows += [(k, [1.0, 1.0], 1) for k in range(300, 500)]  # a third are copies
    rows += [(50, [9.0, 9.0], 9), (50, [9.0, 9.0], 9), (100, [1.0], 0), (600, [], 1), (650, [2.0, 1.0, 1.0], 2)]  # repeated ids, other lengths
    rows += [(None, [1.0, 2.0], 1), (700, None, 1), (750, [1.0, 2.0], None), (800, [1.0, None], 1), (850, [float("nan"), 1.0], 1), (900, [float("inf"), 1.0], 1)]
    rows += [(-50, [1.0, 0.5], 1), (950, [-1.0, -1.0], 2)]
    assert run(spark, rows) == brute(rows)


def test_exact_beyond_53_bits(spark):
    rows = [(k, [float(2.0**20 + k), float(3 * k), 1.0], k % 3) for k in range(120)]
    assert run(spark, rows) == brute(rows)
    wide = np.array([[2.0**30, 1.0]])
    assert TS.inner(wide, wide).tolist() == [[2**60 + 1]]
    with pytest.raises(ValueError, match="64 bits"):
        TS.inner(wide * 2**20, wide)
    packed = TS.pack(np.array([2.0**40, -1.0]))
    assert TS.unpack([packed, TS.pack(np.array([7.0]))], 2).tolist() == [[2.0**40, -1.0], [7.0, 0.0]]


def test_no_rows_and_clashing_columns(spark):
    assert run(spark, []) == set()
    assert run(spark, [(50, [1.0], 1)]) == set()
    rows = clusters(200, 4, 3, 2)
    wide = [(*r, "x", 1, b"v") for r in rows]
    assert run(spark, wide, SCHEMA + ", leaf string, block int, v binary") == brute(rows)


def test_scores_of_zero_and_below():
    assert N.score_window(0) == (0, 0) and N.score_window(7) == (4, 6)
    low, high = N.score_window(-7)
    assert low > high


def test_subtrees_are_left_out_and_none_that_holds_an_answer():
    rng = np.random.default_rng(3)
    middle = rng.integers(-300, 300, size=(10, 4))
    rows = (middle[rng.integers(10, size=3_000)] + rng.integers(-8, 8, size=(3_000, 4))).astype(float)
    top = float((rows**2).sum(axis=1).max())
    tree = TS.fit(rows[:500], np.arange(500), np.zeros(500), 40_000, top)
    leaf, found = TS.file_rows(tree, rows)
    ranges = TS.gather_ranges(tree, [(*k, *v) for k, v in found.items()])
    assert tree.leaves > 16
    visited = 0
    for q in rows[::100]:
        scores = rows @ q
        best = float(np.sort(scores)[-6])
        for window in ([(best, np.inf)], [(best * 0.5, best * 0.6), (best * 0.9, best * 0.95)]):
            inside = np.logical_or.reduce([(scores >= a) & (scores <= b) for a, b in window])
            reached = TS.reach(tree, ranges, q, window)
            assert set(leaf[inside]) <= set(reached)
            visited += len(reached)
    assert visited < 0.6 * 2 * 30 * tree.leaves
