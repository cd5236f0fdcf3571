"""Collocations: Misra-Gries guarantees, exact counts, the operator against plain loops."""

import random
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from refloom.llm import collocations as C
from refloom.llm import phrases as P

SCHEMA = "doc_id int, text string, lang string"
FOLD = {c: c + 32 for c in range(65, 91)}


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD))]


def brute(rows, threshold=10, per_language=2000):
    total, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            total[lang] += len(ws)
            for size in (1, 2, 3):
                f.update((lang, tuple(ws[k : k + size])) for k in range(len(ws) - size + 1))
    out = []
    for lang in total:
        mine = {p: n for (x, p), n in f.items() if x == lang}
        found = []
        for p, a in mine.items():
            if len(p) < 2 or a < threshold:
                continue
            score, _, left, right = min((1_000_000 * a * a // (mine[p[:k]] * mine[p[k:]]), k, mine[p[:k]], mine[p[k:]]) for k in range(1, len(p)))
            longer = [n for q, n in mine.items() if len(q) == 3 and len(p) == 2 and n >= threshold and p in (q[:2], q[1:])]
            if not any(100 * n >= 50 * a for n in longer):
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:per_language], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def run(spark, rows, schema=SCHEMA, **options):
    return sorted(tuple(r) for r in C.collocations(spark.createDataFrame(rows, schema), **options).collect())


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["Red", "red", "tea", "pot", "of", "the", "é", "Ünder", "x\x1fy", "ﬀ", " a", "日本"] + [f"w{k}" for k in range(25)]
    gaps = [" ", " ", "  ", "\t", ", ", ".", "\n", ";", " ! "]
    return [(k, "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(120))), rng.choice(["en", "en", "de", None, "und", ""])) for k in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_loops(spark, monkeypatch, small):
    if small:  # many partitions, slices and hand-overs
        monkeypatch.setattr(C, "PART_BYTES", 5_000)
        monkeypatch.setattr(C, "_GATHERED", 3_000)
        monkeypatch.setattr(C, "_HELD", 200)
        monkeypatch.setattr(C, "TABLE_BITS", 1 << 12)
    rows = corpus(300, 4)
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, threshold=3, per_language=7) == brute(rows, 3, 7)


def test_null_empty_repeated_and_hot_rows(spark):
    rows = [(None, None, None), (1, "", "en"), (2, "...", "en")] + [(3, "the cat sat", "en")] * 30 + [(4, "A b a b a b a b a b a b a b a b a b a b", None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, rows[:3]) == []
    wide = [(*r, 1, "x") for r in rows]
    assert run(spark, wide, SCHEMA + ", phrase int, n string") == brute(rows)


def test_scores_pass_64_bits(spark):
    big = 3_000_000_000_123
    known = [("en", 0, "", 10**14), ("en", 1, "a", big + 7), ("en", 1, "b", big + 11), ("en", 2, "a b", big)]
    got = C.scored(spark.createDataFrame(known, "lang string, size int, phrase string, n long")).collect()
    assert [r.score for r in got] == [10**6 * big * big // ((big + 7) * (big + 11))] and Decimal(big) ** 2 * 10**6 > 2**64


def sliced(folded, context):
    """Counts of a slice; equal hashes are equal n-grams."""
    cut, out, seen = P.cut_words(folded, context), Counter(), {}
    for size, (hashed, ok) in enumerate(zip(P.hashes(cut, "en"), cut.starts), 1):
        parts, counts, _ = P.counted(cut, size, np.flatnonzero(ok))
        for p, n in zip(parts, counts):
            out[tuple(cut.words[k].decode() for k in p)] += int(n)
        for k in np.flatnonzero(ok):
            gram = tuple(cut.ids[k : k + size])
            assert seen.setdefault(int(hashed[k]), gram) == gram
    return out


@given(st.lists(st.text(alphabet="aB é.\t,\n日", max_size=40), max_size=8))
@settings(max_examples=150, deadline=None)
def test_counts_of_slices(texts):
    want, got = Counter(), Counter()
    for t in texts:
        for ws in pieces(t):
            for size in (1, 2, 3):
                want.update(tuple(ws[k : k + size]) for k in range(len(ws) - size + 1))
    for cut, context in P.slices(t.encode() for t in texts):
        got += sliced(cut, context)
    assert got == want


def test_a_long_text_is_counted_whole(monkeypatch):
    monkeypatch.setattr(P, "BATCH_BYTES", 2_000)
    rng = random.Random(2)
    text = "".join(rng.choice(["aa", "b", "cccc"]) + rng.choice([" ", " ", ". "]) for _ in range(9_000)) + "z" * 5_000
    want, got = Counter(), Counter()
    for ws in pieces(text):
        for size in (1, 2, 3):
            want.update(tuple(ws[k : k + size]) for k in range(len(ws) - size + 1))
    slices = list(P.slices([text.encode()]))
    assert len(slices) > 10
    for cut, context in slices:
        got += sliced(cut, context)
    assert got == want


@given(st.lists(st.lists(st.integers(0, 60), max_size=80), max_size=6), st.integers(1, 12))
@settings(max_examples=200, deadline=None)
def test_every_frequent_key_survives_any_merge(streams, threshold):
    truth = Counter(k for s in streams for k in s)
    capacity = P.capacity_for(sum(truth.values()), threshold)
    parts = []
    for s in streams:
        c = Counter(s)
        parts.append(P.Summary(*P.summed(np.array(s, dtype=np.uint64), np.ones(len(s), dtype=np.int64)), 0))
        assert dict(zip(parts[-1].keys.tolist(), parts[-1].counts.tolist())) == c
    while len(parts) > 1:
        parts.append(P.merged(parts.pop(0), parts.pop(0), capacity))
    last = parts[0] if parts else P.EMPTY
    assert len(last.keys) <= max(capacity, len(truth)) and last.error * (capacity + 1) <= sum(truth.values())
    held = dict(zip(last.keys.tolist(), last.counts.tolist()))
    for k, n in truth.items():
        assert held.get(k, 0) <= n <= held.get(k, 0) + last.error
        assert n < threshold or k in held


@given(st.dictionaries(st.integers(0, (1 << P.KEY_BITS) - 1), st.integers(1, 1 << 40), max_size=50))
@settings(max_examples=100, deadline=None)
def test_packed_summaries_round_trip(counters):
    keys = np.array(sorted(counters), dtype=np.uint64)
    counts = np.array([counters[int(k)] for k in keys], dtype=np.int64)
    back = P.unpack(P.pack(keys, counts))
    assert (back[0] == keys).all() and (back[1] == counts).all()


def test_large_counts_add_up():
    keys, counts = P.summed(np.array([5, 3, 5, 9], dtype=np.uint64), np.array([10**9, 1, 2 * 10**8, 2**40]))
    assert keys.tolist() == [3, 5, 9] and counts.tolist() == [1, 12 * 10**8, 2**40]
