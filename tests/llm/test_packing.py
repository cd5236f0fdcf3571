"""Packing: ids against the library, dominance against exact optima, the operator against its own contract."""

import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from refloom.llm.packing import Plan, WordTokenizer, best_fit, make_plan, pack, reduce_by_dominance

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
WORDS = WordTokenizer(PATH)


def ids_of(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x250, exclude_categories=["Cs"]), st.sampled_from("'s'tºª²İıſß–—_\x1c\x85\xa0 ΣΐÁ <|>"))))
def test_ids_are_the_librarys(text):
    assert np.frombuffer(WORDS(text), "<u4").tolist() == ids_of(text)


@pytest.mark.parametrize("text", ["", " ", "<|endoftext|>", "It's 42's ÉTÉ", "x" * 3000, "日本語 ΟΔΟΣ", "a\u0085b c\x1cd"])
def test_ids_of_odd_texts(text):
    assert np.frombuffer(WORDS(text), "<u4").tolist() == ids_of(text)


@lru_cache(None)
def least_bins(lengths, capacity):
    """Exact optimum of a small instance: the longest piece with every subset that fits."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = len(lengths)
    for mask in range(1 << len(rest)):
        chosen = [x for i, x in enumerate(rest) if mask >> i & 1]
        if sum(chosen) + first <= capacity:
            best = min(best, 1 + least_bins(tuple(x for i, x in enumerate(rest) if not mask >> i & 1), capacity))
    return best


def counts_of(lengths):
    return {w: lengths.count(w) for w in set(lengths)}


def test_dominance_keeps_the_optimum():
    rng = random.Random(5)
    for _ in range(120):
        capacity = rng.choice([7, 10, 13])
        lengths = tuple(sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True))
        plan = Plan(capacity, counts_of(lengths))
        reduce_by_dominance(plan)
        rest = tuple(sorted((w for w, n in plan.counts.items() for _ in range(n)), reverse=True))
        assert plan.sequences + least_bins(rest, capacity) == least_bins(lengths, capacity), lengths


def by_hand(lengths, capacity):
    """Best fit, one piece at a time."""
    rooms = []
    for w in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= w]
        if fits:
            rooms[rooms.index(min(fits))] -= w
        else:
            rooms.append(capacity - w)
    return len(rooms)


def test_best_fit_by_runs_is_best_fit_by_pieces():
    rng = random.Random(6)
    for _ in range(200):
        capacity = rng.choice([10, 31, 64])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 80))]
        plan = Plan(capacity, counts_of(lengths))
        best_fit(plan)
        assert plan.sequences == by_hand(lengths, capacity)


def test_plans_place_every_piece_gapless():
    rng = random.Random(7)
    for _ in range(100):
        capacity = rng.choice([8, 31, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        plan = make_plan(counts_of(lengths), capacity)
        bins = {}
        for w, lo, hi, first, each, base in plan.steps:
            for i in range(hi - lo):
                bins.setdefault(first + i // each, []).append((base + i % each * w, w))
        assert sorted(w for b in bins.values() for _, w in b) == sorted(lengths)
        assert set(bins) == set(range(plan.sequences))
        for b in bins.values():
            at = 0
            for offset, w in sorted(b):
                assert offset == at
                at += w
            assert at <= capacity


def check_packed(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= capacity
    return len(bins)


def test_pack_against_the_library(spark):
    texts = ["", None, "one two three", "It's 42", "long words " * 40, "one two three", "é " * 64]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(2, texts[2], "y"), (None, "no id", "z")], "doc_id long, text string, length string")
    rows = pack(docs, PATH, capacity=16).collect()
    check_packed(rows, 16)
    wanted = []
    for r in docs.collect():
        ids = np.array([*ids_of(r.text or ""), 1], "<u4")
        for n, at in enumerate(range(0, len(ids), 16)):
            cut = ids[at : at + 16]
            wanted.append((r.doc_id, n, at, len(cut), zlib.crc32(cut.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(wanted, key=repr)


def test_pack_of_nothing(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_query_packs_whole_table(spark):
    from refloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op7_bestfit_packing"](spark, sf).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    total = 0
    for r in rows:
        ids = np.array([*ids_of(docs[r.doc_id] or ""), 1], "<u4")[r.start : r.start + r.length]
        assert r.start == r.piece * 4096 and len(ids) == r.length
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
        total += r.length
    assert total == sum(len(ids_of(t or "")) + 1 for t in docs.values())
    sequences = check_packed(rows, 4096)
    assert sequences == -(-total // 4096)  # no fewer are possible


def test_triples_are_fixed_and_keep_the_optimum():
    rng, triples = random.Random(9), 0
    for _ in range(400):
        capacity = rng.choice([20, 31])
        lengths = tuple(sorted((rng.randint(capacity // 4, capacity // 2) for _ in range(rng.randint(3, 8))), reverse=True))
        plan = Plan(capacity, counts_of(lengths))
        reduce_by_dominance(plan)
        rest = tuple(sorted((w for w, n in plan.counts.items() for _ in range(n)), reverse=True))
        assert plan.sequences + least_bins(rest, capacity) == least_bins(lengths, capacity), lengths
        held = {}
        for w, lo, hi, first, each, _ in plan.steps:
            for i in range(hi - lo):
                held.setdefault(first + i // each, []).append(w)
        triples += sum(len(h) == 3 for h in held.values())
    assert triples > 50


def test_what_the_reduction_fixes_at_length():
    """Pieces of a third of a sequence and more: most are settled before best fit, and no more sequences are used."""
    rng = random.Random(10)
    lengths = [rng.randint(1366, 2600) for _ in range(3000)]
    plan = Plan(4096, counts_of(lengths))
    reduce_by_dominance(plan)
    fixed = plan.sequences
    best_fit(plan)
    assert fixed > 1000 and plan.sequences <= by_hand(lengths, 4096)
