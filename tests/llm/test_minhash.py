"""MinHash fingerprints: estimates against exact Jaccard likeness, the operator against a plain loop."""

import hashlib
import random

import numpy as np
import pytest

from refloom.llm.minhash import MinHash, edited, fingerprints, successor_likeness


def shingles(text, n=5):
    words = (text or "").encode().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a or b else 1.0


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_packing_round_trip(bits):
    m = MinHash(bins=64, bits=bits)
    v = m.values("some words that fill a few of the bins " * 3, {})
    assert (m.unpack(m.pack(v)) == v).all() and len(m.pack(v)) == 64 * bits // 4
    assert m.pack(None) == "" and m.unpack("") is None


@pytest.mark.parametrize("size", [20, 200, 3000])
def test_estimates_are_unbiased(size):
    rng, m, known, errors = random.Random(size), MinHash(), {}, []
    for k in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        other = list(words)
        cut = rng.randrange(size)
        other[cut:] = [f"v{rng.randrange(10**6)}" for _ in other[cut:]]
        a, b = " ".join(words), " ".join(other)
        errors.append(m.likeness(m.values(a, known), m.values(b, known)) - jaccard(a, b))
    bound = {20: 0.16, 200: 0.06, 3000: 0.03}[size]  # few shingles: the exact likeness itself is coarse
    assert abs(np.mean(errors)) < bound / 3 and np.sqrt(np.mean(np.square(errors))) < bound


def test_blocks_do_not_matter(monkeypatch):
    text = " ".join(f"w{i * i % 7919}" for i in range(5000))
    whole = MinHash().values(text, {})
    monkeypatch.setattr("refloom.llm.minhash._BLOCK", 64)
    assert (MinHash().values(text, {}) == whole).all()


def test_unlike_and_small_texts():
    m, known = MinHash(), {}
    v = lambda t: m.values(t, known)
    assert m.likeness(v("a b c d e f g"), v("a b c d e f g")) == 1.0
    assert m.likeness(v("a"), v("b")) < 0.2 and m.likeness(v("a b"), v("b a")) < 0.2
    assert m.likeness(None, None) == 1.0 and m.likeness(None, v("a")) == 0.0


def test_edited_counts_code_points():
    assert edited("abcdefgh", "XYZ") == "abcdefXY" and edited("ééé", "") == "éé" and edited("ab", "X") == "ab" and edited("", "X") == ""


def plain(rows):
    m, known = MinHash(), {}
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        e = edited(t, after)
        a, b, c = (m.values(x, known) for x in (t, e, after))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), m.pack(a), m.pack(b), m.likeness(a, b), m.likeness(a, c)))
    return sorted(out, key=repr)


def odd_rows():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(50)] + ["é", "ß\n", "\t"]
    rows = [(i * 3, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(57)]
    return rows + [(7, None), (8, ""), (8, "x"), (8, "x"), (None, "no id"), (-4, "long " * 30_000), (10**12, "far away and on its own here")]


@pytest.mark.parametrize("ranges", [1, 2, 9, 64, None])
def test_successors_across_ranges(spark, ranges):
    rows = odd_rows()
    docs = spark.createDataFrame([(i, t, -1) for i, t in rows], "doc_id long, text string, range int")
    got = successor_likeness(docs, ranges=ranges).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert [tuple(r) for r in successor_likeness(one).collect()] == plain([(1, "a b c d e f")])
    assert successor_likeness(one.limit(0)).count() == 0 and fingerprints(one.limit(0)).count() == 0
    assert fingerprints(one).first().fingerprint == plain([(1, "a b c d e f")])[0][3]


def test_query_against_plain_loop(spark):
    from refloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = QUERIES["op4_fingerprints"](spark, sf).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
    assert sorted(map(tuple, out.collect()), key=repr) == plain(rows)
    text = dict(rows)
    order = sorted(text, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    errors = [r.near_edited - jaccard(text[r.doc_id], edited(text[r.doc_id], text[after[r.doc_id]])) for r in out.collect() if len(text[r.doc_id]) > 600]
    assert np.sqrt(np.mean(np.square(errors))) < 0.06
