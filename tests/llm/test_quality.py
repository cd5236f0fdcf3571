"""Quality rules and classifier: counts against the definition, the chain against all labellings."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest

from refloom.llm import crf, quality_model, quality_rules
from refloom.llm.lines import FEATURES, count, line_matrix, with_neighbours

WORD = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dups += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(marked)


def texts():
    rng = random.Random(3)
    bits = ["a", "b", "c", "É", "x|y", "\n", "\n\n", " ", "\t", "\x0b", "\x1c", "\x85", "w1", "<#>", "b c a", "\r\n"]
    return [None, "", "a", "a b c", "a b c d", "\n \n"] + [" ".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(150)]


def test_counts_follow_the_definition():
    for t in texts():
        c = count(t or "")
        assert (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words) == plain_counts(t), t


def random_chain(rng, lengths, n=3):
    model = crf.Crf(rng.normal(size=n), rng.normal(size=(2, 2)))
    return model, rng.normal(size=(sum(lengths), n))


def all_labellings(model, x):
    odds = x @ model.weights
    for y in itertools.product((0, 1), repeat=len(x)):
        yield y, sum(o for o, v in zip(odds, y) if v) + sum(model.moves[a, b] for a, b in zip(y, y[1:]))


def test_chain_against_all_labellings():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 1, 6, 2, 6])
    model, x = random_chain(rng, lengths)
    p, best = crf.marginals(model, x, lengths), crf.viterbi(model, x, lengths)
    for a, n in zip(np.cumsum(lengths) - lengths, lengths):
        part = list(all_labellings(model, x[a : a + n]))
        weight = np.exp([s for _, s in part])
        for t in range(n):
            assert np.isclose(p[a + t], sum(w for (y, _), w in zip(part, weight) if y[t]) / weight.sum())
        assert tuple(best[a : a + n]) == max(part, key=lambda q: q[1])[0]


def test_training_recovers_a_chain():
    rng = np.random.default_rng(2)
    lengths = np.full(300, 12)
    model = crf.Crf(np.array([1.5, -1.0]), np.array([[1.0, -1.0], [-1.0, 1.0]]))
    x = rng.normal(size=(lengths.sum(), 2))
    labels = np.zeros(len(x), int)
    for a in range(0, len(x), 12):  # draw from the model, line by line
        odds = x[a : a + 12] @ model.weights
        back = crf._backward(odds, model.moves, np.array([12]))
        for t in range(12):
            move = model.moves[labels[a + t - 1], 1] - model.moves[labels[a + t - 1], 0] if t else 0
            labels[a + t] = rng.random() < 1 / (1 + np.exp(-(odds[t] + back[t] + move)))
    found = crf.train(x, labels, lengths, ridge=1e-4, rounds=200)
    stay = found.moves[0, 0] + found.moves[1, 1] - found.moves[0, 1] - found.moves[1, 0]
    assert np.allclose(found.weights, model.weights, atol=0.2) and abs(stay - 4) < 0.6


def test_neighbours_stop_at_text_borders():
    x, _, lengths = line_matrix([count("one line here.\nB"), count(""), count("alone")])
    around = with_neighbours(x, lengths)
    n = len(FEATURES)
    assert lengths.tolist() == [2, 0, 1]
    assert (around[0, n : 2 * n] == 0).all() and (around[0, 2 * n :] == x[1]).all()
    assert (around[1, n : 2 * n] == x[0]).all() and (around[1, 2 * n :] == 0).all() and (around[2, n:] == 0).all()


GOOD = "The words of this line are plain and all of them differ, more or less, as they should."
BAD = ["SHOUTED!! WORDS!! OF!! NO!! USE!! AT!! ALL!!", "th### an%%% or$$$ *** of&&& it### be%%%", "a | b | c | d | e | f | g | h"]


def documents():
    rng = random.Random(5)
    line = lambda: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**5)}" for _ in range(rng.randint(8, 20))) + "."
    rows = []
    for i in range(120):
        good = [line() for _ in range(rng.randint(5, 12))]
        rows.append((i, "\n".join(good), 1))
        rows.append((1000 + i, "\n".join([*good[:2], *(rng.choice(BAD) + f" {rng.randrange(999)}" for _ in range(12))]), 0))
    return rows


def test_rules_keep_content_and_reject_boilerplate(spark):
    rows = documents()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows] + [(None, None, None, 2), (1, "few words", "y", 3)], "doc_id long, text string, quality string, n_words int")
    out = quality_rules.judge(docs)
    assert out.columns[:4] == docs.columns and out.columns[4] == "quality_"
    got = [(r.doc_id, r.text, r.quality_.kept, r.quality_.base_failed) for r in out.collect()]
    kept = {i for i, t, k, _ in got if k}
    assert kept == {i for i, _, good in rows if good}
    assert all(failed for i, t, _, failed in got if t in (None, "few words"))
    left = quality_rules.keep_good(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(kept)
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_classifier_learns_from_document_labels(spark):
    rows = documents()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, ""), (5001, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (1, None, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality_model.fit(docs, labels)
    scored = {r.doc_id: r.score for r in quality_model.score(docs, model).collect()}
    tested = [(scored[i] >= 0.3) == bool(q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(tested) > 20 and np.mean(tested) > 0.95
    assert all(0 <= s <= 1 for s in scored.values()) and scored[5000] == scored[5001] < 0.5


@pytest.mark.parametrize("keep", ["quality = 1", "quality is null", "false"])
def test_classifier_without_two_labels_is_neutral(spark, keep):
    docs = spark.createDataFrame([(i, t) for i, t, _ in documents()[:20]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in documents()[:20]], "doc_id long, quality int").filter(keep)
    model = quality_model.fit(docs, labels)
    assert {r.score for r in quality_model.score(docs, model).collect()} == {0.5}


def test_repeated_ids_do_not_fill_the_samples(spark):
    rows = documents()
    few = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5][:24]
    schema = "doc_id long, text string"
    plain = spark.createDataFrame([r[:2] for r in few], schema).coalesce(1)
    labels = spark.createDataFrame([(i, q) for i, _, q in few], "doc_id long, quality int")
    model = quality_model.fit(plain, labels, sample=12)
    lines = quality_rules.fit_lines(plain, sample=24)
    for i, t, _ in few[:2] + few[-2:]:
        more = spark.createDataFrame([(i, t)] * 500 + [r[:2] for r in few], schema).coalesce(1)
        again = quality_model.fit(more, labels, sample=12)
        assert again.scale == model.scale != (0.0, 0.0) and (again.chain.weights == model.chain.weights).all()
        assert (quality_rules.fit_lines(more, sample=24).weights == lines.weights).all()


def test_long_documents_are_learned_from(spark):
    rows = [(i, "\n".join([t] * 200) if not q else t, q) for i, t, q in documents()]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert all(t.count("\n") > 2 * quality_model.SAMPLE_LINES for _, t, q in rows if not q)
    model = quality_model.fit(docs, spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int"))
    scored = {r.doc_id: r.score for r in quality_model.score(docs, model).collect()}
    assert np.mean([(scored[i] >= 0.3) == bool(q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]) > 0.95
    long = docs.filter("text like '%|%'")
    assert np.abs(quality_rules.fit_lines(long).weights).max() > 0 and np.abs(quality_rules.fit_lines(long.select("text", "doc_id").withColumn("doc_id", long.doc_id * 0)).weights).max() > 0


def test_queries_on_the_tables(spark):
    from refloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rules = QUERIES["op2_quality_rules"](spark, sf).collect()
    assert len(rules) == len(text)
    for r in rules[:150]:
        if len(text[r.doc_id] or "") < 3000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(text[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    clean = [r.kept for r in rules if quality.get(r.doc_id) == 1 and not r.base_failed]
    assert np.mean(clean) > 0.99
    scores = QUERIES["op5_quality_classifier"](spark, sf).collect()
    assert len(scores) == len(text)
    tested = [r.predicted == quality[r.doc_id] for r in scores if r.held_out and r.doc_id in quality]
    assert np.mean(tested) > 0.95 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scores)


def test_shares_of_lines():
    from refloom.llm.quality_rules import line_limit

    rng = random.Random(6)
    for _ in range(300):
        lengths = [rng.randrange(0, 50) for _ in range(rng.randrange(0, 30))]
        most = rng.randrange(1, 600)
        limit = line_limit(lengths, most)
        taken = sum(min(n, limit) for n in lengths)
        assert taken <= max(most, sum(n > 0 for n in lengths))
        if sum(lengths) <= most:
            assert taken == sum(lengths)
        elif limit > 1:
            assert sum(min(n, limit + 1) for n in lengths) > most


def test_long_documents_share_the_sample(spark, monkeypatch):
    from refloom.llm import quality_rules as Q

    monkeypatch.setattr(Q, "MOST_LINES", 90)
    rows = [(k, "\n".join(f"a line of words number {j} in {k}." for j in range(60 if k % 2 else 5))) for k in range(8)]
    found = Q.sampled_lines(spark.createDataFrame(rows, "key long, text string"), "text", 1000)
    assert sorted(r.lines for r in found) == [5] * 4 + [17] * 4
    x, lengths = Q.as_batch(found)
    assert len(x) == lengths.sum() == 88


def test_the_largest_sample_fits_the_driver():
    """``MOST_LINES`` lines are learned from in under 1 GB, for the rules and for the classifier."""
    import tracemalloc

    from refloom.llm import crf, quality_model
    from refloom.llm.lines import FEATURES
    from refloom.llm.quality_rules import MOST_LINES, seed_labels

    rng = np.random.default_rng(1)
    lengths = np.full(MOST_LINES // 100, 100)
    x = (rng.random((MOST_LINES, len(FEATURES))) < 0.2).astype(float)
    good = rng.integers(0, 2, len(lengths))
    tracemalloc.start()
    crf.train(x, seed_labels(x), crf.windows(lengths, 200), rounds=3)
    quality_model.fit_model(x, np.full(MOST_LINES, 9.0), lengths, good, np.ones(len(lengths)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 30


def test_scores_against_a_plain_forward_backward():
    """Whole documents: marginals by summing over all labellings of each, then the weighted mean on the model's scale."""
    from itertools import product

    from refloom.llm import quality_model
    from refloom.llm.lines import count, line_matrix, with_neighbours

    rng = np.random.default_rng(4)
    texts = ["\n".join(" ".join(rng.choice(["good", "WORDS", "#", "x1", "a", "same same"], rng.integers(1, 9))) for _ in range(n)) for n in (1, 2, 5, 8)] + ["", "\n \n"]
    n_features = 3 * len(quality_model.FEATURES)
    chain = quality_model.crf.Crf(rng.normal(size=n_features), rng.normal(size=(2, 2)))
    model = quality_model.QualityModel(chain, (1.7, -0.3), 0.21)
    got = model.scores(texts)
    for text, score in zip(texts, got):
        x, words, lengths = line_matrix([count(text)])
        if not len(x):
            assert score == 0.21
            continue
        odds = with_neighbours(x, lengths) @ chain.weights
        weight, total = np.zeros(len(x)), 0.0
        for labels in product((0, 1), repeat=len(x)):
            p = np.exp(sum(o for o, y in zip(odds, labels) if y) + sum(chain.moves[a, b] for a, b in zip(labels, labels[1:])))
            total += p
            weight += p * np.array(labels)
        mean = float(((weight / total) * words).sum() / words.sum())
        mean = min(max(mean, 1e-3), 1 - 1e-3)
        want = 1 / (1 + np.exp(-(1.7 * np.log(mean / (1 - mean)) - 0.3)))
        assert abs(score - want) < 1e-9
