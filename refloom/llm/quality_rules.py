"""Quality rules: count rules, then content share by Viterbi decoding of the lines.

A linear-chain conditional random field marks each line as content or boilerplate. It is
trained here, on a bounded sample of the documents, from line rules that are right more
often than not (symbols, capitals, repeats, stubs); the chain then settles lines by what
stands around them. A document is kept if enough of its words stand on content lines.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm import crf
from refloom.llm.common import add_from_text, fresh
from refloom.llm.lines import FEATURES, count, line_matrix
from refloom.session import cut_lineage

#: Documents that the line model is fitted on (those whose id has the smallest hash).
SAMPLE_DOCUMENTS = 2_000
#: Lines in a row that a longer document of that sample stands there with (it is judged whole).
SAMPLE_LINES = 1_000
#: Lines of the whole sample, which the driver learns from (some 300 MB): where documents have more, each has its share.
MOST_LINES = 200_000
#: Lines that are boilerplate by rule, where the model learns from.
SEEDS = ("many_symbols", "much_upper", "fewest_distinct", "many_echoes", "repeat", "phrase_repeat", "pipes")
#: Least share of the words on content lines.
CONTENT_SHARE = 0.5


@dataclass(frozen=True)
class Rules:
    """Fixed count rules: a document that breaks one is rejected whatever its lines are."""

    least_words: int = 50
    most_repeat_percent: int = 50


def seed_labels(x: np.ndarray) -> np.ndarray:
    """1 for content, 0 for lines that a seed rule calls boilerplate; stubs need no end mark to be content."""
    at = {n: k for k, n in enumerate(FEATURES)}
    bad = np.zeros(len(x), bool)
    for name in SEEDS:
        bad |= x[:, at[name]] > 0
    bad |= (x[:, at["tiny"]] > 0) & (x[:, at["open_end"]] > 0)
    return (~bad).astype(np.int64)


def one_text(rows: DataFrame, *key: str) -> DataFrame:
    """``key`` and ``text``, one row a key: the text with the smallest hash, chosen before the shuffle."""
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return rows.groupBy(*key).agg(least).select(*key, F.col("least.text").alias("text"))


def drawn_lines(texts: list[str], lengths: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(first, end) of each text's lines to learn from: all, or ``most`` in a row from a place its checksum gives."""
    spans = []
    for text, end, n in zip(texts, np.cumsum(lengths).tolist(), lengths.tolist()):
        first = end - n + (zlib.crc32(text.encode()) % (n - most + 1) if n > most else 0)
        spans.append((first, first + min(n, most)))
    return spans


def sampled_lines(docs: DataFrame, text: str, most_lines: int) -> list:
    """Line features of a bounded sample of documents, as bytes, ordered as the sample is."""

    def make():
        def work(texts: list[str]) -> dict:
            x, _, lengths = line_matrix([count(t) for t in texts])
            spans = drawn_lines(texts, lengths, most_lines)
            return {"lines": [b - a for a, b in spans], "x": [x[a:b].astype(np.uint8).tobytes() for a, b in spans]}

        return work

    out = add_from_text(docs, text, "lines long, x binary", make)
    return collected(out.drop(text), MOST_LINES, x=len(FEATURES))


def line_limit(lengths: list[int], most: int) -> int:
    """Lines a document with which all of them together have at most ``most`` (but one each)."""
    left, n = most, len(lengths)
    for k, length in enumerate(sorted(lengths)):
        if length * (n - k) > left:
            return max(1, left // (n - k))
        left -= length
    return max(lengths, default=0)


def collected(rows: DataFrame, most: int, **widths: int) -> list:
    """The sampled rows on the driver, with ``most`` lines in all: documents with more lines than their
    share allows stand there with their first ones. ``widths`` gives the bytes a line of each column."""
    rows = cut_lineage(rows)
    limit = line_limit([r.lines for r in rows.select("lines").collect()], most)
    cut = {n: F.substring(F.col(n), 1, limit * w) for n, w in widths.items()}
    return rows.withColumns({"lines": F.least("lines", F.lit(limit)).cast("long"), **cut}).collect()


def as_batch(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """(features, lines a document) of collected rows."""
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.uint8).reshape(-1, len(FEATURES)).astype(np.float64)
    return x, np.array([r.lines for r in rows], dtype=np.int64)


def fit_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCUMENTS) -> crf.Crf:
    """The line model, from the ``sample`` documents whose id has the smallest hash. No documents: neutral.

    Of rows that repeat an id the text with the smallest hash is drawn; rows without an id
    are told apart by their texts.
    """
    key = F.when(F.col(doc_id).isNull(), F.xxhash64(text)).otherwise(F.xxhash64(doc_id))
    rows = docs.select(key.alias("key"), F.col(text).alias("text"))
    chosen = rows.select("key").distinct().orderBy("key").limit(sample)
    found = sampled_lines(one_text(rows.join(F.broadcast(chosen), "key", "left_semi"), "key"), "text", SAMPLE_LINES)
    found.sort(key=lambda r: (r.key, r.lines, bytes(r.x)))
    x, lengths = as_batch(found)
    return crf.train(x, seed_labels(x), crf.windows(lengths, 200), ridge=1e-4, rounds=300)


def with_line_counts(docs: DataFrame, model: crf.Crf, text: str, prefix: str) -> DataFrame:
    """``docs`` plus ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, content_words`` after ``prefix``."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words"]

    def make():
        def work(texts: list[str]) -> dict:
            counted = [count(t) for t in texts]
            x, words, lengths = line_matrix(counted)
            content = np.where(crf.viterbi(model, x, lengths) == 1, words, 0)
            ends = np.concatenate(([0], np.cumsum(content))).astype(np.int64)
            upto = np.cumsum(lengths)
            out = {prefix + n: [getattr(c, n) for c in counted] for n in names[:-1]}
            return out | {prefix + names[-1]: ends[upto] - ends[upto - lengths]}

        return work

    return add_from_text(docs, text, ", ".join(f"`{prefix}{n}` long" for n in names), make)


def base_failed(n_words: Column, n_repeat_words: Column, rules: Rules = Rules()) -> Column:
    return (n_words < rules.least_words) | (100 * n_repeat_words > rules.most_repeat_percent * n_words)


def judge(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rules: Rules = Rules(), content_share: float = CONTENT_SHARE
) -> DataFrame:
    """``docs`` plus a struct column ``quality`` (lengthened where taken): the counts, ``base_failed`` and ``kept``.

    Whole texts (null: empty, so rejected for want of words), one pass after the fit, no
    shuffle. Repeated rows are judged alike; an empty table gives an empty result; every
    column of ``docs`` passes through.
    """
    name = fresh(docs, "quality")
    prefix = fresh(docs, "q_") + "_"
    model = fit_lines(docs, doc_id=doc_id, text=text)
    out = with_line_counts(docs, model, text, prefix)
    counts = [c for c in out.columns if c not in docs.columns]
    failed = base_failed(F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words"), rules)
    enough = F.col(f"{prefix}content_words") >= content_share * F.col(f"{prefix}n_words")
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.struct(*[F.col(c).alias(c[len(prefix) :]) for c in counts], failed.alias("base_failed"), (~failed & enough).alias("kept")).alias(name),
    )


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns: null and empty texts go, repeated rows stay
    or go alike, an empty table stays empty."""
    out = judge(docs, **options)
    return out.filter(F.col(f"{out.columns[-1]}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
