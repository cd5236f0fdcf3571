"""Quality classifier: a linear-chain CRF over lines, learned from labels of whole documents.

Only documents are labelled, and a bad one has good lines too. So lines first take their
document's label, a line classifier is fitted, and in bad documents only the lines that
it finds bad keep that label (at least the worst one). The chain is trained on those.
A document's quality is the mean of its lines' forward-backward marginals weighted by
their words, put on the scale of a probability by a one-variable logistic regression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm import crf
from refloom.llm.common import add_from_text, fresh
from refloom.llm.lines import FEATURES, count, line_matrix, with_neighbours
from refloom.llm.pii import fit_classifier
from refloom.llm.quality_rules import MOST_LINES, SAMPLE_LINES, as_batch, collected, drawn_lines, one_text

#: Labelled documents of each label that the model is fitted on (those with the smallest hash).
SAMPLE_A_LABEL = 2_500


@dataclass(frozen=True)
class QualityModel:
    chain: crf.Crf
    scale: tuple[float, float]  # logistic regression on the log odds of the mean marginal
    empty: float  # score of a text without words

    def scores(self, texts: list[str]) -> np.ndarray:
        x, words, lengths = line_matrix([count(t) for t in texts])
        return self.of_lines(x, words, lengths)

    def of_lines(self, x: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        good = crf.marginals(self.chain, with_neighbours(x, lengths), lengths)
        mean = weighted_means(good, words, lengths)
        a, b = self.scale
        score = 1 / (1 + np.exp(-np.clip(a * log_odds(mean) + b, -500, 500)))
        return np.where(lengths > 0, score, self.empty)


def weighted_means(values: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Mean a text, weighted by words; 0.5 for a text without lines."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    total = np.bincount(owner, weights=words, minlength=len(lengths))
    return np.where(total > 0, np.bincount(owner, weights=values * words, minlength=len(lengths)) / np.maximum(total, 1), 0.5)


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p) - np.log1p(-p)


def line_labels(x: np.ndarray, lengths: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Labels of lines from labels of documents: 0 only for lines of bad documents that look bad."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    target = good[owner].astype(float)
    share = np.where(target > 0, 0.5 / max(target.sum(), 1), 0.5 / max((1 - target).sum(), 1))
    looks = x @ fit_classifier(x, target, share * len(x))
    labels = np.where((target == 0) & (looks < 0), 0, 1)
    ends = np.cumsum(lengths)
    for k in np.flatnonzero((good == 0) & (lengths > 0)):
        lines = slice(ends[k] - lengths[k], ends[k])
        if labels[lines].all():
            labels[ends[k] - lengths[k] + int(looks[lines].argmin())] = 0
    return labels


def fit_model(x: np.ndarray, words: np.ndarray, lengths: np.ndarray, good: np.ndarray, weight: np.ndarray) -> QualityModel:
    """The model from line features, words a line, lines a document, document labels and weights."""
    if not len(lengths) or good.min() == good.max():
        return QualityModel(crf.Crf.neutral(3 * len(FEATURES)), (0.0, 0.0), 0.5)
    around = with_neighbours(x, lengths)
    labels = line_labels(around, lengths, good)
    # long documents are cut for training: what a line sees of its neighbours stays as it is
    chain = crf.train(around, labels, crf.windows(lengths, 200))
    has = lengths > 0
    mean = weighted_means(crf.marginals(chain, around, lengths), words, lengths)
    design = np.stack([log_odds(mean), np.ones(len(mean))], axis=1)
    a, b = fit_classifier(design[has], good[has].astype(float), weight[has])
    bare = weight[~has]
    empty = (float((bare * good[~has]).sum()) + 0.1) / (float(bare.sum()) + 1.0)  # without examples: rather bad
    return QualityModel(chain, (max(float(a), 0.0), float(b)), empty)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 0 when divided by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE_A_LABEL) -> QualityModel:
    """The model from up to ``sample`` labelled documents of either label that are not held out.

    A document with several labels has the commoner one (a tie: 1); null labels say nothing.
    Of rows that repeat an id the text with the smallest hash is drawn; of a document with
    more than ``SAMPLE_LINES`` lines that many in a row, and of all together ``MOST_LINES``.
    """
    known = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
        .dropna()
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("good"))
    )
    sizes = {r.good: r["count"] for r in known.groupBy("good").count().collect()}
    first = lambda g: known.filter(F.col("good") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = F.broadcast(first(0).unionByName(first(1)))  # at most two samples of (id, label)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(chosen, "doc_id")
    found = sampled_lines_and_words(one_text(rows, "doc_id", "good"))
    found.sort(key=lambda r: (r.doc_id, r.lines, bytes(r.x)))
    if not found:
        return fit_model(np.zeros((0, len(FEATURES))), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    x, lengths = as_batch(found)
    words = np.concatenate([np.frombuffer(bytes(r.words), "<i4") for r in found]).astype(float)
    good = np.array([r.good for r in found])
    drawn = np.bincount(good, minlength=2)
    weight = np.array([sizes[g] / drawn[g] for g in good])
    return fit_model(x, words, lengths, good, weight * len(good) / weight.sum())


def sampled_lines_and_words(rows: DataFrame) -> list:
    """Line features and words a line of a bounded sample (``doc_id, good, text``)."""

    def make():
        def work(texts: list[str]) -> dict:
            x, words, lengths = line_matrix([count(t) for t in texts])
            spans = drawn_lines(texts, lengths, SAMPLE_LINES)
            return {
                "lines": [b - a for a, b in spans],
                "x": [x[a:b].astype(np.uint8).tobytes() for a, b in spans],
                "words": [words[a:b].astype("<i4").tobytes() for a, b in spans],
            }

        return work

    out = add_from_text(rows.select("doc_id", "good", "text"), "text", "lines long, x binary, words binary", make)
    return collected(out.drop("text"), MOST_LINES, x=len(FEATURES), words=4)


def score(docs: DataFrame, model: QualityModel, *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` plus ``name`` (lengthened where taken): quality from 0 to 1 of each whole text.

    Null texts are empty; texts without words get the model's own score for them. One pass
    without a shuffle; repeated rows score alike; an empty table gives an empty result.
    """
    name = fresh(docs, name)

    def make():
        return lambda texts: {name: model.scores(texts)}

    return add_from_text(docs, text, f"`{name}` double", make)
