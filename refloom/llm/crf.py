"""A linear-chain conditional random field with two labels, for many sequences at once.

With two labels a message is one number, the log odds of label 1 against label 0. The
sequences of a batch are ordered by length and advanced together, a position at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Crf:
    """``weights`` of the features for label 1 against 0; ``moves[i, j]`` of label i before j."""

    weights: np.ndarray
    moves: np.ndarray

    @classmethod
    def neutral(cls, n_features: int) -> Crf:
        return cls(np.zeros(n_features), np.zeros((2, 2)))


def _steps(lengths: np.ndarray):
    """Places of the batch's lines by position: yields (position, places), longest sequences first."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    falling = lengths[order]
    for t in range(int(falling[0]) if len(falling) else 0):
        alive = int(np.searchsorted(-falling, -t, side="left"))  # sequences longer than t
        yield t, starts[:alive] + t


def _forward(odds: np.ndarray, moves: np.ndarray, lengths: np.ndarray, add) -> np.ndarray:
    (t00, t01), (t10, t11) = moves
    out = odds.copy()
    for t, at in _steps(lengths):
        if t:
            a = out[at - 1]
            out[at] += add(a + t11, t01) - add(a + t10, t00)
    return out


def _backward(odds: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    (t00, t01), (t10, t11) = moves
    out = np.zeros_like(odds)
    for t, at in reversed(list(_steps(lengths))):
        if t:
            c = odds[at] + out[at]
            out[at - 1] = np.logaddexp(c + t11, t10) - np.logaddexp(c + t01, t00)
    return out


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -500, 500)))


def marginals(crf: Crf, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probability of label 1 at each line, by the forward-backward algorithm."""
    odds = x @ crf.weights
    return _sigmoid(_forward(odds, crf.moves, lengths, np.logaddexp) + _backward(odds, crf.moves, lengths))


def viterbi(crf: Crf, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The most likely labels; ties go to label 1."""
    (t00, t01), (t10, t11) = crf.moves
    best = _forward(x @ crf.weights, crf.moves, lengths, np.maximum)
    labels = (best >= 0).astype(np.int64)
    for t, at in reversed(list(_steps(lengths))):
        if t:
            before = best[at - 1]
            labels[at - 1] = np.where(labels[at] == 1, before + t11 >= t01, before + t10 >= t00)
    return labels


def train(
    x: np.ndarray,
    labels: np.ndarray,
    lengths: np.ndarray,
    weight: np.ndarray | None = None,
    *,
    ridge: float = 1e-3,
    rounds: int = 80,
    rate: float = 0.1,
) -> Crf:
    """Maximum likelihood with a ridge, by Adam on the whole sample; ``weight`` a sequence."""
    crf = Crf.neutral(x.shape[1])
    if not len(x):
        return crf
    per_line = np.repeat(np.ones(len(lengths)) if weight is None else weight, lengths)
    total = per_line.sum()
    inner = np.ones(len(x), bool)  # lines with one before them
    inner[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    here = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[here - 1], labels[here]), per_line[here])
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        weights, moves = theta[:-4], theta[-4:].reshape(2, 2)
        odds = x @ weights
        a, b = _forward(odds, moves, lengths, np.logaddexp), _backward(odds, moves, lengths)
        p = _sigmoid(a + b)
        before, c = a[here - 1], (odds + b)[here]
        logits = np.stack([moves[0, 0] + 0 * c, moves[0, 1] + c, before + moves[1, 0], before + moves[1, 1] + c])
        pair = np.exp(logits - logits.max(axis=0))
        expected = (pair / pair.sum(axis=0) * per_line[here]).sum(axis=1)
        gradient = np.concatenate([x.T @ (per_line * (labels - p)), seen.ravel() - expected]) / total - ridge * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Crf(theta[:-4], theta[-4:].reshape(2, 2))


def windows(lengths: np.ndarray, most: int) -> np.ndarray:
    """``lengths`` with sequences longer than ``most`` cut into pieces, for training only."""
    out: list[int] = []
    for n in lengths.tolist():
        out += [most] * (n // most) + ([n % most] if n % most else [])
    return np.array(out, dtype=np.int64)
