"""What the line models see: counts of a text and features of its lines.

Words are runs of characters other than space and U+0009 to U+000D; as UTF-8 bytes that
is exactly what ``bytes.split()`` gives. Lines are split at ``\\n``; those without a word
are not part of the sequence.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np

SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_ENDS = (b".", b"!", b"?", b":", b";", b'"', b"'", b")", b"\xe2\x80\xa6", b"\xe2\x80\x9d", b"\xc2\xbb")

FEATURES = (
    "bias symbols some_symbols many_symbols upper much_upper few_distinct fewer_distinct fewest_distinct echoes many_echoes "
    "tiny short long open_end digits repeat phrase_repeat short_words long_words pipes"
).split()


def repeated_words(words: list[bytes]) -> np.ndarray:
    """For each word whether it is in a window of three words found twice or more in the text."""
    n = len(words)
    marked = np.zeros(n, bool)
    if n < 4:
        return marked
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:  # three would not fit into 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1].ravel()
    windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marked[:-2] |= twice
    marked[1:-1] |= twice
    marked[2:] |= twice
    return marked


@dataclass
class Counted:
    """Counts of one text, and one row of raw line statistics for each line with a word."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lines: list[tuple]


def count(text: str) -> Counted:
    raw = text.encode()
    seen: set[bytes] = set()
    rows, words = [], []
    dups = 0
    for line in raw.split(b"\n"):
        own = line.split()
        if not own:
            continue
        again = line in seen
        seen.add(line)
        dups += again
        size = len(line)
        rows.append(
            (
                len(own),
                size,
                size - len(line.translate(None, SYMBOLS)),
                size - len(line.translate(None, _UPPER)),
                size - len(line.translate(None, _LOWER)),
                size - len(line.translate(None, _DIGITS)),
                len(set(own)),
                sum(map(eq, own, own[1:])),
                own[-1].endswith(_ENDS),
                again,
                line.count(b"|"),
                len(words),
            )
        )
        words += own
    marked = repeated_words(words)
    return Counted(
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, _SPACE))),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        dups,
        int(marked.sum()),
        [(*r, int(marked[r[-1] : r[-1] + r[0]].sum())) for r in rows],
    )


def line_matrix(counted: list[Counted]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features 0/1 a line, words a line, lines a text) of some texts, their lines in one run."""
    lengths = np.array([len(c.lines) for c in counted], dtype=np.int64)
    raw = np.array([r for c in counted for r in c.lines], dtype=np.float64).reshape(-1, 13)
    n, size, symbols, upper, lower, digits, distinct, echoes, ended, again, pipes, _, phrase = raw.T
    letters = np.maximum(upper + lower, 1)
    enough = n >= 5
    x = np.stack(
        [
            np.ones(len(n)),
            symbols > 0,
            symbols > 0.3 * n,
            symbols > 0.8 * n,
            upper > 0.3 * letters,
            upper > 0.7 * letters,
            enough & (distinct < 0.7 * n),
            enough & (distinct < 0.5 * n),
            enough & (distinct < 0.3 * n),
            enough & (echoes > 0.1 * n),
            enough & (echoes > 0.4 * n),
            n <= 3,
            n <= 8,
            n >= 40,
            ended == 0,
            digits > 0.2 * size,
            again > 0,
            phrase > 0.5 * n,
            size < 3.5 * n,
            size > 12 * n,
            pipes > 0.2 * n,
        ],
        axis=1,
    ).astype(np.float64)
    return x, n, lengths


def with_neighbours(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``x`` beside the features of the line before and the line after (zeros where there is none)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[lengths > 0]
    before[starts] = 0
    after[ends[lengths > 0] - 1] = 0
    return np.concatenate([x, before, after], axis=1)
