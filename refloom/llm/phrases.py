"""N-gram counting within pieces of texts, one batch of text at a time.

Words of a batch are numbered, so an n-gram of up to three words is one 63-bit number and
counting is sorting numbers: counts are exact and tell all n-grams apart. For other tasks
to find the same n-gram, it has a 64-bit hash made of its words' hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import xxhash

#: Longest n-gram; with ``BATCH_BYTES`` it bounds the numbers of n-grams to 63 bits.
LONGEST = 3
#: Bytes of text counted at once. All but some 66,000 words take four bytes with their gap, so a batch has
#: under 2**21 different words.
BATCH_BYTES = 8_000_000

#: No UTF-8 text holds this byte: it stands for the end of a piece.
_END = b"\xff"
_TO = bytearray(range(256))
_TO[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
_TO[ord("\t")] = ord(" ")
for _b in b".,;:!?\n\x0b\x0c\r":
    _TO[_b] = _END[0]
_TABLE = bytes(_TO)
_GAP = re.compile(rb"[ \xff]")


def slices(texts: Iterable[bytes]) -> Iterator[tuple[bytes, int]]:
    """Whole texts (UTF-8) as folded bytes in slices of about ``BATCH_BYTES``, cut at gaps between words, and
    how many of a slice's first words stood at the end of the one before (they give context only)."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.translate(_TABLE)
        if size + len(raw) > BATCH_BYTES and held:
            yield _END.join(held), 0
            held, size = [], 0
        if len(raw) <= BATCH_BYTES:
            held.append(raw)
            size += len(raw) + 1
            continue
        start, context = 0, []
        while start < len(raw):
            gap = _GAP.search(raw, start + BATCH_BYTES - 1024) if start + BATCH_BYTES < len(raw) else None
            end = gap.start() if gap else len(raw)
            part = raw[start:end]
            yield b" ".join([*context, part]), len(context)
            context = [*context, *tokens(part)][-(LONGEST - 1) :]
            start = end
    if held:
        yield _END.join(held), 0


def tokens(folded: bytes) -> list[bytes]:
    """Words and ends of pieces, in order."""
    return folded.replace(_END, b" \xff ").split()


class Slice(NamedTuple):
    """The words of a slice, their numbers in order (ends of pieces among them), and for each size
    from one word on whether an n-gram starts at a place."""

    words: list[bytes]
    ids: np.ndarray
    starts: list[np.ndarray]


def cut_words(folded: bytes, context: int = 0) -> Slice:
    """A slice as numbers. N-grams that lie within its first ``context`` words do not count."""
    found = tokens(folded)
    words = list(dict.fromkeys(found))
    number = {w: k for k, w in enumerate(words)}
    ids = np.fromiter(map(number.__getitem__, found), dtype=np.int64, count=len(found))
    whole = ids != number.get(_END, -1)
    starts = [whole]
    for size in range(2, LONGEST + 1):
        starts.append(starts[-1][: max(0, len(ids) - size + 1)] & whole[size - 1 :])
    # an n-gram that starts at k ends at k + size - 1; it counts where that is behind the context
    for size, ok in enumerate(starts, 1):
        ok[: max(0, context - size + 1)] = False
    return Slice(words, ids, starts)


def counted(cut: Slice, size: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different n-grams of ``size`` words that start at the places ``at``: word numbers (a column a word), how
    often each occurs, and a place of it."""
    base = max(1, len(cut.words))
    key = cut.ids[at]
    for place in range(1, size):
        key = key * base + cut.ids[at + place]
    order = np.argsort(key)
    starts = run_starts(key[order])
    got, counts, first = key[order[starts]], np.diff(starts, append=len(key)), at[order[starts]]
    parts = np.empty((len(got), size), dtype=np.int64)
    for place in range(size - 1, -1, -1):
        got, parts[:, place] = np.divmod(got, base)
    return parts, counts, first


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def hashes(cut: Slice, lang: str) -> list[np.ndarray]:
    """64-bit hashes of what starts at each place, one array a size, the same in every task."""
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
    of_word = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in cut.words), dtype=np.uint64, count=len(cut.words))
    single = of_word[cut.ids]
    out = [single]
    for size in range(2, LONGEST + 1):
        n = max(0, len(single) - size + 1)
        out.append(_mixed(out[-1][:n] * _MIX + single[size - 1 :]))
    return out


# --- Misra-Gries summaries ------------------------------------------------------------------------


class Summary(NamedTuple):
    """Counters of one hash partition (keys of ``KEY_BITS`` bits). A key's count lies between its counter and that plus ``error``
    (a key without a counter: between 0 and ``error``)."""

    keys: np.ndarray  # uint64, ascending
    counts: np.ndarray
    error: int


#: Bits of a hash that a key keeps; n-grams of a partition that agree in them are counted as one (which can
#: only let more of them through).
KEY_BITS = 32

EMPTY = Summary(np.empty(0, np.uint64), np.empty(0, np.int64), 0)


#: A key and a count share 64 bits while they are sorted; larger counts are split.
_COUNT_BITS = 64 - KEY_BITS
_MOST = (1 << _COUNT_BITS) - 1


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, with their counts added up."""
    while len(large := np.flatnonzero(counts > _MOST)):
        keys, counts = np.concatenate([keys, keys[large]]), np.concatenate([counts, counts[large] - _MOST])
        counts[large] = _MOST
    both = (keys << np.uint64(_COUNT_BITS)) | counts.astype(np.uint64)
    both.sort()
    keys = both >> np.uint64(_COUNT_BITS)
    first = run_starts(keys)
    if not len(first):
        return keys, np.empty(0, np.int64)
    return keys[first], np.add.reduceat((both & np.uint64(_MOST)).astype(np.int64), first)


def run_starts(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal numbers begin."""
    if not len(ordered):
        return np.empty(0, np.int64)
    new = np.empty(len(ordered), dtype=bool)
    new[0] = True
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def merged(a: Summary, b: Summary, capacity: int) -> Summary:
    """Counters added up, then lowered by the (capacity + 1)-th largest where there are more than ``capacity``.

    Each unit that lowers the counters takes more than ``capacity`` units of mass away, so the
    error of summaries of mass m in all stays at most m / (capacity + 1), however they are merged.
    """
    keys, counts = summed(np.concatenate([a.keys, b.keys]), np.concatenate([a.counts, b.counts]))
    if len(keys) <= capacity:
        return Summary(keys, counts, a.error + b.error)
    less = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    kept = counts > less
    return Summary(keys[kept], counts[kept] - less, a.error + b.error + less)


def capacity_for(mass: int, threshold: int) -> int:
    """Counters enough that the error stays below ``threshold``."""
    return mass // threshold + 1


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Counters as bytes: gaps between ascending keys as planes of bytes (high planes are mostly zero), then counts."""
    gaps = np.diff(keys.astype(np.uint64), prepend=np.uint64(0))
    planes = np.ascontiguousarray(gaps.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8]
    return np.array([len(keys)], "<u4").tobytes() + np.ascontiguousarray(planes.T).tobytes() + pack_counts(counts)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width = int(np.frombuffer(blob, "<u4", 1)[0]), KEY_BITS // 8
    planes = np.zeros((n, 8), dtype=np.uint8)
    planes[:, :width] = np.frombuffer(blob, np.uint8, n * width, 4).reshape(width, n).T
    return np.cumsum(planes.view("<u8").ravel(), dtype=np.uint64), unpack_counts(blob[4 + n * width :], n)


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte a count, larger ones behind them in eight."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def unpack_counts(blob: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(blob, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(blob, "<i8", offset=n)
    return counts
