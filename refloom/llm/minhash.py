"""Document fingerprints: one-permutation MinHash, optimal densification, packed low bits.

Every shingle is hashed once; the top bits of the hash are its bin, and each bin keeps
its smallest hash. An empty bin takes over the value of a filled one: each empty bin has
its own fixed random order of all bins and takes the first filled one in it (the
optimal densification: which bin is taken depends on the empty bin alone, so two sets
draw alike). The low bits of each bin are packed into the fingerprint. Equal low bits by
chance are corrected for in the estimate.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refloom.llm.common import SLICE_ROWS, add_from_text, bound_batches, fresh
from refloom.session import cut_lineage

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Shingles held at once; bounds memory for very long texts.
_BLOCK = 1 << 20


def _scramble(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass(frozen=True)
class MinHash:
    """Parameters: ``bins`` (a power of two), ``bits`` kept a bin (1, 2, 4 or 8), words a shingle."""

    bins: int = 512
    bits: int = 4
    shingle: int = 5
    seed: int = 1

    @cached_property
    def _turns(self) -> np.ndarray:
        """For each bin, the place of every bin in its random order."""
        rng = np.random.Generator(np.random.PCG64(self.seed))
        return np.argsort(rng.random((self.bins, self.bins)), axis=1).astype(np.int16)

    def minima(self, words: list[bytes], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """(filled bins, their smallest hashes) of the shingles of ``words``."""
        digest, seed = xxhash.xxh64_intdigest, self.seed
        hashes = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = digest(w, seed)
            hashes.append(h)
        word = np.array(hashes, dtype=np.uint64)
        n = max(1, len(words) - self.shingle + 1)
        found = []
        for at in range(0, n, _BLOCK):
            part = word[at : at + _BLOCK + self.shingle - 1]
            m = min(n - at, _BLOCK)
            h = np.zeros(m, np.uint64)
            for k in range(min(self.shingle, len(words))):  # order counts: mixed in one after the other
                h = _scramble((h + _MIX) ^ part[k : k + m])
            h = np.sort(h)  # the bin is in the top bits, so each bin's smallest comes first
            b = (h >> np.uint64(64 - self.bins.bit_length() + 1)).astype(np.int64)
            first = np.concatenate(([True], b[1:] != b[:-1]))
            found.append((b[first], h[first]))
        if len(found) == 1:
            return found[0]
        b, h = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((h, b))
        b, h = b[order], h[order]
        first = np.concatenate(([True], b[1:] != b[:-1]))
        return b[first], h[first]

    def values(self, text: str, known: dict[bytes, int]) -> np.ndarray | None:
        """The low bits of each bin; None for a text without words."""
        words = text.encode().split()
        if not words:
            return None
        filled, least = self.minima(words, known)
        low = (least & np.uint64((1 << self.bits) - 1)).astype(np.uint8)
        if len(filled) == 1:
            return np.full(self.bins, low[0], np.uint8)
        out = np.empty(self.bins, np.uint8)
        out[filled] = low
        empty = np.ones(self.bins, bool)
        empty[filled] = False
        empty = np.flatnonzero(empty)
        if len(empty):
            out[empty] = low[self._turns[np.ix_(empty, filled)].argmin(axis=1)]
        return out

    def pack(self, values: np.ndarray | None) -> str:
        """Hex digits of the packed bits; the empty string for a text without words."""
        if values is None:
            return ""
        bits = np.unpackbits(values[:, None], axis=1)[:, 8 - self.bits :]
        return np.packbits(bits.ravel()).tobytes().hex()

    def unpack(self, fingerprint: str) -> np.ndarray | None:
        if not fingerprint:
            return None
        bits = np.unpackbits(np.frombuffer(bytes.fromhex(fingerprint), np.uint8)).reshape(-1, self.bits)
        return bits @ (1 << np.arange(self.bits - 1, -1, -1)).astype(np.uint8)

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        """Estimated Jaccard likeness, 0 to 1. Two texts without words are alike, one is not.

        Bins agree with probability J + (1 - J) / 2**bits; solved for J.
        """
        if a is None or b is None:
            return float(a is b)
        chance = 0.5**self.bits
        return min(1.0, max(0.0, (float((a == b).mean()) - chance) / (1 - chance)))


def fingerprints(docs: DataFrame, params: MinHash = MinHash(), *, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` plus ``name``: the fingerprint of each whole text (null: empty), in one pass without a shuffle.

    Equal texts have equal fingerprints, texts without words the empty string. Texts with
    fewer words than a shingle are one shingle. Repeated rows stay; an empty table gives an
    empty result. ``name`` is lengthened where it is taken.
    """
    name = fresh(docs, name)

    def make():
        known: dict[bytes, int] = {}

        def work(texts: list[str]) -> dict:
            if len(known) > 500_000:
                known.clear()
            return {name: [params.pack(params.values(t, known)) for t in texts]}

        return work

    return add_from_text(docs, text, f"`{name}` string", make)


def edited(text: str, following: str) -> str:
    """``text`` whose last third (code points, rounded down) is the first as many of ``following`` (or all)."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _bounds(ids: DataFrame, ranges: int | None) -> np.ndarray:
    """Ids that cut the table into ranges of about equal numbers of rows, ascending."""
    cuts = (math.isqrt(ids.count()) if ranges is None else ranges) - 1
    if cuts < 1:
        return np.zeros(0, np.int64)
    at = [k / (cuts + 1) for k in range(1, cuts + 1)]
    return np.unique(np.array(ids.approxQuantile("doc_id", at, 0.1 / (cuts + 1)), dtype=np.int64))


def successor_likeness(
    docs: DataFrame,
    params: MinHash = MinHash(),
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    ranges: int | None = None,
) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document is the one with the next smaller id (equal ids by text; after the
    smallest comes the largest; null ids are smaller than all). The edited text is
    ``edited(text, next text)``; ``near_*`` are likenesses to the fingerprints of the
    edited and the next text. The table is cut into ``ranges`` of ids (by default the root
    of the number of rows, so ranges and rows a range grow alike), each text is moved
    once, and each range also receives the row that follows its last one. Within a range
    rows stream in order, two texts at a time. A table of one row follows itself; an
    empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounds = _bounds(rows.select("doc_id").dropna(), ranges)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        # range 0 holds the largest ids, so ranges and rows run in the same direction; nulls come last
        known = ids.notna()
        out = np.full(len(ids), len(bounds), np.int32)
        out[known] = len(bounds) - np.searchsorted(bounds, ids[known].astype("int64"), side="left")
        return pd.Series(out)

    placed = rows.withColumn("range", range_of("doc_id"))
    # the first row of each range, by ids alone; then its text. One row a range.
    heads = rows.select("doc_id", range_of("doc_id").alias("range")).groupBy("range").agg(F.max("doc_id").alias("head"))
    heads = cut_lineage(heads)
    order = W.orderBy("range")
    before = F.coalesce(F.lag("range").over(order), F.max("range").over(W.partitionBy()))
    hosts = heads.select("range", "head", before.alias("host"))
    p, h = placed.alias("p"), F.broadcast(hosts).alias("h")
    guests = (
        p.join(h, (F.col("p.range") == F.col("h.range")) & F.col("p.doc_id").eqNullSafe(F.col("h.head")))
        .groupBy("host", "doc_id")
        .agg(F.max("text").alias("text"))
        .select(F.col("host").alias("range"), "doc_id", "text", F.lit(True).alias("guest"))
    )
    every = placed.select("range", "doc_id", "text", F.lit(False).alias("guest")).unionByName(guests)
    every = every.repartition(max(1, len(bounds) + 1), "range").sortWithinPartitions(
        "range", "guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc()
    )
    return _compare_in_order(every, params)


def _compare_in_order(every: DataFrame, params: MinHash) -> DataFrame:
    """Each row of a range (``range, doc_id, text, guest``, in order) against the one after it."""
    schema = T._parse_datatype_string(
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        out: list[tuple] = []
        before = None  # (range, id, text, values) of the row whose next one is to come
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                if len(known) > 500_000:
                    known.clear()
                part = batch.slice(first, SLICE_ROWS)
                for where, i, t, guest in zip(*(part.column(k).to_pylist() for k in range(4))):
                    values = params.values(t, known)
                    if before and before[0] == where:
                        _, own, own_text, own_values = before
                        new = edited(own_text, t)
                        new_values = params.values(new, known)
                        out.append(
                            (
                                own,
                                len(own_text),
                                hashlib.sha256(new.encode()).hexdigest(),
                                params.pack(own_values),
                                params.pack(new_values),
                                params.likeness(own_values, new_values),
                                params.likeness(own_values, values),
                            )
                        )
                    before = None if guest else (where, i, t, values)
                if out:
                    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out = []

    return every.mapInArrow(run, schema)
