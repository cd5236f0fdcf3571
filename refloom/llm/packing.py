"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Tokenizing, ranking and placing are Spark jobs over pieces. The packing itself depends
only on how many pieces there are of each length, at most ``capacity`` numbers whatever
the size of the corpus, so the plan is made from that histogram: each step of it places
a run of equal pieces at once ("pieces of length w, ranks from to, into sequences from s
on, so many each, at this offset"). The plan is joined back on length and rank.
"""

from __future__ import annotations

import bisect
import math
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refloom.llm.common import SLICE_ROWS, bound_batches, kept
from refloom.session import cut_lineage

# --- tokens -----------------------------------------------------------------------------------


class Recent(dict):
    """A dictionary that ``make`` fills and that forgets what was not asked for lately.

    Holds at most twice ``size`` bytes: when it is full it becomes the old generation,
    from which entries come back as they are asked for. An entry counts as its key, its
    value and ``ENTRY`` bytes; one that is larger than ``size`` is not held.
    """

    ENTRY = 150

    def __init__(self, size: int, make: Callable[[str], bytes]):
        super().__init__()
        self.size, self.make, self.old, self.held = size, make, {}, 0

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        took = self.ENTRY + len(key) + len(value)
        if self.held + took > self.size:
            if took > self.size:
                return value
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += took
        self[key] = value
        return value


#: Bytes of words, and of runs of words, that a worker holds in each of two generations.
HELD = 32_000_000


class WordTokenizer:
    """Ids of whole texts by a tokenizers file whose words are encoded one by one.

    The file lower-cases, squeezes white space and splits into words, and each word's ids
    depend on that word alone. So the ids of a word, and of a run of words between white
    space, are looked up and kept while they recur. Texts with characters outside a plain
    Latin set, whose case or class libraries may see differently, and texts that may hold
    special tokens go to the library whole.
    """

    _WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
    _OTHER = re.compile(r"[^\t-\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ſ‐-‧]|<\|")
    #: Marks that stand together as one word (the apostrophe may begin one of its own).
    _MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str, held: int = HELD):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        model, alphabet = self.whole.model, self._alphabet()
        merge = model.tokenize
        if hasattr(model, "_resize_cache"):  # each word comes once: the library need not keep it too
            model._resize_cache(0)

        plain = all(alphabet[c] == chr(c) for c in range(0x21, 0x7F))

        def word_ids(word: str) -> bytes:
            tokens = merge(word if plain and word.isascii() else word.translate(alphabet))
            return pack_ids[len(tokens)](*[t.id for t in tokens]) if len(tokens) < 32 else np.array([t.id for t in tokens], "<u4").tobytes()

        pack_ids = [struct.Struct(f"<{n}I").pack for n in range(32)]
        words = Recent(held, word_ids).__getitem__
        find = self._WORDS.findall

        def run_ids(run: str) -> bytes:
            core = run.rstrip(self._MARKS)
            if core.isalpha():  # letters, and perhaps marks behind them: a word each
                return words(core) + words(run[len(core) :]) if len(core) < len(run) else words(run)
            return b"".join(map(words, find(run)))

        self.runs = Recent(held, run_ids)

    def _alphabet(self) -> dict[int, str]:
        """How the file's pre-tokenizer spells each character of the plain set in bytes."""
        plain = [c for c in map(chr, [*range(0x21, 0x180), *range(0x2010, 0x2028)]) if not self._OTHER.match(c) and not c.isspace()]
        split = self.whole.pre_tokenizer.pre_tokenize_str
        return {ord(c): split(c)[0][0] for c in plain}

    def _bytes(self, text: str) -> bytes:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if self._OTHER.search(text):
            return self._bytes(text)
        return b"".join(map(self.runs.__getitem__, text.lower().split()))


def tokenizer(path: str, held: int = HELD) -> WordTokenizer:
    """One a worker process and file; what it has looked up serves later tasks until another operator runs."""
    return kept(("tokenizer", path, held), lambda: WordTokenizer(path, held))


def token_pieces(docs: DataFrame, path: str, *, doc_id: str, text: str, capacity: int, end_id: int, held: int = HELD) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each text's ids, then ``end_id``, cut every ``capacity`` ids."""
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"]
    schema = T.StructType([kind, *T._parse_datatype_string("piece int, start long, length long, ids_crc32 long").fields])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path, held)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                row, piece, start, length, crc = [], [], [], [], []
                for k, t in enumerate(part.column(1).to_pylist()):
                    ids = encode(t or "") + end
                    for n, first in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[first : first + 4 * capacity]
                        row.append(k)
                        piece.append(n)
                        start.append(first // 4)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row, pa.int64())),
                        pa.array(piece, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return source.mapInArrow(run, schema)


# --- the plan ---------------------------------------------------------------------------------


@dataclass
class Plan:
    """Steps ``(length, rank_from, rank_to, sequence, each, offset)`` that place every piece."""

    capacity: int
    counts: dict[int, int]
    steps: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    placed: dict[int, int] = field(default_factory=dict)

    def put(self, length: int, n: int, sequence: int, each: int, offset: int) -> None:
        rank = self.placed.get(length, 0)
        self.steps.append((length, rank, rank + n, sequence, each, offset))
        self.placed[length] = rank + n
        self.counts[length] -= n

    def fix(self, lengths: list[int], n: int) -> None:
        """``n`` sequences that hold one piece of each of ``lengths``."""
        offset = 0
        for w in lengths:
            self.put(w, n, self.sequences, 1, offset)
            offset += w
        self.sequences += n


def _others(lengths: list[int], counts: dict[int, int], without: int, n: int) -> list[int]:
    """The ``n`` shortest pieces left besides one of length ``without``."""
    found: list[int] = []
    for s in lengths:
        have = counts[s] - (s == without)
        found += [s] * min(have, n - len(found))
        if len(found) == n:
            break
    return found


def reduce_by_dominance(plan: Plan) -> None:
    """Fix the sets that some best packing must hold, up to exchange (Martello and Toth).

    From the longest piece j down, with room r = capacity - j and the longest other piece
    k that fits beside it, a set is fixed when everything that may share a sequence with j
    can be exchanged for what is fixed, without needing more sequences:

    * nothing fits beside j: {j};
    * k fills the room exactly, or no two others fit beside j: {j, k}, since whatever
      stands beside j is no longer than k and can go where k stood;
    * at most two others fit beside j, and no two that do are together longer than k:
      {j, k}, for the same reason;
    * at most two others fit beside j, the longest two that do are k and some b, and no two
      pieces longer than b fit beside j: {j, k, b}, since of any two beside j one is no
      longer than k and the other no longer than b.

    Equal pieces are fixed together. What no rule reaches is left for best fit.
    """
    left = sorted(w for w, n in plan.counts.items() if n)
    for j in left[::-1]:
        while plan.counts[j]:
            left = [w for w in left if plan.counts[w]]
            room = plan.capacity - j
            least = _others(left, plan.counts, j, 3)
            if not least or least[0] > room:
                plan.fix([j], plan.counts[j] if j > room else 1)
                continue
            at = bisect.bisect_right(left, room) - 1
            while plan.counts[left[at]] - (left[at] == j) <= 0:
                at -= 1
            k = left[at]
            one_fits = len(least) < 2 or least[0] + least[1] > room
            two_fit = not one_fits and (len(least) < 3 or sum(least) > room)
            fixed = None
            if k == room or one_fits:
                fixed = [j, k]
            elif two_fit:
                pair = _best_pair(left, plan.counts, j, room)
                b = pair - k
                if b <= 0:
                    fixed = [j, k]
                elif _spare(plan.counts, b, [j, k]) and not _pair_above(left, plan.counts, b, [j, k], room):
                    fixed = [j, k, b]
            if not fixed:
                break
            # with fewer others the conditions still hold, so equal sets are fixed at once
            plan.fix(fixed, min(plan.counts[w] // fixed.count(w) for w in fixed))


def _spare(counts: dict[int, int], length: int, used: list[int]) -> int:
    """Pieces of that length left besides those in ``used``."""
    return counts.get(length, 0) - used.count(length)


def _pair_above(left: list[int], counts: dict[int, int], b: int, used: list[int], room: int) -> bool:
    """Whether two pieces longer than ``b`` besides those in ``used`` fit into ``room``."""
    found: list[int] = []
    for w in left[bisect.bisect_right(left, b) :]:
        found += [w] * min(max(0, _spare(counts, w, used)), 2 - len(found))
        if len(found) == 2:
            break
    return len(found) == 2 and sum(found) <= room


def _best_pair(left: list[int], counts: dict[int, int], j: int, room: int) -> int:
    """The longest that two pieces besides one ``j`` come to within ``room``."""
    best, a, b = 0, 0, bisect.bisect_right(left, room) - 1
    have = lambda w: counts[w] - (w == j)
    while a <= b:
        total = left[a] + left[b]
        if total > room or have(left[b]) <= 0:
            b -= 1
        elif have(left[a]) <= 0 or (a == b and have(left[a]) < 2):
            a += 1
        else:
            best = max(best, total)
            a += 1
    return best


def best_fit(plan: Plan) -> None:
    """Place what is left, longest first, each into the fullest open sequence that has room.

    Sequences with equal room are handled together: the next piece of the same length goes
    where the last one went as long as it fits, so each takes ``room // length`` pieces.
    """
    rooms: list[int] = []  # ascending
    opened: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, how many)

    def add(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in opened:
                opened[room] = []
                bisect.insort(rooms, room)
            opened[room].append((first, n))

    for w in sorted((w for w, n in plan.counts.items() if n), reverse=True):
        while n := plan.counts[w]:
            at = bisect.bisect_left(rooms, w)
            if at < len(rooms):
                room = rooms[at]
                first, many = opened[room].pop()
                if not opened[room]:
                    del opened[room]
                    rooms.pop(at)
            else:
                room, first = plan.capacity, plan.sequences
                many = n // (room // w) or 1  # filled sequences; what is left over opens one more
                plan.sequences += many
            each = min(n, room // w)
            filled = min(many, n // each)
            plan.put(w, filled * each, first, each, plan.capacity - room)
            add(room - each * w, first, filled)
            add(room, first + filled, many - filled)


def make_plan(counts: dict[int, int], capacity: int) -> Plan:
    plan = Plan(capacity, dict(counts))
    reduce_by_dominance(plan)
    best_fit(plan)
    return plan


# --- the operator -----------------------------------------------------------------------------


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 4096,
    end_id: int = 1,
    held: int = HELD,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: every piece and its place.

    Only documents of more than ``capacity`` ids are cut. A null or empty text is the one
    id ``end_id``. Repeated rows are packed as often as they stand. An empty table gives an
    empty result. Pieces of equal length are told apart by a rank that comes from a hash
    of the row: ranges of it are counted first, so no length's pieces meet in one task.
    ``held`` bounds the bytes of words that a worker keeps; it changes the time alone.
    """
    pieces = cut_lineage(token_pieces(docs, tokenizer_path, doc_id=doc_id, text=text, capacity=capacity, end_id=end_id, held=held))
    counts = {int(w): int(n) for w, n in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = make_plan(counts, capacity)
    ranges = max(1, math.isqrt(sum(counts.values())))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(ranges)))
    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    per_part = per_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = W.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.join(per_part, ["length", "part"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    # one row a step of the plan: it depends on the lengths there are, not on the number of pieces
    names = ["length", "rank_from", "rank_to", "first", "each", "base"]
    columns = np.array(plan.steps, dtype=np.int64).reshape(-1, len(names)).T
    steps = pieces.sparkSession.createDataFrame(pa.table([pa.array(c) for c in columns], names=names))
    nth = F.col("rank") - F.col("rank_from")
    return (
        ranked.alias("r")
        .join(
            F.broadcast(steps.alias("s")),
            (F.col("r.length") == F.col("s.length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")),
        )
        .select(
            "doc_id",
            "piece",
            "start",
            F.col("r.length").alias("length"),
            "ids_crc32",
            (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
            (F.col("base") + F.pmod(nth, F.col("each")) * F.col("r.length")).cast("long").alias("offset"),
        )
    )
