"""Collocations of each language: phrases whose words stand together more often than apart.

Two passes over the texts. The first deals the hashes of all n-grams into hash partitions
and keeps a Misra-Gries summary of each, with more counters than the partition's mass
divided by the threshold: every n-gram that is frequent enough survives, whatever the
order of merging. The survivors' hashes go into a bit table of fixed size. The second
pass counts exactly, by their words, the n-grams that the bit table lets through; those
below the threshold go. Scores, nested phrases and ranks are joins and aggregates on the
frequent n-grams alone.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refloom.llm import phrases
from refloom.llm.common import bound_batches
from refloom.session import cut_lineage

#: Occurrences of a candidate, words of a candidate, a list's length.
THRESHOLD = 10
SIZES = (2, 3)
PER_LANGUAGE = 2_000
#: A phrase goes if a longer one around it has this share of its occurrences (percent).
NESTED_SHARE = 50
#: Language of texts that name none.
NO_LANGUAGE = "und"

#: Shares of a language that are ranked apart before the language is.
SHARES = 16
#: Bytes of text a hash partition stands for at most; bounds the n-grams that one task holds.
PART_BYTES = 16_000_000
#: Bits of the table of survivors, all partitions together (each has 64 at least).
TABLE_BITS = 1 << 27
#: Bytes of text that a task gathers by language, and hashes that it holds, before it hands them on.
_GATHERED = 16_000_000
_HELD = 6_000_000


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes, int]]:
    """(language, slice of folded text, words of context) from batches of (lang, text)."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size = 0

    def out() -> Iterator[tuple[str, bytes, int]]:
        for lang, texts in held.items():
            for cut, context in phrases.slices(texts):
                yield lang, cut, context
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = text.as_buffer().to_pybytes()
            held[lang].append(raw)
            size += len(raw) + 64
            if size >= _GATHERED:
                yield from out()
                size = 0
    yield from out()


def _placed(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each key in its partition's table."""
    n = np.uint64(bits)
    return keys % n, ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)) % n


def _parts(size: int) -> int:
    """Leading bits of a hash that name its partition."""
    return (max(1, -(-size // PART_BYTES)) - 1).bit_length()


def _dealt(hashed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Partition and key of each hash; what is sorted stays sorted by both."""
    head = hashed >> np.uint64(64 - bits - phrases.KEY_BITS)
    return head >> np.uint64(phrases.KEY_BITS), head & np.uint64((1 << phrases.KEY_BITS) - 1)


def summaries(texts: DataFrame, bits: int) -> DataFrame:
    """(part, mass, summary): partial summaries of the n-grams of ``texts`` (lang, text), some rows a
    task and partition; a partition is named by the first ``bits`` bits of the hash."""

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        found = np.concatenate(held)
        held.clear()
        found >>= np.uint64(64 - bits - phrases.KEY_BITS)
        found.sort()
        first = phrases.run_starts(found)
        counts = np.diff(first, append=len(found))
        part, low = _dealt(found[first] << np.uint64(64 - bits - phrases.KEY_BITS), bits)
        edges = np.searchsorted(part, np.arange((1 << bits) + 1, dtype=np.uint64))
        rows = [(p, int(counts[a:b].sum()), phrases.pack(low[a:b], counts[a:b])) for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if a < b]
        cols = list(zip(*rows, strict=True)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["part", "mass", "summary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for lang, cut, context in _by_language(batches):
            found = phrases.cut_words(cut, context)
            for hashed, ok in zip(phrases.hashes(found, lang), found.starts, strict=True):
                held.append(hashed[ok])
                size += len(held[-1])
            if size >= _HELD:
                yield packed(held)
                size = 0
        if held:
            yield packed(held)

    kinds = [pa.int64(), pa.int64(), pa.binary()]
    return texts.mapInArrow(run, "part long, mass long, summary binary")


def survivors(partial: DataFrame, threshold: int, bits: int) -> DataFrame:
    """(part, bits): for each hash partition the table of the keys that may occur ``threshold`` times.

    A partition's partial summaries are merged with a capacity above its mass divided by the
    threshold; a key stays if its counter and the summary's error reach the threshold together.
    """

    def merge(rows: pa.Table) -> pa.Table:
        capacity = phrases.capacity_for(sum(rows["mass"].to_pylist()), threshold)
        kept, keys, counts, held = phrases.EMPTY, [], [], 0
        blobs = rows["summary"]
        for k in range(len(blobs)):
            more = phrases.unpack(blobs[k].as_buffer().to_pybytes())
            keys.append(more[0]), counts.append(more[1])
            held += len(more[0])
            if held >= _HELD or k == len(blobs) - 1:
                kept = phrases.merged(kept, phrases.Summary(np.concatenate(keys), np.concatenate(counts), 0), capacity)
                keys, counts, held = [], [], 0
        table = np.zeros(bits, dtype=np.uint8)
        for at in _placed(kept.keys[kept.counts + kept.error >= threshold], bits):
            table[at] = 1
        return pa.table({"part": rows["part"][:1], "bits": pa.array([np.packbits(table, bitorder="little").tobytes()], pa.binary())})

    return partial.groupBy("part").applyInArrow(merge, "part long, bits binary")


def frequent(texts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(lang, size, phrase, n): exact counts of all n-grams of up to three words that occur ``threshold``
    times in their language, and a row of size 0 a language with its number of words."""
    bound_batches(texts.sparkSession)
    part_bits = _parts(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    parts = 1 << part_bits
    bits = max(64, TABLE_BITS // parts // 64 * 64)
    whole = bytearray(parts * bits // 8)
    for r in survivors(summaries(texts, part_bits), threshold, bits).toLocalIterator():
        whole[r.part * bits // 8 : (r.part + 1) * bits // 8] = r.bits
    shared = texts.sparkSession.sparkContext.broadcast(bytes(whole))  # TABLE_BITS, or 8 bytes a partition

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, np.uint8)

        def let_through(hashed: np.ndarray) -> np.ndarray:
            part, low = _dealt(hashed, part_bits)
            ok = np.ones(len(hashed), dtype=bool)
            for at in _placed(low, bits):
                place = part * np.uint64(bits) + at
                ok &= (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            return ok

        for lang, folded, context in _by_language(batches):
            cut = phrases.cut_words(folded, context)
            words = pa.array(cut.words, pa.binary())
            # the number of words stands as the phrase without words
            found, counts, part = [pa.array([b""])], [np.array([cut.starts[0].sum()], np.int64)], [np.zeros(1, np.int64)]
            for size, (hashed, ok) in enumerate(zip(phrases.hashes(cut, lang), cut.starts, strict=True), 1):
                at = np.flatnonzero(ok)
                at = at[let_through(hashed[at])]
                parts, n, first = phrases.counted(cut, size, at)
                said = [words.take(pa.array(parts[:, k])) for k in range(size)]
                found.append(said[0] if size == 1 else pc.binary_join_element_wise(*said, b" "))
                counts.append(n)
                part.append(_dealt(hashed[first], part_bits)[0].astype(np.int64))
            yield _boxed(lang, pa.concat_arrays(found), np.concatenate(counts), np.concatenate(part))

    boxes = texts.mapInArrow(run, _BOX_DDL)

    def opened(rows: pa.Table) -> pa.Table:
        return _opened(rows, threshold)

    return boxes.groupBy("part", "lang").applyInArrow(opened, "lang string, size int, phrase string, n long")


_BOX_DDL = "part long, lang string, phrases binary, counts binary"


def _boxed(lang: str, found: pa.Array, counts: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """One row a partition: its phrases, one a line (none holds a line break), compressed, and their counts."""
    order = np.argsort(part, kind="stable")  # what begins with the same words stays together
    found, counts, part = found.take(pa.array(order)), counts[order], part[order]
    edges = [*phrases.run_starts(part).tolist(), len(part)]
    boxes = [zlib.compress(b"\n".join(found[a:b].to_pylist()), 1) for a, b in zip(edges, edges[1:], strict=False)]
    packed = [phrases.pack_counts(counts[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    return pa.RecordBatch.from_arrays(
        [pa.array(part[edges[:-1]]), pa.array([lang] * len(boxes)), pa.array(boxes, pa.binary()), pa.array(packed, pa.binary())],
        names=["part", "lang", "phrases", "counts"],
    )


def _opened(rows: pa.Table, threshold: int) -> pa.Table:
    """The phrases of one partition and language that occur ``threshold`` times, counted by their words."""
    found, counts = [], []
    for box, packed in zip(rows["phrases"].to_pylist(), rows["counts"].to_pylist(), strict=True):
        said = zlib.decompress(box).split(b"\n")
        found.append(pa.array(said, pa.binary()))
        counts.append(pa.array(phrases.unpack_counts(packed, len(said))))
    total = pa.table({"phrase": pa.chunked_array(found), "n": pa.chunked_array(counts)}).group_by("phrase").aggregate([("n", "sum")])
    bare = pc.equal(total["phrase"], b"")
    total = total.filter(pc.or_(bare, pc.greater_equal(total["n_sum"], threshold)))
    phrase = total["phrase"].cast(pa.string())
    size = pc.if_else(pc.equal(phrase, ""), 0, pc.add(pc.count_substring(phrase, " "), 1)).cast(pa.int32())
    return pa.table({"lang": pa.array([rows["lang"][0].as_py()] * len(phrase), pa.string()), "size": size, "phrase": phrase, "n": total["n_sum"].cast(pa.int64())})


def scored(known: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, size, a, l, r, score) of ``frequent`` n-grams, by their weakest cut."""
    of = known.where("size > 0").select("lang", "phrase", "n")
    cut = F.explode(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        k.alias("k"),
        F.array_join(F.slice("words", 1, k), " ").alias("first"),
        F.array_join(F.slice("words", k + 1, F.col("size") - k), " ").alias("rest"),
    )))
    cuts = (
        known.where(F.col("size").isin(*SIZES))
        .withColumn("words", F.split("phrase", " "))
        .select("lang", "phrase", "size", F.col("n").alias("a"), cut.alias("cut"))
        .select("lang", "phrase", "size", "a", "cut.*")
    )
    cuts = cuts.join(of.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(of.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    score = F.expr("(1000000BD * cast(a as decimal(18)) * cast(a as decimal(18))) div (cast(l as decimal(18)) * cast(r as decimal(18)))")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "size", "a").agg(weakest).select("lang", "phrase", "size", "a", "best.l", "best.r", "best.score")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", threshold: int = THRESHOLD, per_language: int = PER_LANGUAGE
) -> DataFrame:
    """The first ``per_language`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Null texts count as empty, null languages as ``und``; repeated rows count each time; other
    columns are not read. Texts without a phrase of ``threshold`` occurrences, empty ones and
    an empty table give no row. Texts are read whole. Ties go by occurrences, then by phrase.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    known = cut_lineage(frequent(texts, threshold))
    longer = known.where(F.col("size") == max(SIZES)).withColumn("words", F.split("phrase", " "))
    inside = F.explode(F.array_distinct(F.array(*[F.array_join(F.slice("words", k, 2), " ") for k in (1, 2)])))
    around = longer.select("lang", inside.alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    kept = scored(known).join(around, ["lang", "phrase"], "left")
    kept = kept.where((F.col("size") == max(SIZES)) | F.col("around").isNull() | (100 * F.col("around") < NESTED_SHARE * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first of each share of a language, then of the language: no task sorts more than SHARES lists
    some = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= per_language)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= per_language)
    totals = known.where("size = 0").select("lang", F.col("n").alias("words_in_all"))
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words_in_all").alias("n"), "score"
    )
