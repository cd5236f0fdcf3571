"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets.

DataFrame functions only. No window or aggregate ever holds a whole source: rows are
dealt over about sqrt(rows) ranges of a hash-random key, each range is summed before
the shuffle, and the running sum inside a source is (sum of the earlier ranges) +
(running sum inside the range).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from refloom.llm.common import WORD, fresh, row_key, small
from refloom.session import cut_lineage

#: Hex digits of the key that are split into ranges.
_DIGITS = 8


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """One row a source: ``source, source_size, target``.

    ``sizes`` has ``source, source_size``. Sources in code point order (null last) weigh
    ``weights`` in turn and share the total. A target stops at ``max_epochs`` times its
    source's size; the excess goes to the others by weight until none is above. That is
    water filling: in the order of cap / weight the stopped sources come first, so one
    ordered pass finds the level. The table has one row a source, so ordering it is small.
    """
    by_name, by_ratio = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    to_here = by_ratio.rowsBetween(W.unboundedPreceding, 0)
    every = W.partitionBy()
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    return (
        sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long"))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("total_weight", F.sum("weight").over(every))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.col("total_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "over", (F.col("cap") * F.col("weight_left") < (F.col("total") - F.col("cap_before")) * F.col("weight")).cast("int")
        )
        .withColumn("stopped", F.min("over").over(to_here))
        .withColumn("left", F.col("total") - F.sum(F.col("cap") * F.col("stopped")).over(every))
        .withColumn("free_weight", F.sum(F.col("weight") * (1 - F.col("stopped"))).over(every))
        .select(
            "source",
            "source_size",
            F.when(F.col("stopped") == 1, F.col("cap").cast("double"))
            .otherwise((F.col("left") * F.col("weight")).cast("double") / F.col("free_weight").cast("double"))
            .alias("target"),
        )
    )


def _key(doc_id: Column, size: Column, seed: str) -> Column:
    """The hash-random key that a source's documents are ordered by."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), size.cast("string"))
    return F.md5(said.cast("binary"))


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = (1, 2, 3),
    max_epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: one row a row of ``docs``.

    ``size`` is the number of words (null text: 0). A source's budget is its target,
    rounded down: so many whole epochs over all its documents, then its documents in
    hash-random order until the budget is used up; the last one is cut, so the taken
    words of a source are its budget exactly. ``taken`` counts repeats.

    Null sources are a source of their own. Empty texts take nothing. Repeated rows are
    separate rows (ties in the key are ordered by id and size, so equal rows are
    interchangeable). An empty table gives an empty result. The order depends on the id,
    the size and ``seed`` alone, so reruns agree.
    """
    columns = [F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")]
    return _taken(docs.select(*columns), weights, max_epochs, seed)


def _taken(rows: DataFrame, weights: Sequence[int], max_epochs: int, seed: str) -> DataFrame:
    """The mix of ``doc_id, source, size`` and further columns, which order ties and stay in the result."""
    further = [c for c in rows.columns if c not in ("doc_id", "source", "size")]
    key = _key(F.col("doc_id"), F.col("size"), seed)
    # the texts are read once; what follows works on a few numbers a document
    rows = cut_lineage(rows.withColumn("key", key))
    ranges = max(1, math.isqrt(rows.count()))
    first = F.conv(F.substring("key", 1, _DIGITS), 16, 10).cast("long")
    rows = rows.withColumn("part", F.floor(first * ranges / F.lit(16**_DIGITS)).cast("long"))

    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    targets = source_targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("source", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words_before"))
    plan = parts.alias("p").join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))).select(
        "p.source", "p.part", "words_before", "source_size", "target"
    )
    inside = W.partitionBy("r.source", "r.part").orderBy("key", "doc_id", "size", *further).rowsBetween(W.unboundedPreceding, -1)
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("words_before") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    return (
        rows.alias("r")
        .join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.part") == F.col("p.part")))
        .select(
            "doc_id",
            F.col("r.source").alias("source"),
            "size",
            *further,
            "source_size",
            "target",
            (epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))).alias("taken"),
        )
    )


def mixed_documents(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = (1, 2, 3),
    max_epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a document stands as often as its words are taken.

    Whole documents only: the one cut at its source's budget stays if at least half of
    it is taken. Documents without words (null or empty texts) take nothing and go. Rows are
    ordered by all their columns, so rows without an id, and unlike rows that repeat one, each
    have their own share; rows alike in every column stand together as often as the mix gives
    them one by one. Null sources are a source of their own; an empty table stays empty.

    A source's documents in hash-random order are taken once more than its whole epochs up to
    one document, the cut. So texts stay where they are: each document is compared with the
    cut of its source, one row a source.
    """
    n, size, key, row = (fresh(docs, c) for c in ("times", "size", "key", "row"))
    columns = [F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")]
    taken = cut_lineage(_taken(docs.select(*columns, row_key(docs).alias("row")), weights, max_epochs, seed))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0).cast("long")
    order = F.struct(_key(F.col("doc_id"), F.col("size"), seed).alias("key"), "doc_id", "size", "row")
    cuts = taken.groupBy("source").agg(
        F.max(epochs).alias("epochs"), F.min(F.when(F.col("taken") < (epochs + 1) * F.col("size"), order)).alias("cut")
    )
    # rows alike the cut in every column share what the mix gives them
    alike = taken.alias("t").join(cuts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")) & (F.col("t.row") == F.col("c.cut.row")))
    alike = alike.groupBy("t.source").agg(
        F.count("*").alias("copies"), F.sum(F.round(F.col("t.taken") / F.greatest("t.size", F.lit(1))).cast("long")).alias("stand")
    )
    cuts = cut_lineage(
        cuts.alias("c").join(alike.alias("a"), F.col("c.source").eqNullSafe(F.col("a.source")), "left").select("c.*", "copies", "stand")
    )
    few = small(cuts)
    c = (F.broadcast(cuts) if few else cuts).alias("c")
    numbered = docs.withColumn(size, word_count(F.col(text))).withColumn(key, _key(F.col(doc_id), F.col(size), seed)).alias("d")
    mine, cut = F.struct(F.col(f"d.`{doc_id}`"), F.col(f"d.`{size}`")), F.struct("c.cut.doc_id", "c.cut.size")
    digest = row_key(docs, "d.")
    times = (
        F.when(F.col(f"d.`{size}`") == 0, F.lit(0))
        .when(F.col("c.cut").isNull() | (F.col(f"d.`{key}`") < F.col("c.cut.key")), F.col("c.epochs") + 1)
        .when(F.col(f"d.`{key}`") > F.col("c.cut.key"), F.col("c.epochs"))
        .when(mine < cut, F.col("c.epochs") + 1)
        .when(mine > cut, F.col("c.epochs"))
        .when(digest < F.col("c.cut.row"), F.col("c.epochs") + 1)
        .when(digest > F.col("c.cut.row"), F.col("c.epochs"))
        .otherwise(F.floor(F.col("c.stand") / F.col("c.copies")))
    )
    joined = numbered.join(c, F.col(f"d.`{source}`").eqNullSafe(F.col("c.source")))
    own = [F.col(f"d.`{x}`").alias(x) for x in docs.columns]
    out = joined.select(*own, times.cast("int").alias(n)).where(F.col(n) > 0)
    rest = (F.col("stand") % F.col("copies")).cast("int")
    extra = cuts.where(rest > 0).select(F.col("cut.row").alias(row), rest.alias(n))
    if not extra.isEmpty():  # copies left over: one row of the group stands so many times more
        extra = F.broadcast(extra) if few else extra
        out = out.unionByName(docs.withColumn(row, row_key(docs)).join(extra, row).dropDuplicates([row]).drop(row))
    return out.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).drop(n)
