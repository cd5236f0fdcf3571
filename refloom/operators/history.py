"""History operators: edges (P6, A4), code sets (U2, A5), layout (P9), bounded walk
(G1, J3, U3) and terminal code per origin (G2, W1).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.functions.codes import valid_code
from refloom.operators.schema import has_columns, pick_column, select_roles
from refloom.session import cut_lineage

# History role candidates and the snapshot layout signature.
OLD_CANDIDATES = ("COM_AV", "DEP_COM_AV", "CODGEO_AV", "OLD_COM", "CODE_AVANT", "OLD_CODE")
NEW_CANDIDATES = ("COM_AP", "DEP_COM_AP", "CODGEO_AP", "NEW_COM", "CODE_APRES", "CODGEO", "NEW_CODE")
SNAPSHOT_CANDIDATES = ("COM", "CODGEO", "CODE_COMMUNE")
SNAPSHOT_SIGNATURE = ("com", "datedebut", "datefin")
MAX_DEPTH = 20


def is_snapshot(history_raw: DataFrame) -> bool:
    """A snapshot layout has ``com``, ``datedebut`` and ``datefin`` (normalized names)."""
    return has_columns(history_raw, SNAPSHOT_SIGNATURE)


def edges(history_raw: DataFrame, distinct: bool = True) -> DataFrame:
    """P6 + A4: distinct valid ``(old_code, new_code)`` pairs without self-loops.

    A snapshot layout has no edges (typed, empty).
    """
    if is_snapshot(history_raw):
        return history_raw.sparkSession.createDataFrame([], "old_code string, new_code string")
    r = select_roles(history_raw, {"old_code": OLD_CANDIDATES, "new_code": NEW_CANDIDATES})
    r = r.filter(valid_code("old_code") & valid_code("new_code") & (F.col("old_code") != F.col("new_code")))
    return r.distinct() if distinct else r


def edge_codes(e: DataFrame) -> DataFrame:
    """Distinct origin codes and new codes of the edges (one pass, one shuffle).

    The reference takes the origins from the walk result; the walk's origins are
    exactly the distinct ``old_code`` values, so the walk is not needed here.
    Duplicate edges may be passed in (``edges(raw, distinct=False)``): the code set
    is the same.
    """
    return e.select(F.explode(F.array("old_code", "new_code")).alias("code")).distinct()


def snapshot_codes(history_raw: DataFrame) -> DataFrame:
    """A5: distinct valid codes of a snapshot history."""
    src = pick_column(history_raw.columns, SNAPSHOT_CANDIDATES)
    c = F.col(f"`{src}`").cast("string")
    return history_raw.select(c.alias("code")).filter(valid_code("code")).distinct()


def walk(e: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """G1: every ``(origin_code, current_code, depth)`` reachable in 1..max_depth steps.

    Origins are all the edges' old codes, so the rows at depth ``d`` are exactly the
    pairs ``d`` steps apart, ``E_d``, and ``E_(a+b) = E_a . E_b``. The walk doubles
    the known span each round: with depths ``1..s`` known, one join of those rows
    with ``E_s`` (the rows at depth ``s``) adds depths ``s+1..2s``. Depth 20 takes 5
    rounds instead of 20; every depth is produced once, from its unique split
    ``d = d' + s`` with ``d' <= s``. When a round adds nothing, no longer path
    exists (its first ``s+1`` steps would have been found), so the loop stops.

    Rows are distinct per ``(origin, current, depth)``, equal to the distinct rows of
    the recursive UNION ALL walk (a cycle keeps going to ``max_depth``). Each round
    is written to the reliable checkpoint directory, so lineage stays one join
    deep and a lost executor recomputes one round at most.

    The join key is ``current_code`` on the known side and ``origin_code`` on the
    ``E_s`` side; a code that many origins reach is skewed on the known side only,
    which AQE splits (or the ``E_s`` side is broadcast when its runtime size allows).
    """
    first = e.select(
        F.col("old_code").alias("origin_code"), F.col("new_code").alias("current_code"), F.lit(1).alias("depth")
    ).distinct()
    pieces = [cut_lineage(first)]
    span = 1
    while span < max_depth:
        known = reduce(DataFrame.unionByName, pieces)
        e_span = pieces[-1] if span == 1 else known.filter(F.col("depth") == span)
        step = e_span.select(F.col("origin_code").alias("current_code"), F.col("current_code").alias("next_code"))
        add = (
            known.filter(F.col("depth") <= max_depth - span)
            .join(step, "current_code")
            .select("origin_code", F.col("next_code").alias("current_code"), (F.col("depth") + span).alias("depth"))
            .distinct()
        )
        add = cut_lineage(add)
        if add.isEmpty():
            break
        pieces.append(add)
        span *= 2
    return reduce(DataFrame.unionByName, pieces)


def terminals(walk_rows: DataFrame) -> DataFrame:
    """G2 + W1: per origin, the deepest current code; ties go to the smallest code.

    An aggregate (``min_by`` over ``(-depth, code)``) instead of a ``row_number``
    window: partial aggregation collapses a hot origin map-side, so no task ever
    holds one origin's whole path set.
    """
    order = F.struct((-F.col("depth")).alias("neg_depth"), F.col("current_code").alias("code"))
    best = F.min_by(F.struct("current_code", "depth"), order)
    return walk_rows.groupBy("origin_code").agg(best.alias("b")).select(
        "origin_code", F.col("b.current_code").alias("current_code"), F.col("b.depth").alias("depth")
    )


def deepest(e: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """G2 without the walk: per origin, a deepest code within ``max_depth`` steps and its depth;
    ties go to the smallest code.

    Only the pairs 1, 2, 4, 8, 16 … steps apart are kept, each joined from the one before.
    Every origin then takes the longest of them that leads anywhere from all the codes it
    stands on, then the next shorter one: if some walk has d steps, so has one for every
    smaller number, so what is taken adds up to the deepest. Same rows as ``terminals(walk(e))``.
    """
    pair = e.select(F.col("old_code").alias("a"), F.col("new_code").alias("b")).distinct()
    layers, span = [cut_lineage(pair)], 1
    while 2 * span <= max_depth:
        last = layers[-1]
        double = last.alias("x").join(last.alias("y"), F.col("x.b") == F.col("y.a")).select("x.a", "y.b").distinct()
        double = cut_lineage(double)
        if double.isEmpty():
            break
        layers.append(double)
        span *= 2
    at = layers[0].select(F.col("a").alias("origin_code"), F.col("a").alias("current_code"), F.lit(0).alias("depth")).distinct()
    for k in reversed(range(len(layers))):
        step = 1 << k
        ahead = (
            at.filter(F.col("depth") <= max_depth - step)
            .join(layers[k], F.col("current_code") == F.col("a"))
            .select("origin_code", F.col("b").alias("current_code"), (F.col("depth") + step).alias("depth"))
            .distinct()
        )
        at = cut_lineage(ahead.unionByName(at.join(ahead.select("origin_code").distinct(), "origin_code", "left_anti")))
    # an origin's rows all have its depth
    return at.groupBy("origin_code").agg(F.min("current_code").alias("current_code"), F.max("depth").alias("depth"))


def empty_history(spark) -> DataFrame:
    """The fallback history, two text columns and no rows."""
    return spark.createDataFrame([], "old_code string, new_code string")
