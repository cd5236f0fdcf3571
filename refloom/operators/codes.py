"""Code-mapping operators (P4-P8, A2, A3, A6, J1, J2, U1, K2) and the X1 build.

Plan shape at scale: every input is filtered on the code predicate and pruned to
2-4 columns at the scan; each ``distinct`` is a hash aggregate with a map-side
partial step, so a hot code is pre-combined before the shuffle; the two equi joins
shuffle on the code (AQE turns the urban-unit side into a broadcast when its
runtime size is under the threshold, and splits skewed partitions otherwise).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.functions.codes import DISTRICT_TYPE, in_prefix_range, is_type, reference_code, valid_code
from refloom.operators import history as hist
from refloom.operators.schema import select_roles

# Role candidates, in the order they are tried (exact pass, then substring pass).
CODE_CANDIDATES = ("COM", "CODGEO", "CODE_COMMUNE", "DEP_COM")
TYPE_CANDIDATES = ("TYPECOM", "TYPE_COM")
PARENT_CANDIDATES = ("COMPARENT", "COM_PARENT", "PARENT", "COM_AP")
TUU_CANDIDATES = ("TUU2020", "TUU", "UU2020", "TYPE_UNITE_URBAINE")
TDUU_CANDIDATES = ("TDUU2020", "TDUU", "TYPE_DETAILLE_UNITE_URBAINE", "TYPE_COM", "LIBUU2020")

MAPPING_COLUMNS = ("cog_initial", "cog_reference", "tuu", "tduu", "cog_year", "target_year")


def valid_codes(df: DataFrame, code_col: str = "code") -> DataFrame:
    """Keep rows whose code is valid (NULL codes drop)."""
    return df.filter(valid_code(code_col))


def resolve_reference(codes_raw: DataFrame, roles: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """P5 + A2: distinct ``(code, reference_code, type_code, parent_code)`` of valid codes."""
    roles = roles or {"code": CODE_CANDIDATES, "type_code": TYPE_CANDIDATES, "parent_code": PARENT_CANDIDATES}
    r = select_roles(codes_raw, roles)
    return (
        r.filter(valid_code("code"))
        .select(
            "code",
            reference_code("code", "type_code", "parent_code").alias("reference_code"),
            "type_code",
            "parent_code",
        )
        .distinct()
    )


def identity_rows(resolution: DataFrame, type_value: str = DISTRICT_TYPE) -> DataFrame:
    """Every district code also maps to itself."""
    return (
        resolution.filter(is_type("type_code", type_value))
        .select(F.col("code").alias("cog_initial"), F.col("code").alias("cog_reference"))
        .distinct()
    )


def urban_units(units_raw: DataFrame) -> DataFrame:
    """A3: distinct ``(code, tuu, tduu)`` of valid codes; a code may keep several rows."""
    r = select_roles(units_raw, {"code": CODE_CANDIDATES, "tuu": TUU_CANDIDATES, "tduu": TDUU_CANDIDATES})
    return r.filter(valid_code("code")).distinct()


def history_code_set(history_raw: DataFrame) -> DataFrame:
    """U2 or A5, by layout (P9): the distinct codes a history contributes."""
    if hist.is_snapshot(history_raw):
        return hist.snapshot_codes(history_raw)
    return hist.edge_codes(hist.edges(history_raw, distinct=False))


def mapping_pairs(resolution: DataFrame, history_codes: DataFrame, lookup: str = "code") -> DataFrame:
    """J1 + U1 (+P7, A6): distinct ``(cog_initial, cog_reference)``.

    History codes resolve through the code list (left join, fans out per matching
    row) and fall back to themselves; every resolved code and every district
    identity row are added. The resolved pairs and the identity rows come out of one
    pass over the resolution (an ``explode`` of at most two values per row), so the
    code list is read twice in total, not three times.
    """
    res = resolution.select(F.col("code").alias("_res_code"), "reference_code")
    from_history = history_codes.join(res, F.col(lookup) == F.col("_res_code"), "left").select(
        F.col("code").alias("cog_initial"),
        F.coalesce(F.col("reference_code"), F.col(lookup)).alias("cog_reference"),
    )
    targets = F.array_compact(F.array(F.col("reference_code"), F.when(is_type("type_code", DISTRICT_TYPE), F.col("code"))))
    from_codes = resolution.select(F.col("code").alias("cog_initial"), F.explode(targets).alias("cog_reference"))
    return from_history.unionByName(from_codes).distinct()


def code_mapping(
    codes_raw: DataFrame,
    units_raw: DataFrame,
    history_raw: DataFrame,
    target_year: int,
    metro_only: bool = True,
    cog_year: int | None = None,
    resolve_history: bool = False,
) -> DataFrame:
    """``(cog_initial, cog_reference, tuu, tduu, cog_year, target_year)``.

    ``resolve_history=False`` reproduces the reference: history codes contribute
    themselves, the walk result is not chained in. ``resolve_history=True`` is a
    documented extension: a history code is looked up through its terminal code
    (G2), so a vanished code maps to the reference of the code that replaced it.
    ``cog_year`` defaults to the target year, as in the reference.
    """
    resolution = resolve_reference(codes_raw)
    if resolve_history and not hist.is_snapshot(history_raw):
        e = hist.edges(history_raw)
        term = hist.deepest(e).select(F.col("origin_code").alias("code"), "current_code")
        codes = hist.edge_codes(e)
        moved = codes.join(term, "code", "left").select("code", F.coalesce("current_code", "code").alias("_lookup"))
        pairs = mapping_pairs(resolution, moved, lookup="_lookup")
    else:
        pairs = mapping_pairs(resolution, history_code_set(history_raw))
    uu = urban_units(units_raw)
    out = pairs.join(uu, pairs["cog_reference"] == uu["code"], "left").select(
        pairs["cog_initial"],
        pairs["cog_reference"],
        uu["tuu"],
        uu["tduu"],
        F.lit(int(cog_year if cog_year is not None else target_year)).alias("cog_year"),
        F.lit(int(target_year)).alias("target_year"),
    )
    if metro_only:
        out = out.filter(in_prefix_range("cog_initial"))
    return out


def mapping_size(pairs: DataFrame, units: DataFrame) -> int:
    """Rows that the mapping of ``(cog_initial, cog_reference)`` pairs must have: one a pair and unit of
    its reference, one for a pair without a unit. Summed from counts, not from the mapping's rows."""
    counted = units.groupBy("code").agg(F.count("*").alias("n"))
    sized = pairs.groupBy("cog_reference").agg(F.count("*").alias("pairs")).join(counted, F.col("cog_reference") == F.col("code"), "left")
    return int(sized.agg(F.sum(F.col("pairs") * F.coalesce("n", F.lit(1)))).first()[0] or 0)


def mapping_table_name(target_year: int) -> str:
    """K2: year-suffixed output name."""
    return f"cog_tuu_tduu_{int(target_year)}"
