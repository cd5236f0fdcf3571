"""Registered queries for the code-mapping family (X1 and its parts, G1/G2, K4)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from refloom.functions.codes import in_prefix_range, valid_code
from refloom.operators import codes, history, quality, schema, sinks
from refloom.plans import bindings as B
from refloom.plans.oracle import MAP_COLS, METRO, VALID, with_views
from refloom.plans.registry import query
from refloom.session import ensure_checkpoint_dir

TARGET_YEAR = 2025
TOLERANCE = 4


@query(
    "code_filter",
    with_views(("cog_raw",), f"SELECT com AS code, typecom FROM cog_raw WHERE {VALID('com')}"),
    "P4 F1",
)
def code_filter(spark, sf):
    return B.cog_raw(spark, sf).filter(valid_code("com")).select(F.col("com").alias("code"), "typecom")


@query(
    "code_resolution",
    with_views(("resolved",), "SELECT code, reference_code, type_code, parent_code FROM resolved"),
    "P5 A2 P1",
)
def code_resolution(spark, sf):
    return codes.resolve_reference(B.cog_raw(spark, sf))


@query(
    "district_identity",
    with_views(("districts",), "SELECT cog_initial, cog_reference FROM districts"),
    "P7",
)
def district_identity(spark, sf):
    return codes.identity_rows(codes.resolve_reference(B.cog_raw(spark, sf)))


@query("urban_units", with_views(("units",), "SELECT code, tuu, tduu FROM units"), "A3")
def urban_units(spark, sf):
    return codes.urban_units(B.uu_raw(spark, sf))


@query("code_edges", with_views(("edges",), "SELECT old_code, new_code FROM edges"), "P6 A4")
def code_edges(spark, sf):
    return history.edges(B.history_raw(spark, sf))


@query("history_codes", with_views(("hist_codes",), "SELECT code FROM hist_codes"), "U2")
def history_codes(spark, sf):
    return history.edge_codes(history.edges(B.history_raw(spark, sf), distinct=False))


@query(
    "snapshot_codes",
    with_views(("snap_codes",), "SELECT code FROM snap_codes"),
    "A5 P9",
)
def snapshot_codes(spark, sf):
    raw = B.history_snapshot(spark, sf)
    assert history.is_snapshot(raw)
    return history.snapshot_codes(raw)


@query(
    "history_walk",
    with_views(("steps",), "SELECT origin_code, current_code, depth FROM steps"),
    "G1 J3 U3",
)
def history_walk(spark, sf):
    return history.walk(history.edges(B.history_raw(spark, sf)))


@query(
    "history_terminal",
    with_views(("terminal",), "SELECT origin_code, current_code, depth FROM terminal"),
    "G2 W1",
)
def history_terminal(spark, sf):
    return history.deepest(history.edges(B.history_raw(spark, sf)))


def _mapping(spark, sf, metro_only):
    return codes.code_mapping(
        B.cog_raw(spark, sf), B.uu_raw(spark, sf), B.history_raw(spark, sf), TARGET_YEAR, metro_only=metro_only
    )


@query("code_mapping_metro", with_views(("event_map",), f"SELECT {MAP_COLS} FROM event_map WHERE {METRO}"), "X1 J1 J2 U1 A6 P8 K2")
def code_mapping_metro(spark, sf):
    return _mapping(spark, sf, True)


@query("code_mapping_all", with_views(("event_map",), f"SELECT {MAP_COLS} FROM event_map"), "X1 J1 J2 U1 A6")
def code_mapping_all(spark, sf):
    return _mapping(spark, sf, False)


@query(
    "code_mapping_snapshot",
    with_views(("snap_map",), f"SELECT {MAP_COLS} FROM snap_map WHERE {METRO}"),
    "X1 with a snapshot history (P9 A5)",
)
def code_mapping_snapshot(spark, sf):
    return codes.code_mapping(
        B.cog_raw(spark, sf), B.uu_raw(spark, sf), B.history_snapshot(spark, sf), TARGET_YEAR, metro_only=True
    )


@query(
    "row_count_control",
    with_views(
        ("event_map", "event_pairs", "units"),
        f"""SELECT count(*) AS n_rows, (SELECT e FROM expected) AS expected_rows, CAST({TOLERANCE} AS BIGINT) AS tolerance,
                   abs(count(*) - (SELECT e FROM expected)) <= {TOLERANCE} AS passed
            FROM event_map WHERE {METRO}""",
        extra=((
            "expected",
            f"""SELECT CAST(sum(pairs * coalesce(n, 1)) AS BIGINT) AS e
                FROM (SELECT cog_reference, count(*) AS pairs FROM event_pairs WHERE {METRO} GROUP BY cog_reference)
                LEFT JOIN (SELECT code, count(*) AS n FROM units GROUP BY code) ON code = cog_reference""",
        ),),
    ),
    "K4 A1: the mapping's rows against what counts of pairs and units make them",
)
def row_count_control(spark, sf):
    pairs = codes.mapping_pairs(codes.resolve_reference(B.cog_raw(spark, sf)), codes.history_code_set(B.history_raw(spark, sf)))
    expected = codes.mapping_size(pairs.filter(in_prefix_range("cog_initial")), codes.urban_units(B.uu_raw(spark, sf)))
    return quality.row_count_report(_mapping(spark, sf, True), expected, TOLERANCE)


@query(
    "table_write",
    with_views(("event_map",), f"SELECT {MAP_COLS} FROM event_map"),
    "K1 K2 X1: the mapping stored under its year's name and read back",
)
def table_write(spark, sf):
    folder = f"{ensure_checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}"
    where, _ = sinks.build_mapping_table(
        spark, B.cog_raw(spark, sf), B.uu_raw(spark, sf), B.history_raw(spark, sf), TARGET_YEAR, metro_only=False, path=folder
    )
    return spark.read.parquet(where)


@query(
    "role_columns",
    with_views(("cog_raw",), "SELECT com AS code, typecom AS kind, comparent AS parent FROM cog_raw"),
    "P1 P2: roles found by substring where no column fits exactly",
)
def role_columns(spark, sf):
    odd = B.cog_raw(spark, sf).toDF("Code COM (2025)", "Le TYPE.COM", "x_Com-Parent")
    roles = {"code": ["COG", "codecom"], "kind": ["TYPE_COM"], "parent": ["nothing", "COMPARENT"]}
    return schema.select_roles(odd, roles)


@query(
    "code_mapping_no_history",
    with_views(("none_map",), f"SELECT {MAP_COLS} FROM none_map WHERE {METRO}"),
    "X1 with the empty-history fallback (S9)",
)
def code_mapping_no_history(spark, sf):
    return codes.code_mapping(
        B.cog_raw(spark, sf), B.uu_raw(spark, sf), history.empty_history(spark), TARGET_YEAR, metro_only=True
    )
