"""Golden mapping case, code filter cases, walk (cycle) and terminals."""

from pyspark.sql import functions as F

from refloom.functions.codes import valid_code
from refloom.operators import codes, history, quality

COG = [
    ("01001", "COM", None), ("01001", "COMD", "01001"), ("75056", "COM", None), ("75101", "ARM", "75056"),
    ("01002", "COMD", "01001"), ("01003", "comd", "  "), ("01004", "COMA", "01001"), ("2A004", "COM", None),
    ("97101", "COM", None), ("ABCDE", "COM", None), ("1001", "COM", None), (None, "COM", None),
]
UU = [("01001", "0", "00"), ("01001", "0", "00"), ("01001", "1", "11"), ("75056", "8", "80"), ("2A004", "5", "51"),
      ("97101", "6", "61")]
HIST = [("01901", "01900"), ("01900", "01001"), ("20004", "2A004"), ("01950", "01950"), ("XX", "01001"),
        ("01960", "01961"), ("01960", "01962")]


def _frames(spark):
    cog = spark.createDataFrame(COG, "com string, typecom string, comparent string")
    uu = spark.createDataFrame(UU, "codgeo string, tuu2020 string, tduu2020 string")
    hist = spark.createDataFrame(HIST, "com_av string, com_ap string")
    return cog, uu, hist


def test_golden_metro_mapping(spark):
    cog, uu, hist = _frames(spark)
    rows = codes.code_mapping(cog, uu, hist, 2025, metro_only=True).collect()
    got = sorted((r.cog_initial, r.cog_reference, r.tuu, r.tduu) for r in rows)
    expected = sorted(
        [
            ("01001", "01001", "0", "00"), ("01001", "01001", "1", "11"),
            ("01002", "01001", "0", "00"), ("01002", "01001", "1", "11"),
            ("01003", "01003", None, None), ("01004", "01004", None, None),
            ("01900", "01900", None, None), ("01901", "01901", None, None), ("01960", "01960", None, None),
            ("01961", "01961", None, None), ("01962", "01962", None, None), ("20004", "20004", None, None),
            ("2A004", "2A004", "5", "51"), ("75056", "75056", "8", "80"), ("75101", "75056", "8", "80"),
            ("75101", "75101", None, None),
        ]
    )
    assert got == expected
    assert {(r.cog_year, r.target_year) for r in rows} == {(2025, 2025)}


def test_resolve_history_extension(spark):
    cog, uu, hist = _frames(spark)
    rows = codes.code_mapping(cog, uu, hist, 2025, metro_only=True, resolve_history=True).collect()
    pairs = {(r.cog_initial, r.cog_reference) for r in rows}
    assert {("01901", "01001"), ("01900", "01001"), ("20004", "2A004"), ("01960", "01961")} <= pairs
    assert ("01901", "01901") not in pairs and ("01961", "01961") in pairs


def test_national_mapping_keeps_overseas(spark):
    cog, uu, hist = _frames(spark)
    rows = codes.code_mapping(cog, uu, hist, 2025, metro_only=False).collect()
    assert ("97101", "97101", "6", "61") in {(r.cog_initial, r.cog_reference, r.tuu, r.tduu) for r in rows}
    assert len(rows) == 17


def test_code_filter_cases(spark):
    vals = [("01001",), ("2A004",), ("2a004",), (" 01001",), ("01001\n",), (None,), ("2B123",), ("123456",)]
    df = spark.createDataFrame(vals, "c string")
    got = {r.c for r in df.filter(valid_code("c")).collect()}
    assert got == {"01001", "2A004", "2B123"}


def test_terminals_golden(spark):
    _, _, hist = _frames(spark)
    t = history.terminals(history.walk(history.edges(hist))).collect()
    got = {r.origin_code: (r.current_code, r.depth) for r in t}
    assert got == {"01900": ("01001", 1), "01901": ("01001", 2), "01960": ("01961", 1), "20004": ("2A004", 1)}


def test_walk_cycle_runs_to_depth_20(spark):
    e = spark.createDataFrame([("A", "B"), ("B", "C"), ("X", "Y"), ("Y", "X")], "old_code string, new_code string")
    w = history.walk(e)
    depth = {r.origin_code: r.d for r in w.groupBy("origin_code").agg(F.max("depth").alias("d")).collect()}
    assert depth == {"A": 2, "B": 1, "X": 20, "Y": 20}
    # every (origin, code, depth) once: X reaches Y at odd and X at even depths
    assert w.filter("origin_code = 'X'").count() == 20


def test_walk_matches_steps_by_hand(spark):
    pairs = {("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "b"), ("e", "a")}
    e = spark.createDataFrame(sorted(pairs), "old_code string, new_code string")
    wanted, at = set(), {(o, o) for o, _ in pairs}
    for depth in range(1, 21):
        at = {(o, n) for o, c in at for old, n in pairs if old == c}
        wanted |= {(o, c, depth) for o, c in at}
    assert {tuple(r) for r in history.walk(e).collect()} == wanted


def test_deepest_is_the_walks_last_row(spark):
    import random

    rng = random.Random(1)
    pairs = [("X", "Y"), ("Y", "X"), ("s", "t"), ("s", "u"), ("t", "z"), ("u", "y")]
    pairs += [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(30)] + [(f"r{rng.randrange(40)}", f"r{rng.randrange(40)}") for _ in range(35)]
    e = spark.createDataFrame([p for p in pairs if p[0] != p[1]], "old_code string, new_code string")
    for depth in (1, 3, 20):
        walked = history.terminals(history.walk(e, depth)).collect()
        assert sorted(map(tuple, history.deepest(e, depth).collect())) == sorted(map(tuple, walked))


def test_snapshot_layout_uses_codes_only(spark):
    snap = spark.createDataFrame(
        [("01001", "2020-01-01", "2021-01-01"), ("01999", "2020-01-01", None), ("bad", "x", "y")],
        "COM string, DATE_DEBUT string, DATE_FIN string",
    )
    assert history.is_snapshot(snap)
    assert history.edges(snap).count() == 0
    assert {r.code for r in history.snapshot_codes(snap).collect()} == {"01001", "01999"}


def test_row_count_control(spark):
    df = spark.range(39074)
    assert quality.row_count_control(df, 39071, 4) == 39074
    try:
        quality.row_count_control(spark.range(10), 39071, 0)
    except quality.RowCountError as e:
        assert "39071" in str(e)
    else:
        raise AssertionError("expected a failure")
    assert quality.row_count_control(spark.range(5), None) == 5


def test_build_mapping_table_checks_before_writing(spark):
    import tempfile
    from pathlib import Path

    from refloom.operators import sinks

    cog, uu, hist = _frames(spark)
    out = tempfile.mkdtemp(prefix="refloom-sink-")
    try:
        sinks.build_mapping_table(spark, cog, uu, hist, 2025, expected_rows=10, tolerance=0, path=out)
    except quality.RowCountError:
        pass
    else:
        raise AssertionError("expected the control to fail")
    assert not (Path(out) / "cog_tuu_tduu_2025").exists()
    where, n = sinks.build_mapping_table(spark, cog, uu, hist, 2025, expected_rows=18, tolerance=2, path=out)
    assert n == 16 and where.endswith("cog_tuu_tduu_2025")
    assert spark.read.parquet(where).count() == 16


def test_empty_history_fallback(spark):
    cog, uu, _ = _frames(spark)
    empty = history.empty_history(spark)
    assert empty.columns == ["old_code", "new_code"] and empty.count() == 0
    rows = codes.code_mapping(cog, uu, empty, 2025).collect()
    assert {r.cog_initial for r in rows} == {"01001", "01002", "01003", "01004", "2A004", "75056", "75101"}


def test_bucketed_tables_join_without_shuffle(spark):
    from refloom.operators import sinks

    cog, uu, _ = _frames(spark)
    res = codes.resolve_reference(cog)
    units = codes.urban_units(uu)
    sinks.write_table(res, "res_b", schema="refloom_test", bucket_by="code", buckets=4)
    sinks.write_table(units, "units_b", schema="refloom_test", bucket_by="code", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = spark.table("refloom_test.res_b"), spark.table("refloom_test.units_b")
        joined = a.join(b, "code")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        assert joined.count() == res.join(units, "code").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_write_table_partitioned_by_year(spark):
    import tempfile

    from refloom.operators import sinks

    cog, uu, hist = _frames(spark)
    out = tempfile.mkdtemp(prefix="refloom-k2-")
    m = codes.code_mapping(cog, uu, hist, 2025)
    where = sinks.write_table(m, codes.mapping_table_name(2025), path=out, partition_by="target_year")
    assert where.endswith("cog_tuu_tduu_2025")
    back = spark.read.parquet(where)
    assert back.filter("target_year = 2025").count() == 16
