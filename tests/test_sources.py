"""Archive load end to end, nested descent, lenient CSV, dBASE, GeoJSON, catalog JSON."""

import io
import json
import struct
import tempfile
import zipfile
from pathlib import Path

import pytest

from refloom.sources import archives as A
from refloom.sources.catalog import read_catalog
from refloom.sources.dbf import read_dbf
from refloom.sources.delimited import UnsupportedFormat, read_lenient_csv, read_tabular
from refloom.sources.geojson import read_geojson


def _tmp() -> Path:
    return Path(tempfile.mkdtemp(prefix="refloom-test-"))


def _two_archives() -> Path:
    """Two archives that share a table; the second one lacks the other table."""
    src = _tmp()
    with zipfile.ZipFile(src / "north.zip", "w") as z:
        z.writestr("dump/masts.csv", "key;place\n7;Hill\n8;Dune\n")
        z.writestr("dump/owners.csv", "key;share\n70;0.5\n")
    with zipfile.ZipFile(src / "south.zip", "w") as z:
        z.writestr("dump/masts.csv", "key;place\n9;Moor\n")
    return src


def test_load_archives_end_to_end(spark):
    tables, manifest = A.load_archives(spark, str(_two_archives()))
    assert {r.table_name: r.n_files for r in manifest.collect()} == {"dump_masts": 2, "dump_owners": 1}
    assert tables["dump_masts"].columns == ["_key", "place", "archive", "member", "_extra"]
    assert sorted(tuple(r)[:2] for r in tables["dump_masts"].collect()) == [("7", "Hill"), ("8", "Dune"), ("9", "Moor")]
    assert {r.table_name: r.n_rows for r in A.row_counts(tables).collect()} == {"dump_masts": 3, "dump_owners": 1}


def test_union_by_name_across_archives_and_ragged_rows(spark):
    src = _tmp()
    with zipfile.ZipFile(src / "a.zip", "w") as z:
        z.writestr("t.csv", "ID;Nom Été\n1;x\n2\n")
    with zipfile.ZipFile(src / "b.zip", "w") as z:
        z.writestr("t.csv", "nom été,Hauteur\ny,3,extra\n")
    tables, _ = A.load_archives(spark, str(src))
    df = tables["t"]
    assert df.columns[:3] == ["id", "nom_ete", "hauteur"]
    rows = sorted(((r.id, r.nom_ete, r.hauteur, r._extra) for r in df.collect()), key=repr)
    assert rows == sorted([("1", "x", None, None), ("2", None, None, None), (None, "y", "3", ["extra"])], key=repr)


def test_no_archive_is_an_error(spark):
    with pytest.raises(A.ArchiveError):
        A.archive_index(spark, str(_tmp()))


def _nested_zip(name: str = "inner/list.csv", body: str = "k,v\n1,a\n") -> bytes:
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr(name, body)
    return inner.getvalue()


def test_first_tabular_member_csv_in_folder_and_nested(spark):
    src = _tmp()
    with zipfile.ZipFile(src / "folder.zip", "w") as z:
        z.writestr("NOTES.md", "about")
        z.writestr("tables/list.csv", "k,v\n1,a\n")
    with zipfile.ZipFile(src / "boxed.zip", "w") as z:
        z.writestr("more/box.zip", _nested_zip())
    with zipfile.ZipFile(src / "mixed.zip", "w") as z:
        z.writestr("shape.geojson", b"{}")
        # deflated: the archive's own first bytes must not look like a page
        z.writestr("other.zip", b"<!DOCTYPE html><html>an error page</html>", compress_type=zipfile.ZIP_DEFLATED)
    members = A.list_members(A.archive_index(spark, str(src)), descend=True)
    got = {r.archive: r.member_path for r in A.first_tabular_member(members).collect()}
    assert got == {
        "folder.zip": "tables/list.csv",
        "boxed.zip": "more/box.zip!/inner/list.csv",
        "mixed.zip": "shape.geojson",
    }


def test_nesting_limit_and_spooled_archives(spark, monkeypatch):
    src, data = _tmp(), _nested_zip()
    for depth in range(6):
        outer = io.BytesIO()
        with zipfile.ZipFile(outer, "w") as z:
            z.writestr(f"d{depth}.zip", data)
        data = outer.getvalue()
    (src / "deep.zip").write_bytes(data)
    rows = A.list_members(A.archive_index(spark, str(src)), descend=True).collect()
    assert [r.error for r in rows if r.error] == ["nesting too deep"] and max(r.depth for r in rows) == 6


def test_html_archive_is_rejected(spark):
    src = _tmp()
    (src / "fake.zip").write_bytes(b"<!doctype html><html><body>error page</body></html>")
    rows = A.list_members(A.archive_index(spark, str(src))).collect()
    assert len(rows) == 1 and rows[0].looks_html and "HTML" in rows[0].error


def test_unreadable_archives_and_members_are_not_lost(spark):
    src = _two_archives()
    (src / "page.zip").write_bytes(b"<HTML><body>log in first</body></HTML>")
    (src / "torn.zip").write_bytes(b"PK\x03\x04 not really")
    with zipfile.ZipFile(src / "west.zip", "w") as z:
        z.writestr("dump/masts.csv", "<!doctype html><html>busy</html>", compress_type=zipfile.ZIP_DEFLATED)
    with pytest.raises(A.ArchiveError, match="3 archives or members cannot be read.*page.zip"):
        A.load_archives(spark, str(src))
    tables, manifest = A.load_archives(spark, str(src), strict=False)
    assert tables["dump_masts"].count() == 3
    rejects = A.archive_rejects(A.list_members(A.archive_index(spark, str(src)))).collect()
    assert sorted((r.archive, r.member_path) for r in rejects) == [("page.zip", ""), ("torn.zip", ""), ("west.zip", "dump/masts.csv")]


RAGGED = (
    '\ufeff\n\nWord;"Line\nTwo";Type\r\n'
    '"she said ""no""";"a\nb";x\n'
    "short\n"
    "a;b;c;more;;last\n"
    ";;\n"
    + "long" * 50_000 + ";1;2\n"
)
RAGGED_ROWS = [
    ('she said "no"', "a\nb", "x", None),
    ("short", None, None, None),
    ("a", "b", "c", ["more", "", "last"]),
    (None, None, None, None),
    ("long" * 50_000, "1", "2", None),
]


def test_both_readers_agree_on_ragged_bytes(spark):
    src, d = _tmp(), _tmp()
    with zipfile.ZipFile(src / "r.zip", "w") as z:
        z.writestr("t.csv", RAGGED.encode("utf-8"))
    (d / "t.csv").write_bytes(RAGGED.encode("utf-8"))
    boxed = A.load_archives(spark, str(src))[0]["t"].drop("archive", "member")
    plain = read_lenient_csv(spark, str(d / "t.csv"))
    assert boxed.columns == plain.columns == ["word", "line_two", "_type", "_extra"]
    for df in (boxed, plain):
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(RAGGED_ROWS, key=repr)


def test_files_of_one_path_keep_their_own_layout(spark):
    d = _tmp()
    (d / "a.csv").write_text("ID;Name;Size\n1;x;5\n2;y\n")
    (d / "b.csv").write_text("name,id\nz,3\nw,4,over,more\n")
    (d / "c.csv").write_text("Size;ID\n9;6\n8;7;extra\n")
    (d / "d.csv").write_text("")
    df = read_lenient_csv(spark, str(d / "*.csv"))
    assert df.columns == ["id", "_name", "size", "_extra"]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(
        [("1", "x", "5", None), ("2", "y", None, None), ("3", "z", None, None), ("4", "w", None, ["over", "more"]),
         ("6", None, "9", None), ("7", None, "8", ["extra"])], key=repr)


def test_choice_prefers_level_files_over_nested(spark):
    src = _tmp()
    with zipfile.ZipFile(src / "x.zip", "w") as z:
        z.writestr("a_inner.zip", _nested_zip())
        z.writestr("z/data.xlsx", b"xx")
    members = A.list_members(A.archive_index(spark, str(src)), descend=True)
    assert A.first_tabular_member(members).first().member_path == "z/data.xlsx"


def test_lenient_csv_and_routing(spark):
    d = _tmp()
    p = d / "v.csv"
    p.write_text("\ufeffNo;Kind Of;Été\n007;top;Dune\n008;low\n", encoding="utf-8")
    df = read_lenient_csv(spark, str(p))
    assert df.columns == ["_no", "kind_of", "ete", "_extra"]
    assert sorted(tuple(r) for r in df.collect()) == [("007", "top", "Dune", None), ("008", "low", None, None)]
    assert read_tabular(spark, str(p)).count() == 2
    with pytest.raises(UnsupportedFormat):
        read_tabular(spark, str(d / "x.pdf"))


def _write_dbf(path: Path, fields, records):
    rec_len = 1 + sum(w for _, w in fields)
    header_len = 32 + 32 * len(fields) + 1
    with open(path, "wb") as f:
        f.write(struct.pack("<B3BIHH20x", 3, 124, 1, 1, len(records), header_len, rec_len))
        for name, w in fields:
            f.write(struct.pack("<11sc4xBB14x", name.encode(), b"C", w, 0))
        f.write(b"\x0d")
        for deleted, vals in records:
            f.write(b"*" if deleted else b" ")
            for (_, w), v in zip(fields, vals):
                f.write(v.encode("utf-8").ljust(w, b" ")[:w])
        f.write(b"\x1a")


def test_dbf_reader(spark):
    d = _tmp()
    p = d / "zones.dbf"
    _write_dbf(p, [("CODGEO", 5), ("TUU2020", 1), ("LIBUU", 12)],
               [(False, ["01001", "0", "Ville é"]), (True, ["99999", "9", "gone"]), (False, ["2A004", "5", ""])])
    (d / "zones.cpg").write_text("UTF-8")
    df = read_dbf(spark, str(p))
    assert df.columns == ["CODGEO", "TUU2020", "LIBUU"]
    assert sorted(tuple(r) for r in df.collect()) == [("01001", "0", "Ville é"), ("2A004", "5", "")]


def test_geojson_properties(spark):
    d = _tmp()
    p = d / "uu.geojson"
    p.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": None, "properties": {"CODGEO": "01001", "TUU2020": 0}},
        {"type": "Feature", "geometry": None, "properties": {"CODGEO": "2A004", "TUU2020": 5}},
    ]}))
    rows = sorted(tuple(r) for r in read_geojson(spark, str(p)).select("CODGEO", "TUU2020").collect())
    assert rows == [("01001", "0"), ("2A004", "5")]


def test_catalog_json(spark):
    d = _tmp()
    (d / "q0.json").write_text(json.dumps({"data": [{"id": "a", "title": "T", "resources": [{"title": "r"}]}]}))
    (d / "q1.json").write_text(json.dumps({"data": [], "results": [{"slug": "b"}, {"page": "c"}]}))
    rows = sorted((r.query_pos, r.item_pos, r.id, r.slug, r.page, r.n_resources) for r in read_catalog(spark, str(d)).collect())
    assert rows == [(0, 0, "a", None, None, 1), (1, 0, None, "b", None, 0), (1, 1, None, None, "c", 0)]


CRLF_QUOTED = '"Id","Place"\r\n"001","Dune, wide"\r\n"002","Étang"\r\n'


def test_crlf_quoted_csv_in_archive_and_file(spark):
    src, d = _tmp(), _tmp()
    with zipfile.ZipFile(src / "v.zip", "w") as z:
        z.writestr("places.csv", CRLF_QUOTED.encode("utf-8"))
    (d / "places.csv").write_bytes(CRLF_QUOTED.encode("utf-8"))
    wanted = [("001", "Dune, wide", None), ("002", "Étang", None)]
    assert sorted(tuple(r) for r in A.load_archives(spark, str(src))[0]["places"].drop("archive", "member").collect()) == wanted
    assert sorted(tuple(r) for r in read_lenient_csv(spark, str(d / "places.csv")).collect()) == wanted


def test_store_archives_qualified_manifest(spark):
    manifest = A.store_archives(spark, str(_two_archives()), schema="stock")
    got = {r.table_name: (r.n_files, r.n_rows) for r in manifest.collect()}
    assert got == {"stock.dump_masts": (2, 3), "stock.dump_owners": (1, 1)}
    assert sorted(tuple(r) for r in spark.table("stock.dump_masts").select("_key", "place").collect()) == [
        ("7", "Hill"), ("8", "Dune"), ("9", "Moor")]


def test_html_gate_files(spark):
    d = _tmp()
    (d / "page.csv").write_bytes(b"<!DOCTYPE html><html><body>not data</body></html>")
    (d / "data.csv").write_bytes(("code;tuu\n" + "01001;A\n" * 1000).encode())
    (d / "late.csv").write_bytes(b"x" * 5000 + b"<html>")
    got = {r.path.rsplit("/", 1)[-1]: r.looks_html for r in A.html_gate_files(spark, str(d)).collect()}
    assert got == {"page.csv": True, "data.csv": False, "late.csv": False}


def test_chosen_members_are_opened_at_any_nesting(spark):
    from refloom.plans.fixture_files import dbf_bytes

    src = _tmp()
    with zipfile.ZipFile(src / "a.zip", "w") as z:
        z.writestr("in/box.zip", _nested_zip("t.csv", "Id;Été\n1;x\n2\n"))
    table = io.BytesIO()
    with zipfile.ZipFile(table, "w") as z:
        z.writestr("deep/box.zip", _nested_zip("u.dbf", dbf_bytes([("ID", 3), ("SIZE", 2)], [["é", "5"], ["7", ""]])))
    with zipfile.ZipFile(src / "b.zip", "w") as z:
        z.writestr("box.zip", table.getvalue())
    members = A.list_members(A.archive_index(spark, str(src)), descend=True)
    rows = A.read_chosen(A.first_tabular_member(members))
    assert rows.columns == ["id", "ete", "size", "archive"]
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(
        [("1", "x", None, "a.zip"), ("2", None, None, "a.zip"), ("é", None, "5", "b.zip"), ("7", None, "", "b.zip")], key=repr)
    with zipfile.ZipFile(src / "c.zip", "w") as z:
        z.writestr("x.gpkg", b"xx")
    with pytest.raises(A.ArchiveError, match="gpkg"):
        A.read_chosen(A.first_tabular_member(A.list_members(A.archive_index(spark, str(src)), descend=True)))
