"""Delimited and GeoJSON files: encodings, dialects, ranges that cut quoted cells, rejects, odd headers."""

import csv
import io
import json
import random
import zipfile
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from refloom.sources import archives as A
from refloom.sources import delimited as R
from refloom.sources import dialect as D
from refloom.sources import geojson as G
from refloom.sources import jsonstream as J


def test_encodings_and_quoted_headers(spark, tmp_path):
    body = '"Nom, prénom, titre";code\n"Été; ""a""";1\nOrléans;2\n'
    for name, data in {
        "latin": body.encode("latin-1"), "utf": body.encode(), "mark": b"\xef\xbb\xbf" + body.encode(),
        "le": b"\xff\xfe" + body.encode("utf-16-le"), "be": b"\xfe\xff" + body.encode("utf-16-be"), "bare": body.encode("utf-16-le"),
    }.items():
        (tmp_path / f"{name}.csv").write_bytes(data)
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr("t.csv", data)
    want = [('Été; "a"', "1"), ("Orléans", "2")]
    kinds = {Path(r.path).stem: r.encoding for r in R.csv_layouts(spark, f"{tmp_path}/*.csv").collect()}
    assert kinds == {"latin": "latin-1", "utf": "utf-8", "mark": "utf-8", "le": "utf-16-le", "be": "utf-16-be", "bare": "utf-16-le"}
    for name in kinds:
        df = R.read_lenient_csv(spark, f"{tmp_path}/{name}.csv")
        assert df.columns == ["nom_prenom_titre", "code", "_extra"]
        assert sorted(tuple(r)[:2] for r in df.collect()) == sorted(want), name
    tables, _ = A.load_archives(spark, str(tmp_path))
    got = [(r.archive[:-4], r.nom_prenom_titre, r.code) for r in tables["t"].collect()]
    assert sorted(got) == sorted((n, *w) for n in kinds for w in want)


def test_latin_bytes_far_behind_the_sample(spark, tmp_path):
    data = b"a;b\n" + b"plain;text\n" * 60_000 + "fin;déjà\n".encode("latin-1")
    (tmp_path / "x.csv").write_bytes(data)
    rows = R.read_lenient_csv(spark, f"{tmp_path}/x.csv").where("a = 'fin'").collect()
    assert [r.b for r in rows] == ["déjà"]


@pytest.mark.parametrize("text,want", [
    ('"Nom, prenom, titre";code\na;1\n', (";", '"')),
    ("nom;valeur\nx;1,5\ny;2,5\n", (";", '"')),
    ("a,b\n1,2\n", (",", '"')),
    ("a\tb,c\n1\t2,3\n4\t5\n", ("\t", '"')),
    ("a|b|c\n1|2;3|4\n", ("|", '"')),
    ("single\n1\n2\n", (",", '"')),
    ("a,b\n'x,y',2\n'z',3\n", (",", "'")),
    ("a,b\nl'eau,2\nd'or,3\n", (",", '"')),
    ('a;b\n"x\n;y";2\n"z";3\n', (";", '"')),
    ("", (",", '"')),
])
def test_dialects(text, want):
    assert D.dialect(text) == want


def naive(data: bytes, sep: str, inside: bool):
    """Records that end and the final state, character by character."""
    n, state, k = 0, "in" if inside else "start", 0
    while k < len(data):
        c = data[k : k + 1]
        if state == "in":
            if c == b'"':
                if data[k + 1 : k + 2] == b'"':
                    k += 1
                else:
                    state = "out"
        elif c in (b"\n", b"\r"):
            k += c == b"\r" and data[k + 1 : k + 2] == b"\n"
            n, state = n + 1, "start"
        elif c == b'"' and state == "start":
            state = "in"
        else:
            state = "start" if c == sep.encode() else "out"
        k += 1
    return n, state == "in"


@given(st.text(alphabet='a";,\n\r', max_size=40).map(str.encode), st.booleans())
@settings(max_examples=1500, deadline=None)
def test_the_state_machine(data, inside):
    assert D.scan(data, ";", '"', inside) == naive(data, ";", inside)


def _quoted_file(rng):
    out = io.StringIO()
    w = csv.writer(out, delimiter=";", lineterminator=rng.choice(["\n", "\r\n"]))
    cells = ["x", "", 'say "so"', "two\nlines", "a;b", '"', "\n\n", 'end"\n"start', "é" * 9, "5 inch", "q\r\nr"]
    w.writerow(["one", "two", "three"])
    for k in range(rng.randrange(60)):
        w.writerow([f"r{k}"] + [rng.choice(cells) for _ in range(rng.choice([2, 2, 2, 1, 4]))])
    text = out.getvalue()
    if rng.random() < 0.3:
        text = "\n\n" + text + 'tail;5" pipe;z\n'
    return text if rng.random() < 0.5 else text.rstrip("\r\n")


@pytest.mark.parametrize("step", [64, 1000, 1 << 20])
def test_ranges_that_cut_quoted_cells(spark, tmp_path, monkeypatch, step):
    """Records, numbers and rejects of files read in many ranges, against the csv module on whole files."""
    monkeypatch.setattr(R, "RANGE_BYTES", step)
    rng = random.Random(step)
    want, rejects = set(), set()
    for k in range(12):
        text = _quoted_file(rng)
        (tmp_path / f"f{k}.csv").write_bytes(text.encode())
        rows = list(csv.reader(io.StringIO(text, newline=""), delimiter=";"))
        head = next(i for i, r in enumerate(rows) if r)
        for i, r in enumerate(rows):
            if i > head and r:
                want.add((f"f{k}", i + 1, tuple(c or None for c in (r + [""] * 3)[:3]), tuple(r[3:]) or None))
                if len(r) > 3:
                    rejects.add((f"f{k}", i + 1, "surplus cells", len(r)))
    rows, columns, names = R.read_records(spark, f"{tmp_path}/*.csv")
    assert columns == ["one", "two", "three"]
    got = [(Path(r[names["file"]]).stem, r[names["record"]], tuple(r[:3]), tuple(r["_extra"]) if r["_extra"] else None) for r in rows.collect()]
    assert len(got) == len(want) and set(got) == want
    found = R.csv_rejects(spark, f"{tmp_path}/*.csv").collect()
    assert {(Path(r.file).stem, r.record, r.reason, r.cells) for r in found} == rejects
    kept = R.read_lenient_csv(spark, f"{tmp_path}/*.csv", skip_rejects=True).count()
    assert kept == len(want) - len(rejects)


def test_utf16_in_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "RANGE_BYTES", 50)
    text = "k;v\n" + "".join(f'{k};"Ċ{k}\n上"\n' for k in range(40))
    (tmp_path / "x.csv").write_bytes(text.encode("utf-16"))
    rows = R.read_lenient_csv(spark, f"{tmp_path}/x.csv").collect()
    assert sorted((int(r.k), r.v) for r in rows) == [(k, f"Ċ{k}\n上") for k in range(40)]


def test_one_large_file_is_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "RANGE_BYTES", 10_000)
    text = "k;v\n" + "".join(f'{k};"line\nbreak"\n' for k in range(5_000))
    (tmp_path / "x.csv").write_text(text)
    df = R.read_lenient_csv(spark, f"{tmp_path}/x.csv")
    used = df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(used) == 5_000 and sum(n > 0 for n in used) >= 4


def test_rejects_broken_characters_and_open_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("k;v\n1;é\n".encode() + b"2;\xff\n3;ok\n4;a;b;c\n")
    (tmp_path / "b.csv").write_text('k;v\n\n1;x\n2;"never closed\n3;y\n')
    found = sorted((Path(r.file).stem, r.record, r.reason, r.cells) for r in R.csv_rejects(spark, f"{tmp_path}/*.csv").collect())
    assert found == [("a", 3, "invalid bytes", 2), ("a", 5, "surplus cells", 4), ("b", 4, "quote not closed", 2)]
    kept = R.read_lenient_csv(spark, f"{tmp_path}/*.csv", skip_rejects=True)
    assert sorted((r._key, r.v) if "_key" in kept.columns else (r.k, r.v) for r in kept.collect()) == [("1", "x"), ("1", "é"), ("3", "ok")]
    every = R.read_lenient_csv(spark, f"{tmp_path}/*.csv").collect()
    assert len(every) == 6 and ("2", "�") in [(r.k, r.v) for r in every]


def test_wide_rows_empty_files_and_taken_names(spark, tmp_path):
    wide = ";".join(f"c{k}" for k in range(21_000))
    (tmp_path / "w.csv").write_text("a;b\n" + wide + "\n")
    rows = R.read_lenient_csv(spark, f"{tmp_path}/w.csv").collect()
    assert len(rows) == 1 and len(rows[0]._extra) == 20_998
    for name, text in {"e1": "", "e2": "\n\n", "e3": "brand;width\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    assert R.read_lenient_csv(spark, f"{tmp_path}/e*.csv").columns == ["brand", "width", "_extra"]
    assert R.read_lenient_csv(spark, f"{tmp_path}/e*.csv").collect() == []
    assert R.read_lenient_csv(spark, f"{tmp_path}/e1.csv").columns == ["_extra"]
    (tmp_path / "n.csv").write_text("file;record;archive;member;reason;cells\n1;2;3;4;5;6\n")
    df = R.read_lenient_csv(spark, f"{tmp_path}/n.csv")
    assert [tuple(r)[:6] for r in df.collect()] == [("1", "2", "3", "4", "5", "6")]


def test_archives_with_taken_names_and_empty_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("t.csv", "archive;member;v\nmine;too;1\n")
        z.writestr("empty.csv", "")
        z.writestr("blank.csv", "\n\n")
    tables, manifest = A.load_archives(spark, str(tmp_path))
    t = tables["t"]
    assert t.columns == ["archive", "member", "v", "archive_", "member_", "_extra"]
    assert [tuple(r)[:5] for r in t.collect()] == [("mine", "too", "1", "a.zip", "t.csv")]
    assert tables["empty"].columns == ["archive", "member", "_extra"] and tables["empty"].collect() == []
    assert tables["blank"].collect() == [] and manifest.count() == 3


# --- GeoJSON ------------------------------------------------------------------------------------


def collection(props, **more):
    feats = ",\n ".join(f'{{"type": "Feature", "geometry": {{"type": "Point", "coordinates": [1.5, [2, {{"x": "]}}"}}]]}}, "properties": {p}}}' for p in props)
    return json.dumps(more)[:-1] + (", " if more else "") + f'"type": "FeatureCollection", "features": [{feats}], "name": "x"}}'


def test_geojson_values_as_written(spark, tmp_path):
    one = '{"CODE": "01\\u00e9\\n\\"", "n": 12345678.5, "e": 1e9, "z": -0.0, "big": 123456789012345678901234567890, "t": true, "none": null}'
    two = '{"nested": {"k": [1, 2.50, "a]}"]}, "list": [ ], "code": "x", "": "empty name"}'
    (tmp_path / "a.geojson").write_text(collection([one, two, "null", "{}"], crs={"features": [1]}))
    (tmp_path / "b.geojson").write_text(collection([]))
    (tmp_path / "c.geojson").write_text('{"type": "Feature", "properties": {"CODE": "c"}, "geometry": null}')
    df = G.read_geojson(spark, f"{tmp_path}/*.geojson")
    assert df.columns == ["CODE", "n", "e", "z", "big", "t", "none", "nested", "list", "code_", ""]
    rows = sorted((tuple(r) for r in df.collect()), key=repr)
    want = [
        ('01é\n"', "12345678.5", "1e9", "-0.0", "123456789012345678901234567890", "true", None, None, None, None, None),
        (None, None, None, None, None, None, None, '{"k": [1, 2.50, "a]}"]}', "[ ]", "x", "empty name"),
        (None,) * 11, (None,) * 11,
        ("c",) + (None,) * 10,
    ]
    assert rows == sorted(want, key=repr)
    assert G.read_geojson(spark, f"{tmp_path}/b.geojson").collect() == []


def test_geojson_is_streamed(monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 7)
    text = collection([json.dumps({"k": k, "s": 'a"}{[' * 3}) for k in range(50)], head={"a": ["[", "}"]})
    assert list(G.features(io.BytesIO(text.encode()))) == [{"k": str(k), "s": 'a"}{[' * 3} for k in range(50)]
    held = []
    monkeypatch.setattr(J.Text, "drop", lambda self, at, drop=J.Text.drop: (held.append(len(self.held)), drop(self, at)))
    assert len(list(J.list_objects(io.BytesIO(text.encode()), ["features"]))) == 50
    assert max(held[1:]) < 400  # one feature and one block
    for torn in (text[:-40], text[: len(text) // 2], "[1]"):
        with pytest.raises(J.JsonError):
            list(J.list_objects(io.BytesIO(torn.encode()), ["features"]))


def test_geojson_member_is_chosen_and_read(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("units.geojson", collection(['{"Code Unité": "00851", "Taille": 7.50}', '{"Taille": 1}']))
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("x/list.csv", "Code Unité;Nom\n2;b\n")
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("in.zip", inner.getvalue())
    members = A.list_members(A.archive_index(spark, str(tmp_path)), descend=True)
    df = A.read_chosen(A.first_tabular_member(members))
    assert df.columns == ["code_unite", "taille", "nom", "archive"]
    rows = sorted((tuple(r) for r in df.collect()), key=repr)
    assert rows == sorted([("00851", "7.50", None, "a.zip"), (None, "1", None, "a.zip"), ("2", None, "b", "b.zip")], key=repr)


def test_catalog_responses_are_streams(spark, tmp_path, monkeypatch):
    """``data`` or else ``results``, in either order; places by file name; odd records."""
    from refloom.sources.catalog import read_catalog

    docs = {
        "a": '{"results": [{"id": "no"}], "data": [{"id": "a0", "resources": [{"title": "r]}", "url": null}], "x": 1.50}, {"slug": "a1", "description": "\\u00e9"}]}',
        "b": '{"data": [], "results": [{"id": "b0", "title": "t"}]}', "c": '{"data": []}', "d": '{"total": 0}', "e": '{"results": [{"id": 5, "resources": []}]}',
    }
    for name, text in docs.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows = sorted((r.query_pos, r.item_pos, r.id, r.slug, r.description, r.n_resources) for r in read_catalog(spark, str(tmp_path)).collect())
    assert rows == [(0, 0, "a0", None, None, 1), (0, 1, None, "a1", "é", 0), (1, 0, "b0", None, None, 0), (4, 0, "5", None, None, 0)]


def test_one_large_member_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """Members beyond the bound are staged and read in ranges; the rows are those of the stream."""
    text = "k;v;archive\n" + "".join(f'{k};"line\nbreak é {k}";x\n' for k in range(3_000)) + "1;2;3;4\n"
    for name in ("a", "b"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("t.csv", text)
            z.writestr("sub/small.csv", "k;v\n1;2\n")
    tables, _ = A.load_archives(spark, str(tmp_path))
    want = sorted(map(repr, tables["t"].collect()))
    monkeypatch.setattr(A, "LARGE_MEMBER", 1_000)
    monkeypatch.setattr(R, "RANGE_BYTES", 10_000)
    tables, _ = A.load_archives(spark, str(tmp_path))
    assert sorted(map(repr, tables["t"].collect())) == want and len(want) == 6_002
    used = tables["t"].where("archive_ = 'a.zip'").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(used) == 3_001 and sum(n > 0 for n in used) >= 4
    assert tables["sub_small"].count() == 2
