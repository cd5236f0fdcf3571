"""Text fold (property test against the Unicode decomposition of each character), catalog matching cases."""

import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from refloom.functions import text as T
from refloom.operators import catalog


def ascii_of(ch):
    """What is left of one character: itself if it is ASCII, else what its parts leave."""
    if ch < "\x80":
        return ch
    parts = [p for p in unicodedata.decomposition(ch).split() if p[0] != "<"]
    return "".join(ascii_of(chr(int(p, 16))) for p in parts)


def folded_by_character(text):
    words = "".join(ascii_of(ch) for ch in text).split()
    return " ".join(words).lower()


_BATCH = []


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_fold_property_collect(s):
    _BATCH.append(s)


def test_fold_equals_decomposition_by_character(spark):
    samples = _BATCH + ["Éoliennes & mâts > 9 Mégawatts", "ﬁ ½ Ⅻ ㎏ 𝐀…", "\x1c a　b ", "ǅ™№", ""]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = {r.i: r.f for r in df.select("i", T.fold("s").alias("f")).collect()}
    assert all(got[i] == folded_by_character(s) for i, s in enumerate(samples))


def test_keyword_tokens(spark):
    df = spark.createDataFrame([("Historique des communes 1943 fichier, le MVT",)], "q string")
    assert df.select(T.keyword_tokens("q").alias("k")).first().k == ["historique", "communes", "1943", "mvt"]


def test_identifier(spark):
    df = spark.createDataFrame([("exports/sites",), ("2024 Données__x",), ("---",), ("İx",)], "v string")
    got = [r.t for r in df.select(T.identifier("v").alias("t")).collect()]
    assert got == ["exports_sites", "t_2024_données_x", "table_data", "i̇x"]


def test_resource_filter_and_file_name(spark):
    wanted, other_year = "Références – table des mâts 2031", "Table de référence 2030 (archive)"
    res = spark.createDataFrame(
        [(7, other_year, "https://files.host/x/30", "json"), (8, "Plan de situation 2031", "https://files.host/x/31.png", None),
         (9, wanted, "https://files.host/x/31.tsv?dl=1", "text")],
        "pos long, title string, url string, format string",
    )
    kept = catalog.with_file_names(catalog.matching_resources(res, 2031)).collect()
    assert [(r.pos, r.file_name) for r in kept] == [(9, "references-table-des-mats-2031.tsv")]


def test_safe_file_name_fallbacks(spark):
    res = spark.createDataFrame(
        [(None, "id-1", "https://x.org/d/a.tar.gz", None, None), ("", None, "https://x.org/d/", "ZIP", None),
         ("!!!", None, None, None, None)],
        "title string, id string, url string, format string, type string",
    )
    names = [r.file_name for r in catalog.with_file_names(res).collect()]
    assert names == ["id-1.gz", "resource.zip", "resource.bin"]


def test_best_dataset_and_dedupe(spark):
    d = spark.createDataFrame(
        [
            ("a", None, None, "Installations radioélectriques de plus de 5W", "", 0, 0, 2),
            ("a", None, None, "dup of a", "", 1, 0, 9),
            ("", "", "", "no id 1", "", 0, 1, 0),
            ("", None, "", "no id 2", "", 0, 2, 0),
            ("b", None, None, "installations radioelectriques plus de 5w", "refer", 0, 3, 5),
        ],
        "id string, slug string, page string, title string, description string, query_pos int, item_pos int, n_resources int",
    )
    dd = catalog.dedupe_datasets(d)
    assert dd.count() == 3
    best = catalog.best_dataset(catalog.score_datasets(dd)).first()
    assert best.dataset_key == "b" and best.score == 19


def test_missing_url_rejects(spark):
    res = spark.createDataFrame(
        [("a", "https://x.org/a.csv", None), ("b", None, "https://x.org/latest.csv"), (None, None, None)],
        "title string, url string, latest string",
    )
    ok, rejects = catalog.split_missing_url(res)
    assert sorted(r.title for r in ok.collect()) == ["a", "b"]
    assert [r.reason for r in rejects.collect()] == ["resource '<untitled>' has no URL"]


def test_ordered_listing_missing_title_first(spark):
    res = spark.createDataFrame(
        [(2, "Table de références 2026"), (0, None), (1, "Annexe"), (3, "Annexe")], "pos long, title string"
    )
    assert [r.pos for r in catalog.ordered_listing(res).collect()] == [0, 1, 3, 2]


def test_every_resource_has_its_place_in_the_listing(spark):
    rows = [(i, None if i % 7 == 0 else f"title {i % 5}" if i % 2 else "hot") for i in range(1000)]
    res = spark.createDataFrame(rows, "pos long, title string").repartition(9)
    got = catalog.listing_places(res).collect()
    wanted = sorted(rows, key=lambda r: (r[1] or "", r[0]))
    assert sorted((r.place, r.pos, r.title) for r in got) == [(k, i, t) for k, (i, t) in enumerate(wanted, 1)]
    assert catalog.listing_places(res.limit(0)).count() == 0


def test_the_listing_query_returns_all_resources(spark):
    from refloom.plans import load_all

    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    got = load_all()["resource_listing_whole"].run(spark, sf).collect()
    assert n > 100 and sorted(r.place for r in got) == list(range(1, n + 1))


def test_dedupe_keeps_records_without_a_place(spark):
    """An unknown place comes last, and a dataset whose places are all unknown stays."""
    from refloom.operators import catalog

    rows = [("x", 0, 0, "first"), ("x", None, 3, "again"), ("y", None, None, "only"), ("z", 2, None, "late"), ("z", 2, 5, "early"), (None, None, 1, "bare"), (None, 4, 0, "bare 4")]
    df = spark.createDataFrame(rows, "id string, query_pos int, item_pos int, title string")
    limit = catalog.BROADCAST_KEYS
    try:
        for catalog.BROADCAST_KEYS in (limit, 0):
            out = {r.dataset_key: r.title for r in catalog.dedupe_datasets(df).collect()}
            assert out == {"x": "first", "y": "only", "z": "early", "": "bare 4"}
    finally:
        catalog.BROADCAST_KEYS = limit
