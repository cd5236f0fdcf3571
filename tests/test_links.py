"""Link functions and per-group choices (cases asserted by the reference's tests)."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from refloom.functions import links as L
from refloom.operators import links as LO

SITE = L.DEFAULT_BASE
BASE = f"{SITE}{L.FILE_PATH}".rstrip("/")


def _best(spark, links, kind, target=2025):
    df = spark.createDataFrame([("g", i, l) for i, l in enumerate(links)], "grp string, pos long, link string")
    r = LO.best_link(df, ["grp"], target_year=target, params=LO.SELECT_FOR_YEAR,
                     preferred_tokens=LO.KIND_TOKENS[kind], accepted_extensions=LO.KIND_EXTENSIONS[kind])
    r = r.select("link", "year", L.clamp_year("year", target).alias("clamped")).collect()
    return (r[0].link, r[0].year, r[0].clamped) if r else None


@pytest.mark.parametrize(
    "links,kind,picked,year",
    [
        # the target year beats the year before, whatever the order
        ([f"{BASE}/31/cog_b_2025.zip", f"{BASE}/31/cog_a_2024.csv"], "codes", "cog_b_2025.zip", 2025),
        # of one year, the better extension; of one extension, the first link
        ([f"{BASE}/32/tuu-2025.xls", f"{BASE}/32/tuu-2025.csv", f"{BASE}/33/tuu-2025.csv"], "units", "32/tuu-2025.csv", 2025),
        # an older year counts as the year before the target
        ([f"{BASE}/34/cog-liste-2023.xlsx"], "codes", "cog-liste-2023.xlsx", 2024),
        # a preferred token outweighs the extension
        ([f"{BASE}/35/plan-2025.csv", f"{BASE}/35/urbaine-2025.zip"], "units", "urbaine-2025.zip", 2025),
    ],
)
def test_link_choice_cases(spark, links, kind, picked, year):
    link, y, clamped = _best(spark, links, kind)
    assert link.endswith(picked) and clamped == year


def test_no_accepted_link_gives_no_row(spark):
    assert _best(spark, [f"{BASE}/1/page.html"], "codes") is None


def test_years_first_seen_no_boundary(spark):
    df = spark.createDataFrame([("/x/2012718_2020_1999_2020.csv",)], "l string")
    r = df.select(L.years("l").alias("y"), L.best_year("l").alias("b")).first()
    assert r.y == [2012, 2020, 1999] and r.b == 2020


def test_strict_and_loose_extraction(spark):
    inside, absolute = f"{L.FILE_PATH}77/mats.zip", f"{BASE}/78/plages.xlsx"
    html = (f"<p><A HREF = '{inside}'>one</A> and <a href=\"/depot/{L.FILE_MARKER}/liste.csv\">two</a>"
            f"<a href='/contact'>three</a></p> four: {absolute} <br>")
    df = spark.createDataFrame([(html,)], "html string")
    first_two = [f"{SITE}{inside}", f"{SITE}/depot/{L.FILE_MARKER}/liste.csv"]
    strict = df.select(LO.candidate_link_array("html").alias("a")).first().a
    assert strict[:2] == first_two and absolute in strict and not any("contact" in x for x in strict)
    loose = df.select(LO.candidate_link_array("html", strict=False).alias("a")).first().a
    assert loose == first_two


def test_sitemap_locs(spark):
    xml = f"<urlset><url><Loc>{SITE}/a/1</lOC></url><url><loc>{SITE}/b</loc></url></urlset>"
    df = spark.createDataFrame([(xml,)], "x string")
    assert df.select(L.sitemap_locs("x").alias("l")).first().l == [f"{SITE}/a/1", f"{SITE}/b"]


def test_join_url_matches_urljoin(spark):
    bases = ["https://b.net", "https://a.org/x/y.html?q=1#f", "https://a.org/1/2/3/4/5/6/7/8/9/z", "https://a.org/x//y/", "http://a.org/x/", "https://a.org"]
    rels = ["/fr/a", "b/c", "../d", "./e", "?z=1", "#top", "//cdn.org/x", "https://o.org/p", "",
            "a/../../b", "/x/./y/../z", "g;p", "..", ".", "../" * 8 + "up", "../" * 12, "a//b/../c", "/a//b/../c", "/" + "../" * 9]
    cases = [(b, r) for b in bases for r in rels]
    df = spark.createDataFrame(cases, "b string, r string")
    got = [row.j for row in df.select(L.join_url(F.col("b"), F.col("r")).alias("j")).collect()]
    assert got == [urljoin(b, r) for b, r in cases]


def test_join_url_on_pages_fixture(spark):
    from refloom.plans.link_queries import url_join

    rows = url_join(spark, "/root/testdata/sf0.001").join(
        spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url"), "page_id"
    ).collect()
    assert rows and all(r.joined == urljoin(r.url, r.href) for r in rows)


def test_keyword_filter_fallback(spark):
    df = spark.createDataFrame(
        [("a", 0, "x/cog_2024.csv"), ("a", 1, "x/other.csv"), ("b", 0, "y/one.csv"), ("b", 1, "y/two.csv")],
        "grp string, pos long, link string",
    )
    out = LO.keyword_filter(df, ["grp"], "link", ("COG", "commune"))
    assert sorted((r.grp, r.pos) for r in out.collect()) == [("a", 0), ("b", 0), ("b", 1)]


def test_first_nonempty_stage_and_prefix(spark):
    df = spark.createDataFrame(
        [("k", 2, "c"), ("k", 1, "b"), ("k", 1, "a"), ("j", 3, "z")], "key string, stage int, item string"
    )
    out = sorted((r.key, r.item) for r in LO.first_nonempty_stage(df, ["key"]).collect())
    assert out == [("j", "z"), ("k", "a"), ("k", "b")]
    items = spark.createDataFrame([("g", i, f"n{i % 4}") for i in range(12)], "g string, pos long, name string")
    got = [(r.name, r.pos) for r in LO.first_seen(items, ["g"], "name", "pos", limit=3).orderBy("rank").collect()]
    assert got == [("n0", 0), ("n1", 1), ("n2", 2)]


def test_enumerate_urls_order(spark):
    t = spark.createDataFrame([("p9", 2030)], "product string, t int")
    rows = LO.enumerate_urls(t, "product", "t", patterns=("m{year}.csv", "n.zip"), years_back=2).orderBy("ord").collect()
    names = ["m2030.csv", "n.zip", "m2029.csv", "n.zip", "m2028.csv", "n.zip"]
    assert [r.url for r in rows] == [f"{BASE}/p9/{n}" for n in names]


def test_redirect_targets_keep_plus(spark):
    df = spark.createDataFrame([("<a href='/go?uddg=https%3A%2F%2Fh.net%2Fone+two%3Fq&amp;k=3'>",)], "h string")
    assert [t.split("&")[0] for t in df.select(L.redirect_targets("h").alias("t")).first().t] == ["https://h.net/one+two?q"]


def test_file_name_from_url(spark):
    df = spark.createDataFrame([("https://x.org/a/b.csv?x=1",), ("https://x.org/a/",), ("",)], "u string")
    assert [r.n for r in df.select(L.file_name_from_url("u").alias("n")).collect()] == ["b.csv", "a", "insee_file"]


def test_enumerate_known_candidates(spark):
    rows = LO.enumerate_known(spark, 2025).orderBy("ord").collect()
    assert len(rows) == 42
    assert [r.url.rsplit("/", 2)[-2:] for r in rows[:2]] == [["2521852", "cog2025.xls"], ["2521852", "cog2025.xlsx"]]
    assert rows[7].url.endswith("/2560452/cog2025.xls") and rows[21].url.endswith("/2521852/cog2024.xls")
    hist = LO.enumerate_known(spark, 2025, "history").orderBy("ord").collect()
    assert hist[0].url.endswith("/8377162/v_commune_depuis_1943.csv") and hist[2].url.endswith("v_mvt_commune_2025.csv")


def test_choose_sources_per_kind(spark):
    rows = [
        ("codes", 1, 0, f"{BASE}/41/cog-2024.xls"),
        ("codes", 2, 0, f"{BASE}/42/cog-2025.csv"),  # a later stage does not count
        ("units", 1, 0, f"{BASE}/43/urbaine-2025.csv"),
        ("history", 0, 0, f"{BASE}/44/mvt-2025.csv"),
        ("history", 1, 0, f"{BASE}/45/historique-1943.csv"),
    ]
    df = spark.createDataFrame(rows, "kind string, stage int, pos long, link string")
    got = {r.kind: (r.link.rsplit("/", 1)[-1], r.selected_year) for r in LO.choose_sources(df, 2025).collect()}
    assert got == {"codes": ("cog-2024.xls", 2024), "units": ("urbaine-2025.csv", 2025), "history": ("mvt-2025.csv", 2025)}


def test_link_rejects(spark):
    df = spark.createDataFrame(
        [("a", 0, f"{BASE}/1/page.html"), ("a", 1, f"{BASE}/1/x.pdf"), ("b", 0, f"{BASE}/2/cog2025.xls")],
        "grp string, pos long, link string",
    )
    rows = LO.link_rejects(df, ["grp"], LO.KIND_EXTENSIONS["codes"]).collect()
    assert [(r.grp, r.n_links) for r in rows] == [("a", 2)]


def test_select_sitemaps_fallback(spark):
    plain = spark.createDataFrame([(i, f"https://x.org/sitemap-{i}.xml") for i in range(10)], "pos long, url string")
    assert sorted(r.pos for r in LO.select_sitemaps(plain).collect()) == [0, 1, 2, 3]
    mixed = spark.createDataFrame(
        [(i, f"https://x.org/{'stat' if i % 2 else 'misc'}-{i}.xml") for i in range(30)], "pos long, url string"
    )
    assert sorted(r.pos for r in LO.select_sitemaps(mixed).collect()) == [1, 3, 5, 7, 9, 11, 13, 15]


def test_known_history_links_skip_keyword_filter(spark):
    rows = [
        ("history", 0, 0, f"{BASE}/8377162/v_mouv_commune_2025.csv"),
        ("history", 0, 1, f"{BASE}/8377162/v_commune_depuis_1943.dbf"),
    ]
    df = spark.createDataFrame(rows, "kind string, stage int, pos long, link string")
    got = LO.choose_sources(df, 2025).first()
    # both known links stay candidates; the csv wins on the extension weight
    assert got.link.endswith("v_mouv_commune_2025.csv") and got.selected_year == 2025


def test_choose_sources_search_stage_uses_its_year(spark):
    # codes: nothing on the direct stages nor in the search for 2025; the search for
    # 2024 finds a file -> generic ranking for 2024, year 2024 (not clamped)
    rows = [("codes", 4, 0, f"{BASE}/905117/liste_2024.csv"), ("codes", 4, 1, f"{BASE}/905117/liste_2023.csv")]
    df = spark.createDataFrame(rows, "kind string, stage int, pos long, link string")
    r = LO.choose_sources(df, 2025).first()
    assert r.link.endswith("liste_2024.csv") and r.selected_year == 2024 and r.score == 1060
    # units found by the second search query: generic ranking, year from the link
    rows = [("units", 3, 0, f"{BASE}/905118/zones_2020_2025.csv")]
    r = LO.choose_sources(spark.createDataFrame(rows, df.schema), 2025).first()
    assert r.link.endswith("zones_2020_2025.csv") and r.selected_year == 2025


def test_collect_candidates_first_stage_and_self_links(spark):
    F_ = "/fr/statistiques/fichier/"
    pages = [
        ("q1", 0, 0, "https://www.insee.fr/fr/recherche?q=x", "<p>nothing</p>"),
        ("q1", 1, 0, "https://www.insee.fr/fr/statistiques/1", f'<a href="{F_}1/a.csv">a</a> <a href="{F_}1/b.csv">b</a>'),
        ("q1", 1, 1, "https://www.insee.fr/fr/statistiques/2", f'<a href="{F_}1/a.csv">a again</a>'),
        ("q1", 2, 0, f"https://www.insee.fr{F_}9/web.zip", "<p>web</p>"),
        ("q2", 0, 0, "https://www.insee.fr/fr/recherche?q=y", "<p>nothing</p>"),
        ("q2", 2, 0, f"https://www.insee.fr{F_}9/web.zip", f'<a href="{F_}9/other.csv">o</a>'),
        ("q3", 3, 0, "https://www.insee.fr/fr/statistiques/5", f'<a href="{F_}5/communes.csv">c</a> <a href="{F_}5/x.csv">x</a>'),
        ("q4", 3, 0, "https://www.insee.fr/fr/statistiques/6", f'<a href="{F_}6/p.csv">p</a> <a href="{F_}6/q.csv">q</a>'),
    ]
    df = spark.createDataFrame(pages, "query string, stage int, page_pos int, page_url string, html string")
    # a keyword in the page text keeps all of the page's links; no keyword hit at all keeps all too
    out = LO.collect_candidates(df, keywords_by_query={"q3": ["communes"], "q4": ["zzz"]})
    got = {}
    for r in out.orderBy("query", "page_pos", "link_pos").collect():
        got.setdefault(r.query, []).append(r.link.rsplit("/", 1)[-1])
    assert got == {"q1": ["a.csv", "b.csv"], "q2": ["web.zip", "other.csv"], "q3": ["communes.csv", "x.csv"],
                   "q4": ["p.csv", "q.csv"]}


def test_self_link_is_not_judged_with_the_links(spark):
    own = f"{BASE}/51/mouvement.html"
    html = f'<a href="{L.FILE_PATH}51/plan.csv">p</a>'
    pages = spark.createDataFrame([("q", 3, 0, own, html)], "query string, stage int, page_pos int, page_url string, html string")
    rows = LO.collect_candidates(pages, keywords_by_query={"q": ["mouvement"]}).orderBy("link_pos").collect()
    assert [(r.link, r.link_pos) for r in rows] == [(own, 0), (f"{BASE}/51/plan.csv", 1)]


def test_kinds_without_a_source_are_named(spark):
    df = spark.createDataFrame([("codes", 0, 0, f"{BASE}/1/cog-2025.csv")], "kind string, stage int, pos long, link string")
    rows = LO.source_rejects(LO.choose_sources(df, 2025)).collect()
    assert sorted((r.kind, r.reason) for r in rows) == [("history", "no source found"), ("units", "no source found")]


def test_fallbacks_keep_rows_with_nulls(spark):
    """Null keys are a group, null links do not hit, a null stage comes last; by broadcast and by shuffle."""
    rows = [("a", 0, "x/table"), ("a", 1, None), ("a", 2, "y"), (None, 0, "z"), (None, 1, "table"), ("b", 0, None), ("b", 1, None), ("c", 0, "q")]
    df = spark.createDataFrame(rows, "grp string, pos int, link string")
    want = [("a", 0), ("b", 0), ("b", 1), ("c", 0), (None, 1)]
    staged = spark.createDataFrame([(None, 1, "x"), (None, 0, "y"), ("a", None, "z"), ("b", 2, "p"), ("b", None, "q")], "key string, stage int, item string")
    limit = LO.BROADCAST_GROUPS
    try:
        for LO.BROADCAST_GROUPS in (limit, 0):
            out = LO.keyword_filter(df, ["grp"], "link", ("TABLE",))
            assert sorted(((r.grp, r.pos) for r in out.collect()), key=repr) == sorted(want, key=repr)
            kept = LO.first_nonempty_stage(staged, ["key"]).collect()
            assert sorted(((r.key, r.item) for r in kept), key=repr) == sorted([(None, "y"), ("a", "z"), ("b", "p")], key=repr)
    finally:
        LO.BROADCAST_GROUPS = limit


def test_best_link_of_null_groups(spark):
    df = spark.createDataFrame([(None, 0, "/f/t_2025.csv"), (None, 1, "/f/t_2024.csv"), ("a", 0, "/f/t_2020.zip")], "grp string, pos int, link string")
    out = LO.best_link(df, ["grp"], target_year=2025, params=LO.PICK_BEST).collect()
    assert {(r.grp, r.link) for r in out} == {(None, "/f/t_2025.csv"), ("a", "/f/t_2020.zip")}


def test_available_by_inventory_is_available_by_candidates(spark):
    import random

    rng = random.Random(3)
    patterns = ("t{year}.csv", "base.zip", "{year}_x_{year}.csv", "u{year}.7z")
    targets = spark.createDataFrame([(p, rng.choice([None, 9, 2023, 2024, 2025]), k) for k, p in enumerate([1, 2, 2, 30, None, 4] * 4)], "product int, t int, k int")
    files = ["t2024.csv", "t2025.csv", "t02024.csv", "t-1.csv", "t9.csv", "t8.csv", "base.zip", "2024_x_2024.csv", "2024_x_2023.csv", "u2023.7z", "u.7z", "t99999999999.csv", "é.csv", "a/t2024.csv"]
    base, path = "https://s.example.org", "/f/"
    urls = [f"{base}{path}{rng.choice([1, 2, 30, 4, '02', ''])}/{f}" for f in files * 6] + [None, base, f"{base}{path}", f"http://o.org{path}1/t2024.csv"]
    inventory = spark.createDataFrame([(u,) for u in urls], "link string")
    args = dict(patterns=patterns, base=base, file_path=path, years_back=2)
    want = LO.available(LO.enumerate_urls(targets, "product", "t", **args), inventory)
    got = LO.available_candidates(targets, "product", "t", inventory, **args)
    assert got.columns == ["product", "t", "k", "year", "ord", "url"]
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == sorted(map(tuple, want.select(*got.columns).collect()), key=repr) and len(rows) > 30
