"""Registered queries for the link family (F11-F22, P11-P18, O1, O2, O5, U4, U6, U7,
J4, J5, K5). Inputs are derived from ``pages`` (html, url) and the ``links`` view.

Binding parameters: the pages' hrefs look like ``/de``, so the site layout is
passed as parameters (base, host, file marker, file path) instead of the
reference's defaults.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from refloom.functions import links as L
from refloom.operators import links as LO
from refloom.operators.quality import html_gate_text
from refloom.plans import bindings as B
from refloom.plans.oracle import with_views
from refloom.plans.registry import query
from refloom.plans.text_queries import FOLD, KEYWORDS

BASE, HOST = "https://www.example.org", "www.example.org"
MARKER, FPATH = "de", "/d"
PAGE_PATH, NOT_PAGE_PATH = "/e", "/en"
TARGET = 2025
RELEVANCE_QUERY = "Données des communes: thhewh, enge et ouchan pour historique"
INVENTORY_BASE = "https://data.example.org"

_SP = L.PY_SPACE


def sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


HREF_RE = rf"(?i)href[{_SP}]*=[{_SP}]*['\"]([^'\"]+)['\"]"
BLOB_RE = f"(?i)({re.escape(FPATH)}[^\"'{_SP}<]+)"
ABS_RE = f"(?i)(https?://{re.escape(HOST)}{re.escape(FPATH)}[^\"'{_SP}<]+)"
UNESCAPED = "replace(replace(html, '\\/', '/'), '&amp;', '&')"


def JOIN_BASE(v: str, base: str = BASE) -> str:
    """Oracle join to a path-less base (no dot segments occur in the data)."""
    return (
        f"CASE WHEN regexp_matches({v}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN {v} "
        f"WHEN {v} LIKE '//%' THEN 'https:' || {v} WHEN {v} = '' THEN {sq(base)} "
        f"WHEN {v} LIKE '/%' OR {v} LIKE '?%' OR {v} LIKE '#%' THEN {sq(base)} || {v} "
        f"ELSE {sq(base)} || '/' || {v} END"
    )


def STRICT(v: str) -> str:
    lv = f"lower({v})"
    exts = " OR ".join(f"contains({lv}, {sq(e)})" for e in L.FILE_EXTENSIONS)
    return (
        f"((contains({lv}, {sq(FPATH)}) OR contains({lv}, {sq(MARKER)})) "
        f"AND (contains({lv}, {sq(FPATH)}) OR {exts}))"
    )


def UNNEST(src: str, list_expr: str, keep: str = "page_id") -> str:
    return f"SELECT {keep}, unnest(l) AS v, generate_subscripts(l, 1) AS i FROM (SELECT {keep}, {list_expr} AS l FROM {src})"


def FIRST_SEEN(allk: str, key: str = "page_id") -> str:
    return (
        f"SELECT {key}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY k) - 1 AS INTEGER) AS pos, link "
        f"FROM (SELECT {key}, link, min(k) AS k FROM {allk} GROUP BY {key}, link)"
    )


CANDIDATE_CTES = (
    ("p", f"SELECT page_id, html, {UNESCAPED} AS t FROM pages"),
    ("h", UNNEST("p", f"regexp_extract_all(t, {sq(HREF_RE)}, 1)")),
    ("b", UNNEST("p", f"regexp_extract_all(t, {sq(BLOB_RE)}, 1)")),
    ("a", UNNEST("p", f"regexp_extract_all(t, {sq(ABS_RE)}, 1)")),
    (
        "allk",
        f"""SELECT page_id, {JOIN_BASE('v')} AS link, i AS k FROM h WHERE {STRICT('v')}
            UNION ALL SELECT page_id, {JOIN_BASE('v')}, 1000000 + i FROM b
            UNION ALL SELECT page_id, v, 2000000 + i FROM a""",
    ),
    ("cand", FIRST_SEEN("allk")),
)


def _with(ctes, body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + body


def _pages(spark, sf):
    return B.table(spark, sf, "pages")


def _candidates(spark, sf):
    arr = LO.candidate_link_array("html", base=BASE, host=HOST, marker=MARKER, file_path=FPATH)
    return LO.explode_positions(_pages(spark, sf), ["page_id"], arr)


# ------------------------------------------------------------------ F11
@query(
    "href_links",
    _with((("p", f"SELECT page_id, {UNESCAPED} AS t FROM pages"), ("h", UNNEST("p", f"regexp_extract_all(t, {sq(HREF_RE)}, 1)"))),
          "SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, v AS href FROM h"),
    "F11",
)
def href_links(spark, sf):
    return LO.explode_positions(_pages(spark, sf), ["page_id"], L.hrefs("html"), "href")


@query("candidate_links", _with(CANDIDATE_CTES, "SELECT page_id, pos, link FROM cand"), "F11 F12 F13 P11 U7 U4")
def candidate_links(spark, sf):
    return _candidates(spark, sf)


@query(
    "loose_links",
    _with(
        (("p", f"SELECT page_id, {UNESCAPED} AS t FROM pages"), ("h", UNNEST("p", f"regexp_extract_all(t, {sq(HREF_RE)}, 1)"))),
        f"""SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos,
                   CASE WHEN v LIKE 'http%' THEN v ELSE {sq(BASE)} || v END AS link
            FROM h WHERE contains(lower(v), {sq(FPATH)}) OR contains(lower(v), {sq(MARKER)})""",
    ),
    "P12 F11 F13",
)
def loose_links(spark, sf):
    arr = LO.candidate_link_array("html", base=BASE, host=HOST, marker=MARKER, file_path=FPATH, strict=False)
    return LO.explode_positions(_pages(spark, sf), ["page_id"], arr)


@query(
    "file_links_only",
    _with(CANDIDATE_CTES, f"""SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INTEGER) AS pos, link
                              FROM cand WHERE contains(lower(link), {sq(FPATH + 'e')})"""),
    "P15",
)
def file_links_only(spark, sf):
    arr = LO.candidate_link_array("html", base=BASE, host=HOST, marker=MARKER, file_path=FPATH)
    return LO.explode_positions(_pages(spark, sf), ["page_id"], LO.file_links_only(arr, FPATH + "e"))


# ------------------------------------------------------------------ F16, P14
@query(
    "result_pages",
    _with(
        (
            ("h", UNNEST("pages", "regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)")),
            (
                "allk",
                f"""SELECT page_id, {JOIN_BASE('v')} AS link, i AS k FROM h
                    WHERE contains(lower(v), {sq(PAGE_PATH)}) AND NOT contains(lower(v), {sq(NOT_PAGE_PATH)})""",
            ),
        ),
        FIRST_SEEN("allk"),
    ),
    "F16 P14 U4",
)
def result_pages(spark, sf):
    arr = LO.result_page_array("html", base=BASE, page_path=PAGE_PATH, file_path=NOT_PAGE_PATH)
    return LO.explode_positions(_pages(spark, sf), ["page_id"], arr)


# ------------------------------------------------------------------ F13
_AUTH = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1)"
_BPATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1)"


@query(
    "url_join",
    _with(
        (("p", f"SELECT page_id, url, {UNESCAPED} AS t FROM pages"),
         ("h", UNNEST("p", f"regexp_extract_all(t, {sq(HREF_RE)}, 1)", keep="page_id, url"))),
        f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, v AS href,
                   CASE WHEN regexp_matches(v, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN v
                        WHEN v LIKE '//%' THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1) || ':' || v
                        WHEN v LIKE '/%' THEN {_AUTH} || v
                        WHEN v LIKE '?%' THEN {_AUTH} || {_BPATH} || v
                        ELSE {_AUTH} || regexp_extract({_BPATH}, '^(.*/)', 1) || v END AS joined
            FROM h""",
    ),
    "F13",
)
def url_join(spark, sf):
    p = _pages(spark, sf)
    rows = LO.explode_positions(p, ["page_id", "url"], L.hrefs("html"), "href")
    return rows.select("page_id", "pos", "href", L.join_url(F.col("url"), F.col("href")).alias("joined"))


@query(
    "url_join_deep",
    """SELECT page_id, depth, up, host || '/' || array_to_string(
              list_concat(list_transform(range(greatest(depth - up, 0)), lambda i: 'd' || i), ['z']), '/') AS joined
       FROM (SELECT page_id, page_id % 14 AS depth, page_id % 13 AS up,
                    regexp_extract(url, '^([a-z]+://[^/]*)', 1) AS host FROM pages)""",
    "F13: any number of parent steps",
)
def url_join_deep(spark, sf):
    i = F.col("page_id")
    p = _pages(spark, sf).select("page_id", (i % 14).alias("depth"), (i % 13).alias("up"),
                                 F.regexp_extract("url", "^([a-z]+://[^/]*)", 1).alias("host"))
    folders = F.transform(F.slice(F.sequence(F.lit(0), F.col("depth")), 1, F.col("depth").cast("int")),
                          lambda n: F.concat(F.lit("d"), n.cast("string"), F.lit("/")))
    base = F.concat("host", F.lit("/"), F.array_join(folders, ""), F.lit("page.html"))
    link = F.concat(F.repeat(F.lit("../"), F.col("up").cast("int")), F.lit("z"))
    return p.select("page_id", "depth", "up", L.join_url(base, link).alias("joined"))


# ------------------------------------------------------------------ P13, P16
_KIND = "CASE WHEN grp IN ('g0', 'g1', 'g2') THEN 'codes' WHEN grp IN ('g3', 'g4') THEN 'units' ELSE 'history' END"


def _kind_col():
    g = F.col("grp")
    return F.when(g.isin("g0", "g1", "g2"), "codes").when(g.isin("g3", "g4"), "units").otherwise("history")


_KW_VALUES = ", ".join(f"({sq(k)}, {sq(w)})" for k in ("codes", "units", "history") for w in LO.KIND_KEYWORDS[k])


@query(
    "keyword_filter_fallback",
    with_views(
        ("links",),
        """SELECT grp, pos, link FROM (
             SELECT *, max(hit) OVER (PARTITION BY grp) AS any_hit FROM (
               SELECT l.grp, l.pos, l.link,
                      EXISTS (SELECT 1 FROM kw WHERE kw.kind = l.kind AND contains(lower(l.link), kw.word)) AS hit
               FROM (SELECT *, """ + _KIND + """ AS kind FROM links) l))
           WHERE hit OR NOT any_hit""",
        extra=(("kw", f"SELECT * FROM (VALUES {_KW_VALUES}) t(kind, word)"),),
    ),
    "P13",
)
def keyword_filter_fallback(spark, sf):
    kw_map = F.create_map(
        *[x for k in ("codes", "units", "history") for x in (F.lit(k), F.array(*[F.lit(w) for w in LO.KIND_KEYWORDS[k]]))]
    )
    links = B.links(spark, sf).withColumn("kind", _kind_col())
    return LO.keyword_filter(links, ["grp"], "link", F.element_at(kw_map, F.col("kind"))).select("grp", "pos", "link")


# the oracle's keywords of the query, by the statement of ``query_keywords``
_KW_LIST = f"(SELECT {KEYWORDS(sq(RELEVANCE_QUERY))})"


@query(
    "page_relevance",
    _with(
        CANDIDATE_CTES
        + (
            (
                "flagged",
                f"""SELECT c.page_id, c.pos, c.link,
                           len(list_filter({_KW_LIST}, lambda k: contains({FOLD('c.link')}, k)
                                                              OR contains(pf.folded, k))) > 0 AS hit
                    FROM cand c JOIN (SELECT page_id, {FOLD('html')} AS folded FROM pages) pf USING (page_id)""",
            ),
        ),
        """SELECT page_id, pos, link FROM (
             SELECT *, max(hit) OVER (PARTITION BY page_id) AS any_hit FROM flagged) WHERE hit OR NOT any_hit""",
    ),
    "P16 F10 F2",
)
def page_relevance(spark, sf):
    arr = LO.candidate_link_array("html", base=BASE, host=HOST, marker=MARKER, file_path=FPATH)
    kw = LO.query_keywords(spark, RELEVANCE_QUERY)
    return LO.page_relevance(_pages(spark, sf), ["page_id"], "html", arr, kw)


# ------------------------------------------------------------------ U6, P16: the search chain
# Sixteen queries over the pages, four for each stage that answers them; pages of stage 0
# without a link come before. The last four are judged by keywords.
CHAIN_KEYWORDS = {"q12": ["the"], "q13": ["zzz"], "q14": [], "q15": ["blog", "/de/1"]}
_CHAIN_STAGE = "CASE WHEN page_id % 48 < 16 THEN 0 ELSE page_id % 16 // 4 END"
_CHAIN_HTML = "CASE WHEN page_id % 48 < 16 THEN '' ELSE html END"
_CHAIN_URL = f"CASE WHEN page_id % 3 = 0 THEN {sq(BASE + FPATH)} || 'x/' || page_id || '.zip' ELSE replace(url, {sq(FPATH)}, '/s') END"
_CHAIN_HIT = " OR ".join(
    f"(query = {sq(q)} AND (contains(folded, {sq(w)}) OR contains({FOLD('link')}, {sq(w)})))" for q, ws in CHAIN_KEYWORDS.items() for w in ws
)


@query(
    "search_chain",
    _with(
        (("chain", f"""SELECT page_id, 'q' || page_id % 16 AS query, {_CHAIN_STAGE} AS stage, {_CHAIN_URL} AS page_url,
                              {_CHAIN_HTML} AS html FROM pages"""),)
        + tuple((n, q.replace("FROM pages", "FROM chain")) for n, q in CANDIDATE_CTES)
        + (
            ("judged", f"""SELECT query, stage, page_id, pos, link, stage = 3 AS judged, ({_CHAIN_HIT}) AS hit
                           FROM cand JOIN (SELECT page_id, query, stage, {FOLD('html')} AS folded FROM chain) USING (page_id)"""),
            ("kept", """SELECT query, stage, page_id, pos + 1 AS link_pos, link FROM judged
                        WHERE NOT judged OR hit OR page_id NOT IN (SELECT page_id FROM judged WHERE hit)
                        UNION ALL
                        SELECT query, stage, page_id, 0, page_url FROM chain
                        WHERE stage >= 2 AND contains(lower(page_url), """ + sq(FPATH) + """)"""),
            ("first", "SELECT query, min(stage) AS stage FROM kept GROUP BY query"),
        ),
        """SELECT query, stage, link, min_by(page_id, (page_id, link_pos)) AS page_pos,
                  CAST(min_by(link_pos, (page_id, link_pos)) AS INTEGER) AS link_pos
           FROM kept JOIN first USING (query, stage) GROUP BY query, stage, link""",
    ),
    "U6 U4 P16: first stage with a link, self links, page relevance by query",
)
def search_chain(spark, sf):
    i = F.col("page_id")
    empty = i % 48 < 16
    own = F.concat(F.lit(f"{BASE}{FPATH}x/"), i.cast("string"), F.lit(".zip"))
    pages = _pages(spark, sf).select(
        F.concat(F.lit("q"), (i % 16).cast("string")).alias("query"),
        F.when(empty, 0).otherwise(F.floor(i % 16 / 4)).alias("stage"),
        i.alias("page_pos"),
        F.when(i % 3 == 0, own).otherwise(F.replace("url", F.lit(FPATH), F.lit("/s"))).alias("page_url"),
        F.when(empty, F.lit("")).otherwise(F.col("html")).alias("html"),
    )
    return LO.collect_candidates(pages, CHAIN_KEYWORDS, base=BASE, host=HOST, marker=MARKER, file_path=FPATH)


# ------------------------------------------------------------------ F14, A8, F15, O1, O2, F20-F22
_YEARS = "CAST(regexp_extract_all(lower(link), '(19[0-9]{2}|20[0-9]{2})', 1) AS INTEGER[])"


@query(
    "link_years",
    with_views(
        ("links",),
        f"""SELECT grp, pos, link, list_max(ys) AS best_year, ys[1] AS first_year,
                   CAST(len(list_distinct(ys)) AS INTEGER) AS n_years
            FROM (SELECT *, {_YEARS} AS ys FROM links)""",
    ),
    "F14 A8",
)
def link_years(spark, sf):
    y = L.years("link")
    return B.links(spark, sf).select(
        "grp", "pos", "link", F.array_max(y).alias("best_year"), F.get(y, 0).alias("first_year"),
        F.size(y).alias("n_years"),
    )


def _score_sql(weights, target_bonus, previous_bonus, older, future, tokens, target=TARGET):
    if target is None:
        yp = "0"
    else:
        yp = f"CASE WHEN y IS NULL THEN 0 WHEN y = {target} THEN {target_bonus} "
        if previous_bonus is not None:
            yp += f"WHEN y = {target - 1} THEN {previous_bonus} "
        yp += f"WHEN y <= {target} THEN {older} - abs({target} - y) ELSE {future} - abs({target} - y) END"
    ext = "CASE " + " ".join(f"WHEN lower(link) LIKE '%.{e}' THEN {w}" for e, w in weights) + " ELSE 0 END"
    tok = " + ".join(f"CASE WHEN contains(lower(link), {sq(t)}) THEN 120 ELSE 0 END" for t in tokens) or "0"
    return f"({yp}) + ({ext}) + ({tok})"


def _best_sql(where: str, score: str) -> str:
    return with_views(
        ("links",),
        f"""SELECT grp, link, pos, score, year FROM (
              SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, pos) AS rn FROM (
                SELECT grp, pos, link, y AS year, {score} AS score
                FROM (SELECT *, list_max({_YEARS}) AS y FROM links) WHERE {where}))
            WHERE rn = 1""",
    )


_ACCEPT = " OR ".join(f"lower(link) LIKE '%{e}'" for e in LO.KIND_EXTENSIONS["codes"])
_S4Y = LO.SELECT_FOR_YEAR
_PB = LO.PICK_BEST
BEST_FOR_YEAR_SQL = _best_sql(
    _ACCEPT,
    _score_sql(_S4Y["extension_weights"], _S4Y["target_bonus"], _S4Y["previous_bonus"], _S4Y["older_base"],
               _S4Y["future_base"], LO.KIND_TOKENS["codes"]),
)


def _best_for_year(spark, sf):
    return LO.best_link(
        B.links(spark, sf), ["grp"], target_year=TARGET, params=LO.SELECT_FOR_YEAR,
        preferred_tokens=LO.KIND_TOKENS["codes"], accepted_extensions=LO.KIND_EXTENSIONS["codes"],
    )


@query("best_link_for_year", BEST_FOR_YEAR_SQL, "O1 F15 P17 F14 A8")
def best_link_for_year(spark, sf):
    return _best_for_year(spark, sf)


@query(
    "best_link",
    _best_sql("TRUE", _score_sql(_PB["extension_weights"], _PB["target_bonus"], _PB["previous_bonus"],
                                 _PB["older_base"], _PB["future_base"], ())),
    "O2 F15",
)
def best_link(spark, sf):
    return LO.best_link(B.links(spark, sf), ["grp"], target_year=TARGET, params=LO.PICK_BEST)


@query(
    "best_link_no_year",
    _best_sql("TRUE", _score_sql(_PB["extension_weights"], 0, None, 0, 0, (), target=None)),
    "O2 without a target year (history choice)",
)
def best_link_no_year(spark, sf):
    return LO.best_link(B.links(spark, sf), ["grp"], target_year=None, params=LO.PICK_BEST)


@query(
    "clamped_year",
    "WITH best AS (" + BEST_FOR_YEAR_SQL + f""")
     SELECT grp, link, year,
            greatest(least(coalesce(year, {TARGET}), {TARGET}), {TARGET - 1}) AS selected_year,
            coalesce(year, 1943) AS history_year,
            coalesce(nullif(regexp_extract(regexp_extract(link, '^([^?]*)', 1), '([^/]+)/*$', 1), ''), 'insee_file')
              AS file_name
     FROM best""",
    "F20 F21 F22",
)
def clamped_year(spark, sf):
    b = _best_for_year(spark, sf)
    return b.select(
        "grp", "link", "year", L.clamp_year("year", TARGET).alias("selected_year"),
        L.default_year("year", 1943).alias("history_year"), L.file_name_from_url("link").alias("file_name"),
    )


# ------------------------------------------------------------------ J4, J5
def _targets(spark, sf):
    return B.links(spark, sf).select("grp", "pos", L.best_year("link").alias("target_year"))


def _enum_sql(patterns) -> str:
    pv = ", ".join(f"({i}, {sq(p)})" for i, p in enumerate(patterns))
    return f"""SELECT t.grp, t.pos, y.year, CAST(y.yi * {len(patterns)} + pt.pi AS INTEGER) AS ord,
                      {sq(INVENTORY_BASE + L.FILE_PATH)} || CAST(t.pos AS VARCHAR) || '/'
                      || replace(pt.pattern, '{{year}}', CAST(y.year AS VARCHAR)) AS url
               FROM (SELECT grp, pos, list_max({_YEARS}) AS target_year FROM links) t,
                    LATERAL (SELECT CAST(t.target_year - r.k AS INTEGER) AS year, r.k AS yi FROM range(0, 2) r(k)) y,
                    (VALUES {pv}) pt(pi, pattern)"""


@query("candidate_enumeration", with_views(("links",), _enum_sql(LO.KNOWN_CODE_PATTERNS)), "J4")
def candidate_enumeration(spark, sf):
    return LO.enumerate_urls(_targets(spark, sf), "pos", "target_year", LO.KNOWN_CODE_PATTERNS, base=INVENTORY_BASE).drop(
        "target_year"
    )


@query("history_candidates", with_views(("links",), _enum_sql(LO.KNOWN_HISTORY_PATTERNS)), "J4 (history patterns)")
def history_candidates(spark, sf):
    return LO.enumerate_urls(
        _targets(spark, sf), "pos", "target_year", LO.KNOWN_HISTORY_PATTERNS, base=INVENTORY_BASE
    ).drop("target_year")


@query(
    "available_candidates",
    with_views(("links",), "SELECT * FROM (" + _enum_sql(LO.KNOWN_CODE_PATTERNS) + ") c WHERE url IN (SELECT link FROM links)"),
    "J5 by the enumerated candidates",
)
def available_candidates(spark, sf):
    cands = candidate_enumeration(spark, sf)
    return LO.available(cands, B.links(spark, sf), "url", "link").select(*cands.columns)


@query(
    "available_by_inventory",
    with_views(("links",), "SELECT * FROM (" + _enum_sql(LO.KNOWN_CODE_PATTERNS) + ") c WHERE url IN (SELECT link FROM links)"),
    "J4 J5 by the inventory, read backwards",
)
def available_by_inventory(spark, sf):
    return LO.available_candidates(
        _targets(spark, sf), "pos", "target_year", B.links(spark, sf), LO.KNOWN_CODE_PATTERNS, base=INVENTORY_BASE
    ).drop("target_year")


# ------------------------------------------------------------------ U6, O5
_STAGE = f"CASE WHEN y = {TARGET} THEN 0 WHEN y = {TARGET - 1} THEN 1 ELSE 2 END"


@query(
    "first_nonempty_stage",
    with_views(
        ("links",),
        f"""SELECT grp, pos, link, stage FROM (
              SELECT *, min(stage) OVER (PARTITION BY grp) AS first_stage FROM (
                SELECT grp, pos, link, {_STAGE} AS stage FROM (SELECT *, list_max({_YEARS}) AS y FROM links)
                WHERE {_ACCEPT}))
            WHERE stage = first_stage""",
    ),
    "U6 X4",
)
def first_nonempty_stage(spark, sf):
    y = L.best_year("link")
    staged = (
        B.links(spark, sf)
        .filter(L.ends_with_any("link", LO.KIND_EXTENSIONS["codes"]))
        .withColumn("stage", F.when(y == TARGET, 0).when(y == TARGET - 1, 1).otherwise(2))
    )
    return LO.first_nonempty_stage(staged, ["grp"]).select("grp", "pos", "link", "stage")


@query(
    "limited_prefix",
    with_views(
        ("links",),
        """SELECT grp, name, pos, rank FROM (
             SELECT grp, name, pos, CAST(row_number() OVER (PARTITION BY grp ORDER BY pos, name) AS INTEGER) AS rank
             FROM (SELECT grp, name, min(pos) AS pos FROM (
                     SELECT grp, pos, coalesce(nullif(regexp_extract(regexp_extract(link, '^([^?]*)', 1),
                                                                     '([^/]+)/*$', 1), ''), 'insee_file') AS name
                     FROM links) GROUP BY grp, name))
           WHERE rank <= 10""",
    ),
    "O5 U4 F22",
)
def limited_prefix(spark, sf):
    named = B.links(spark, sf).withColumn("name", L.file_name_from_url("link"))
    return LO.first_seen(named, ["grp"], "name", "pos", limit=10).select("grp", "name", "pos", "rank")


# ------------------------------------------------------------------ F17, F18, F19, P18, K5
def _sitemap_xml(spark, sf):
    p = _pages(spark, sf)
    xml = F.regexp_replace("html", r'href="([^"]*)"', f"<loc>{BASE}$1</loc>")
    return p.select(F.col("page_id").alias("pos"), "url", xml.alias("xml"))


_XML = f"regexp_replace(html, 'href=\"([^\"]*)\"', '<loc>{BASE}\\1</loc>', 'g')"
_LOCS = UNNEST(f"(SELECT page_id, {_XML} AS xml FROM pages)", "regexp_extract_all(xml, '(?i)<loc>([^<]+)</loc>', 1)")


@query(
    "sitemap_locs",
    _with((("lx", _LOCS),), "SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, v AS loc FROM lx"),
    "F17",
)
def sitemap_locs(spark, sf):
    x = _sitemap_xml(spark, sf)
    return x.select(F.col("pos").alias("page_id"), F.posexplode(L.sitemap_locs("xml")).alias("pos", "loc"))


@query(
    "sitemap_pages",
    _with(
        (
            ("lx", _LOCS),
            ("likely", """SELECT page_id FROM pages
                          WHERE contains(lower(url), 'stat') OR contains(lower(url), 'information') OR contains(lower(url), 'fr')
                          ORDER BY page_id LIMIT 8"""),
            ("chosen", """SELECT page_id FROM likely UNION ALL
                          SELECT * FROM (SELECT page_id FROM pages ORDER BY page_id LIMIT 4)
                          WHERE NOT EXISTS (SELECT 1 FROM likely)"""),
        ),
        """SELECT page_id AS pos, CAST(i - 1 AS INTEGER) AS loc_pos, v AS loc FROM lx
           WHERE page_id IN (SELECT page_id FROM chosen) AND (contains(lower(v), '/de') OR contains(lower(v), '/the'))
           ORDER BY page_id, i LIMIT 12""",
    ),
    "F18 P14 F17 O5",
)
def sitemap_pages(spark, sf):
    x = _sitemap_xml(spark, sf)
    chosen = LO.select_sitemaps(x.select("pos", "url"))
    locs = x.select("pos", F.posexplode(L.sitemap_locs("xml")).alias("loc_pos", "loc"))
    return LO.sitemap_pages(chosen, locs, max_pages=12, page_path="/de", info_path="/the")


_REDIRECT_HTML = (
    "regexp_replace(html, 'href=\"/([^\"]*)\"', "
    "'href=\"/l/?uddg=https%3A%2F%2Fwww.example.org%2F\\1&amp;rut=x\"', 'g')"
)


@query(
    "redirect_decode",
    _with(
        (
            ("r", UNNEST(f"(SELECT page_id, {_REDIRECT_HTML} AS html FROM pages)",
                         "regexp_extract_all(html, 'uddg=([^&\"'']+)', 1)")),
            ("d", f"""SELECT page_id, url_decode(v) AS link, i AS k FROM r
                      WHERE contains(lower(url_decode(v)), {sq(HOST)})
                        AND (contains(lower(url_decode(v)), '/d') OR contains(lower(url_decode(v)), '/e'))"""),
        ),
        "SELECT * FROM (" + FIRST_SEEN("d") + ") WHERE pos < 10",
    ),
    "F19 U4 O5",
)
def redirect_decode(spark, sf):
    p = _pages(spark, sf)
    html = F.regexp_replace("html", r'href="/([^"]*)"', 'href="/l/?uddg=https%3A%2F%2Fwww.example.org%2F$1&amp;rut=x"')
    t = F.filter(L.redirect_targets(html), lambda u: F.lower(u).contains(HOST))
    t = F.filter(t, lambda u: L.contains_any(u, ("/d", "/e")))
    rows = p.select("page_id", F.posexplode(t).alias("i", "link"))
    return LO.first_seen(rows, ["page_id"], "link", "i", limit=10).select(
        "page_id", (F.col("rank") - 1).alias("pos"), "link"
    )


def _responses(spark, sf):
    p = _pages(spark, sf)
    k = F.col("page_id")
    endpoint = F.concat(F.lit(BASE + L.FILE_PATH), k.cast("string"))
    final = (
        F.when(k % 3 == 0, endpoint)
        .when(k % 3 == 1, F.concat(endpoint, F.lit("/data_"), k.cast("string"), F.lit(".csv")))
        .otherwise(F.col("url"))
    )
    ctype = F.when(k % 4 == 0, "text/csv").when(k % 4 == 1, "text/html").when(k % 4 == 2, "application/zip")
    cdisp = F.when(k % 5 == 0, "attachment; filename=x.csv").otherwise("")
    return p.select("page_id", endpoint.alias("endpoint_url"), final.alias("final_url"), ctype.alias("content_type"),
                    cdisp.alias("content_disposition"), F.col("html").alias("body"))


@query(
    "response_links",
    _with(
        (
            ("resp", f"""SELECT page_id, {sq(BASE + L.FILE_PATH)} || CAST(page_id AS VARCHAR) AS endpoint_url,
                                CASE page_id % 3 WHEN 0 THEN {sq(BASE + L.FILE_PATH)} || CAST(page_id AS VARCHAR)
                                                 WHEN 1 THEN {sq(BASE + L.FILE_PATH)} || CAST(page_id AS VARCHAR)
                                                             || '/data_' || CAST(page_id AS VARCHAR) || '.csv'
                                                 ELSE url END AS final_url,
                                CASE page_id % 4 WHEN 0 THEN 'text/csv' WHEN 1 THEN 'text/html'
                                                 WHEN 2 THEN 'application/zip' END AS content_type,
                                CASE WHEN page_id % 5 = 0 THEN 'attachment; filename=x.csv' ELSE '' END
                                  AS content_disposition
                         FROM pages"""),
        )
        + CANDIDATE_CTES[:-1]
        + (
            (
                "allk2",
                f"""SELECT page_id, final_url AS link, 0 AS k FROM resp
                    WHERE final_url <> endpoint_url AND contains(lower(final_url), {sq(L.FILE_PATH)})
                    UNION ALL
                    SELECT page_id, final_url, 1 FROM resp
                    WHERE contains(lower(coalesce(content_type, '')), 'csv') OR contains(lower(coalesce(content_type, '')), 'excel')
                       OR contains(lower(coalesce(content_type, '')), 'zip') OR contains(lower(content_disposition), 'filename=')
                    UNION ALL SELECT page_id, link, 10 + k FROM allk""",
            ),
        ),
        FIRST_SEEN("allk2"),
    ),
    "P18 U4",
)
def response_links(spark, sf):
    r = _responses(spark, sf)
    arr = LO.response_link_array(
        F.col("endpoint_url"), F.col("final_url"), F.col("content_type"), F.col("content_disposition"), F.col("body"),
        file_path=L.FILE_PATH, body_kw={"base": BASE, "host": HOST, "marker": MARKER, "file_path": FPATH},
    )
    return LO.explode_positions(r, ["page_id"], arr)


_GATE = (
    "coalesce((instr(lower({x}), '<html') > 0 AND strlen(left({x}, instr(lower({x}), '<html') + 4)) <= 4096)"
    " OR (instr(lower({x}), '<!doctype html') > 0"
    " AND strlen(left({x}, instr(lower({x}), '<!doctype html') + 13)) <= 4096), false)"
)


@query(
    "html_gate",
    f"""SELECT 'page' AS kind, page_id AS id, {_GATE.format(x='html')} AS looks_html FROM pages
        UNION ALL SELECT 'document', doc_id, {_GATE.format(x='text')} FROM documents""",
    "K5",
)
def html_gate(spark, sf):
    pages = _pages(spark, sf).select(F.lit("page").alias("kind"), F.col("page_id").alias("id"),
                                     html_gate_text(F.col("html")).alias("looks_html"))
    docs = B.table(spark, sf, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"),
                                                  html_gate_text(F.col("text")).alias("looks_html"))
    return pages.unionByName(docs)


# ------------------------------------------------------------------ X4
_STAGE_BY_NAME = "CASE WHEN contains(link, '/map_') THEN 0 WHEN contains(link, '/cog_') THEN 1 ELSE 2 END"


def _source_rows(spark, sf):
    l = F.col("link")
    stage = F.when(l.contains("/map_"), 0).when(l.contains("/cog_"), 1).otherwise(2)
    return B.links(spark, sf).select(_kind_col().alias("kind"), stage.alias("stage"), "pos", "link")


def _kind_rank_sql() -> str:
    """Per (kind, stage) ranking, restated from the rule table."""
    parts = []
    for r in LO.SOURCE_RULES:
        p = r["params"]
        target = None if r["target"] is None else TARGET + r["target"]
        score = _score_sql(p["extension_weights"], p["target_bonus"], p["previous_bonus"], p["older_base"],
                           p["future_base"], r["tokens"], target=target)
        acc = " OR ".join(f"lower(link) LIKE '%{e}'" for e in r["extensions"]) or "TRUE"
        if r["year"] == "clamp":
            sel = f"greatest(least(coalesce(y, {target}), {target}), {target - 1})"
        elif r["year"] == "target":
            sel = f"coalesce(y, {target})"
        else:
            sel = f"coalesce(y, {int(r['year'])})"
        lo, hi = r["stages"]
        parts.append(
            f"SELECT kind, stage, pos, link, y AS year, {score} AS score, {sel} AS selected_year FROM kept "
            f"WHERE kind = {sq(r['kind'])} AND stage BETWEEN {lo} AND {hi} AND ({acc})"
        )
    return " UNION ALL ".join(parts)


def _kw_rows() -> str:
    rows = []
    for r in LO.SOURCE_RULES:
        for w in r["keywords"] or ():
            rows.append(f"({sq(r['kind'])}, {r['stages'][0]}, {r['stages'][1]}, {sq(w)})")
    return ", ".join(rows)


@query(
    "source_choice",
    with_views(
        ("links",),
        """SELECT kind, stage, link, pos, score, year, selected_year
           FROM ranked QUALIFY row_number() OVER (PARTITION BY kind ORDER BY score DESC, pos) = 1""",
        extra=(
            ("kw", f"SELECT * FROM (VALUES {_kw_rows()}) t(kind, lo, hi, word)"),
            ("src", f"SELECT {_KIND} AS kind, {_STAGE_BY_NAME} AS stage, pos, link FROM links"),
            ("staged", "SELECT * FROM (SELECT *, min(stage) OVER (PARTITION BY kind) AS s0 FROM src) WHERE stage = s0"),
            ("flagged", """SELECT s.*, EXISTS (SELECT 1 FROM kw WHERE kw.kind = s.kind AND s.stage BETWEEN kw.lo AND kw.hi
                                               AND contains(lower(s.link), kw.word)) AS hit
                           FROM staged s"""),
            ("kept", f"""SELECT kind, stage, pos, link, list_max({_YEARS}) AS y FROM (
                           SELECT *, max(hit) OVER (PARTITION BY kind) AS any_hit FROM flagged) WHERE hit OR NOT any_hit"""),
            ("ranked", _kind_rank_sql()),
        ),
    ),
    "X4 U6 P13 O1 O2 F20 F21",
)
def source_choice(spark, sf):
    return LO.choose_sources(_source_rows(spark, sf), TARGET)


@query(
    "link_rejects",
    with_views(
        ("links",),
        f"""SELECT grp, year, count(*) AS n_links, 'no link with an accepted extension' AS reason
            FROM (SELECT grp, link, list_max({_YEARS}) AS year FROM links)
            GROUP BY grp, year HAVING NOT bool_or(lower(link) LIKE '%.csv')""",
    ),
    "Quirk 16: reject rows per group without an accepted link",
)
def link_rejects(spark, sf):
    keyed = B.links(spark, sf).withColumn("year", L.best_year("link"))
    return LO.link_rejects(keyed, ["grp", "year"], (".csv",))
