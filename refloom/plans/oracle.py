"""Oracle SQL (DuckDB dialect) for every registered query.

Each statement inlines the fixture views of ``refloom.plans.bindings`` as CTEs
over the pre-registered driver tables, then states the operator's semantics in
plain SQL, independently of the Spark code.
"""

from __future__ import annotations

# The code pattern (five digits, or 2A/2B and three digits), full match.
REF_CODE_RE = "^[0-9]{5}$|^2[AB][0-9]{3}$"


def CODE(k: str) -> str:
    return (
        f"CASE WHEN {k}%97=0 THEN 'X'||CAST({k} AS VARCHAR) "
        f"WHEN {k}%50=7 THEN '2A'||lpad(CAST({k}%1000 AS VARCHAR),3,'0') "
        f"ELSE lpad(CAST(({k}*67)%99000 AS VARCHAR),5,'0') END"
    )


def VALID(c: str) -> str:
    return f"regexp_full_match(CAST({c} AS VARCHAR), '{REF_CODE_RE}')"


VIEWS: dict[str, str] = {
    "cog_raw": f"""
        SELECT {CODE('c_custkey')} AS com,
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'COM' WHEN 'MACHINERY' THEN 'ARM'
                                 WHEN 'BUILDING' THEN 'comd' WHEN 'AUTOMOBILE' THEN 'COMA' END AS typecom,
               CASE WHEN c_custkey%10=3 THEN '  '
                    WHEN c_mktsegment IN ('MACHINERY','BUILDING') THEN {CODE('(c_custkey//10)')} END AS comparent
        FROM customer""",
    "uu_raw": f"""
        SELECT CASE WHEN p_partkey%3<>0 THEN {CODE('p_partkey')} ELSE 'X'||CAST(p_partkey AS VARCHAR) END AS codgeo,
               CAST(p_size%9 AS VARCHAR) AS tuu2020, p_brand AS tduu2020 FROM part
        UNION ALL
        SELECT CASE WHEN p_partkey%40=1 THEN {CODE('p_partkey')} ELSE 'X'||CAST(p_partkey AS VARCHAR) END,
               'dup', p_brand FROM part""",
    "history_raw": f"""
        SELECT {CODE('p_partkey')} AS com_av, {CODE('(p_partkey*2)')} AS com_ap FROM part""",
    "history_snapshot": f"""
        SELECT {CODE('o_custkey')} AS COM,
               strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS DATE_DEBUT,
               strftime(CAST(o_orderdate AS DATE) + 365, '%Y-%m-%d') AS DATE_FIN
        FROM orders""",
    "links": """
        SELECT 'g'||CAST(page_id%7 AS VARCHAR) AS grp, page_id AS pos,
               'https://data.example.org/fr/statistiques/fichier/'||CAST(page_id AS VARCHAR)
               ||CASE WHEN contains(url, '/en/') THEN '/cog_' WHEN contains(url, '/fr/') THEN '/base_tu_2020_' ELSE '/map_' END
               ||CAST(2015+length(html)%15 AS VARCHAR)
               ||CASE WHEN contains(url, '?page') THEN '.csv' WHEN contains(url, '?utm') THEN '.xlsx'
                      WHEN contains(url, '#') THEN '.xls' WHEN url LIKE '%/' THEN '.zip'
                      WHEN url LIKE '%.html' THEN '.html' ELSE '.csv' END AS link
        FROM pages""",
    "members": """
        SELECT regexp_replace(regexp_replace(url,'^https?://',''),'/.*$','') AS archive,
               regexp_replace(regexp_replace(url,'^https?://[^/]+/',''),'[?#].*$','')
               ||'/Données-'||CAST(page_id%4 AS VARCHAR)||'.CSV' AS member
        FROM pages""",
    "datasets": """
        SELECT CASE WHEN doc_id%11=0 THEN '' ELSE concat_ws('-', source, lang) END AS id,
               CASE WHEN doc_id%13=0 THEN NULL ELSE source END AS slug,
               'p'||CAST(doc_id AS VARCHAR) AS page,
               CASE doc_id%5 WHEN 0 THEN 'Installations radioélectriques de plus de 5W'
                             WHEN 1 THEN 'Données  radioélectriques 5w'
                             WHEN 2 THEN 'Table de références'
                             ELSE concat_ws(' ', 'Corpus', source, lang) END AS title,
               text AS description, doc_id%7 AS query_pos, doc_id AS item_pos, doc_id%4 AS n_resources
        FROM documents""",
    "resources": """
        SELECT source AS dataset_id, doc_id AS pos,
               CASE doc_id%3 WHEN 0 THEN 'Table de références '||CAST(2020+doc_id%8 AS VARCHAR)
                             WHEN 1 THEN 'Cartographie '||CAST(2020+doc_id%8 AS VARCHAR)
                             ELSE concat_ws(' ', lang, CAST(doc_id AS VARCHAR)) END AS title,
               'https://data.example.org/d/'||CAST(doc_id AS VARCHAR)
               ||CASE doc_id%3 WHEN 0 THEN '.csv' WHEN 1 THEN '.tar.gz' ELSE '' END AS url,
               CASE doc_id%2 WHEN 0 THEN 'CSV' ELSE '' END AS format
        FROM documents""",
    "described": """
        SELECT doc_id AS pos, CASE WHEN doc_id%5 > 0 THEN 'Liste '||CAST(doc_id AS VARCHAR) END AS title, text AS description,
               CASE WHEN doc_id%2 = 0 THEN 'TABLE' END AS type, CASE WHEN doc_id%7 > 0 THEN lang END AS format,
               CASE WHEN doc_id%3 = 0 THEN 'text/référence' END AS mime, source AS url,
               'https://data.example.org/'||CAST(2020+doc_id%8 AS VARCHAR) AS latest
        FROM documents""",
}

# Derived relations, as sets: each statement says which rows belong to the result, not the
# steps by which the operators get there.
_CODE_ROWS = f"SELECT DISTINCT com, typecom, comparent FROM cog_raw WHERE {VALID('com')}"
_MOVES = "list_contains(['arm', 'comd'], lower(typecom)) AND regexp_matches(comparent, '[^ ]')"
MAX_DEPTH = 20


def _steps() -> dict[str, str]:
    """Pairs of codes 1 to 20 steps apart, by halving: a walk of d steps is one of d // 2
    steps and one of the rest."""
    out = {"walk1": "SELECT old_code AS o, new_code AS c FROM edges"}
    for d in range(2, MAX_DEPTH + 1):
        out[f"walk{d}"] = f"SELECT DISTINCT a.o, b.c FROM walk{d // 2} a JOIN walk{d - d // 2} b ON a.c = b.o"
    out["steps"] = " UNION ALL ".join(
        f"SELECT o AS origin_code, c AS current_code, {d} AS depth FROM walk{d}" for d in range(1, MAX_DEPTH + 1)
    )
    return out


def MAPPING(pairs: str) -> str:
    """The mapping over (cog_initial, cog_reference) pairs: rows with a unit, and the others."""
    return f"""
        SELECT cog_initial, cog_reference, tuu, tduu, 2025 AS cog_year, 2025 AS target_year
        FROM {pairs} JOIN units ON code = cog_reference
        UNION ALL
        SELECT cog_initial, cog_reference, NULL, NULL, 2025, 2025
        FROM {pairs} ANTI JOIN units ON code = cog_reference"""


def PAIRS(history: str) -> str:
    """Pairs of the code list, districts as themselves, and codes that only the history knows."""
    return f"""
        SELECT code AS cog_initial, reference_code AS cog_reference FROM resolved
        UNION SELECT cog_initial, cog_reference FROM districts
        UNION SELECT code, code FROM (SELECT code FROM {history} EXCEPT SELECT code FROM resolved)"""


MAP_COLS = "cog_initial, cog_reference, tuu, tduu, cog_year, target_year"
METRO = "list_contains(list_concat(list_transform(range(1, 96), lambda i: printf('%02d', i)), ['2A', '2B']), cog_initial[1:2])"

DERIVED: dict[str, str] = {
    "moved": f"SELECT * FROM ({_CODE_ROWS}) WHERE {_MOVES}",
    "resolved": f"""
        SELECT com AS code, comparent AS reference_code, typecom AS type_code, comparent AS parent_code FROM moved
        UNION ALL
        SELECT com, com, typecom, comparent FROM ({_CODE_ROWS} EXCEPT SELECT * FROM moved)""",
    "districts": """
        SELECT code AS cog_initial, code AS cog_reference FROM resolved
        INTERSECT SELECT com, com FROM cog_raw WHERE typecom ILIKE 'arm'""",
    "units": f"SELECT DISTINCT codgeo AS code, tuu2020 AS tuu, tduu2020 AS tduu FROM uu_raw WHERE {VALID('codgeo')}",
    "edges": f"""
        SELECT com_av AS old_code, com_ap AS new_code FROM history_raw
        WHERE {VALID('com_av')} AND {VALID('com_ap')}
        EXCEPT SELECT com_av, com_av FROM history_raw""",
    **_steps(),
    "terminal": """
        SELECT origin_code, min(current_code) AS current_code, depth FROM steps
        WHERE (origin_code, depth) IN (SELECT origin_code, max(depth) FROM steps GROUP BY origin_code)
        GROUP BY origin_code, depth""",
    "hist_codes": "SELECT DISTINCT unnest([old_code, new_code]) AS code FROM edges",
    "snap_codes": f"SELECT DISTINCT COM AS code FROM history_snapshot WHERE {VALID('COM')}",
    "no_codes": "SELECT com AS code FROM cog_raw LIMIT 0",
    **{
        f"{kind}_{what}": sql
        for kind, history in (("event", "hist_codes"), ("snap", "snap_codes"), ("none", "no_codes"))
        for what, sql in (("pairs", PAIRS(history)), ("map", MAPPING(f"{kind}_pairs")))
    },
}

# Dependencies between the named relations above (for assembling the WITH list).
DEPS: dict[str, tuple[str, ...]] = {
    "moved": ("cog_raw",),
    "resolved": ("cog_raw", "moved"),
    "districts": ("resolved",),
    "units": ("uu_raw",),
    "edges": ("history_raw",),
    "walk1": ("edges",),
    **{f"walk{d}": (f"walk{d // 2}", f"walk{d - d // 2}") for d in range(2, MAX_DEPTH + 1)},
    "steps": tuple(f"walk{d}" for d in range(1, MAX_DEPTH + 1)),
    "terminal": ("steps",),
    "hist_codes": ("edges",),
    "snap_codes": ("history_snapshot",),
    "no_codes": ("cog_raw",),
    **{
        f"{kind}_{what}": needs
        for kind, history in (("event", "hist_codes"), ("snap", "snap_codes"), ("none", "no_codes"))
        for what, needs in (("pairs", (history, "resolved", "districts")), ("map", (f"{kind}_pairs", "units")))
    },
}


def _closure(names: tuple[str, ...]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, ()):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return order


def with_views(uses: tuple[str, ...], body: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """``WITH <views used, in dependency order>, <extra> <body>``."""
    parts = []
    for n in _closure(uses):
        sql = VIEWS.get(n) or DERIVED[n]
        parts.append(f"{n} AS MATERIALIZED ({sql})" if n.startswith("walk") else f"{n} AS ({sql})")
    for n, sql in extra:
        parts.append(f"{n} AS ({sql})")
    return "WITH " + ",\n".join(parts) + "\n" + body
