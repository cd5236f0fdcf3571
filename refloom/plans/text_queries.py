"""Registered queries for text functions (F2, F3, F10) and catalog matching."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from refloom.functions.text import STOPWORDS, concat_truthy, fold, keyword_tokens
from refloom.operators import catalog
from refloom.plans import bindings as B
from refloom.plans.oracle import with_views
from refloom.plans.registry import query

RESOURCE_YEAR = 2026
# The best dataset of the fixture publishes reference tables for 2027, so the
# composite is run for that year (its resources for 2026 do not exist).
COMPOSITE_YEAR = 2027


def FOLD(x: str) -> str:
    """Oracle fold: accents stripped by the SQL engine, then ASCII-only, whitespace, trim, lower."""
    return (
        rf"lower(trim(regexp_replace(regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g'), "
        rf"'[\t\n\x0B\f\r \x1C-\x1F]+', ' ', 'g')))"
    )


def TRUTHY(*cols: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"nullif({c}, '')" for c in cols) + ")"


_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"


@query("text_fold", f"SELECT doc_id, {FOLD('text')} AS folded FROM documents", "F2")
def text_fold(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", fold("text").alias("folded"))


def KEYWORDS(x: str) -> str:
    return (
        f"list_filter(regexp_extract_all({FOLD(x)}, '([a-zA-Z0-9]+)', 1), "
        f"lambda t: length(t) >= 3 AND NOT list_contains({_STOP_SQL}, t))"
    )


@query(
    "query_keywords",
    f"""SELECT doc_id, CAST(len(k) AS INTEGER) AS n_keywords, array_to_string(k, ' ') AS keywords
        FROM (SELECT doc_id, {KEYWORDS('text')} AS k FROM documents)""",
    "F10",
)
def query_keywords(spark, sf):
    k = keyword_tokens("text")
    return (
        B.table(spark, sf, "documents")
        .select("doc_id", k.alias("k"))
        .select("doc_id", F.size("k").alias("n_keywords"), F.array_join("k", " ").alias("keywords"))
    )


@query(
    "field_concat",
    with_views(("datasets",), f"SELECT item_pos, {TRUTHY('title', 'description', 'slug', 'page')} AS searchable FROM datasets"),
    "F3",
)
def field_concat(spark, sf):
    d = B.datasets(spark, sf)
    return d.select("item_pos", concat_truthy("title", "description", "slug", "page").alias("searchable"))


_DEDUP = (
    (
        "dedup",
        """SELECT * EXCLUDE (rn) FROM (
             SELECT *, row_number() OVER (PARTITION BY dataset_key ORDER BY query_pos, item_pos) AS rn
             FROM (SELECT *, coalesce(nullif(id, ''), nullif(slug, ''), nullif(page, ''), '') AS dataset_key
                   FROM datasets)) WHERE rn = 1""",
    ),
    (
        "scored",
        f"""SELECT *, (CASE WHEN contains(t, 'installation') THEN 3 ELSE 0 END
                     + CASE WHEN contains(t, 'radioelectrique') THEN 4 ELSE 0 END
                     + CASE WHEN contains(t, '5w') THEN 5 ELSE 0 END
                     + CASE WHEN contains(t, 'plus de 5w') THEN 6 ELSE 0 END
                     + CASE WHEN contains(t, 'refer') THEN 1 ELSE 0 END) AS score
            FROM (SELECT *, {FOLD(TRUTHY('title', 'description', 'slug', 'page'))} AS t FROM dedup)""",
    ),
)
_DS_COLS = "dataset_key, id, slug, page, title, query_pos, item_pos, n_resources"


@query("dataset_dedupe", with_views(("datasets",), f"SELECT {_DS_COLS} FROM dedup", extra=_DEDUP[:1]), "U5 F5")
def dataset_dedupe(spark, sf):
    return catalog.dedupe_datasets(B.datasets(spark, sf).drop("description")).select(*_DS_COLS.split(", "))


@query("dataset_scores", with_views(("datasets",), f"SELECT {_DS_COLS}, score FROM scored", extra=_DEDUP), "F4 F3 F2")
def dataset_scores(spark, sf):
    return catalog.score_datasets(catalog.dedupe_datasets(B.datasets(spark, sf))).select(*_DS_COLS.split(", "), "score")


@query(
    "dataset_rank",
    with_views(
        ("datasets",),
        f"""SELECT * FROM (SELECT {_DS_COLS}, score FROM scored
                           ORDER BY score DESC, n_resources DESC, query_pos, item_pos LIMIT 1) WHERE score > 0""",
        extra=_DEDUP,
    ),
    "O3 F4 U5",
)
def dataset_rank(spark, sf):
    scored = catalog.score_datasets(catalog.dedupe_datasets(B.datasets(spark, sf)))
    return catalog.best_dataset(scored).select(*_DS_COLS.split(", "), "score")


@query(
    "resource_filter",
    with_views(
        ("resources",),
        f"""SELECT dataset_id, pos, title, url, format FROM (
              SELECT *, {FOLD(TRUTHY('title', 'format', 'url'))} AS t FROM resources)
            WHERE contains(t, '{RESOURCE_YEAR}') AND contains(t, 'table') AND contains(t, 'refer')""",
    ),
    "P10 O4 F2 F3",
)
def resource_filter(spark, sf):
    return catalog.matching_resources(B.resources(spark, sf), RESOURCE_YEAR).select(
        "dataset_id", "pos", "title", "url", "format"
    )


@query(
    "resource_filter_fields",
    with_views(
        ("described",),
        f"""SELECT pos, title, length(description) AS description_chars, type, mime, latest FROM (
              SELECT *, {FOLD(TRUTHY('title', 'description', 'type', 'format', 'mime', 'url', 'latest'))} AS t FROM described)
            WHERE contains(t, '{RESOURCE_YEAR}') AND contains(t, 'table') AND contains(t, 'refer')""",
    ),
    "P10 F2 F3: all seven fields, whole descriptions",
)
def resource_filter_fields(spark, sf):
    found = catalog.matching_resources(B.described_resources(spark, sf), RESOURCE_YEAR)
    return found.select("pos", "title", F.length("description").cast("long").alias("description_chars"), "type", "mime", "latest")


_TITLE_OR_DEFAULT = "coalesce(nullif(title, ''), 'resource')"
_SLUG = (
    f"regexp_replace(regexp_replace({FOLD(_TITLE_OR_DEFAULT)}, '[^a-z0-9]+', '-', 'g'), "
    "'^-+|-+$', '', 'g')"
)
_SUFFIX = (
    "regexp_extract(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), "
    "'[^/](\\.[^./]+)/*$', 1)"
)


@query(
    "safe_file_name",
    with_views(
        ("resources",),
        f"""SELECT dataset_id, pos,
                   CASE WHEN s = '' THEN 'resource' ELSE s END
                   || CASE WHEN x = '' THEN '.' || lower(coalesce(nullif(format, ''), 'bin')) ELSE x END AS file_name
            FROM (SELECT *, {_SLUG} AS s, {_SUFFIX} AS x FROM resources)""",
    ),
    "F6 F5",
)
def safe_file_name(spark, sf):
    return catalog.with_file_names(B.resources(spark, sf)).select("dataset_id", "pos", "file_name")


@query(
    "reference_tables",
    with_views(
        ("datasets", "resources"),
        f"""SELECT r.dataset_id, r.pos, r.title, r.url, r.format,
                   CASE WHEN s = '' THEN 'resource' ELSE s END
                   || CASE WHEN x = '' THEN '.' || lower(coalesce(nullif(r.format, ''), 'bin')) ELSE x END AS file_name
            FROM (SELECT *, {FOLD(TRUTHY('title', 'format', 'url'))} AS t, {_SLUG} AS s, {_SUFFIX} AS x FROM resources) r
            WHERE r.dataset_id IN (SELECT slug FROM best)
              AND contains(t, '{COMPOSITE_YEAR}') AND contains(t, 'table') AND contains(t, 'refer')""",
        extra=_DEDUP + (("best", """SELECT * FROM (SELECT * FROM scored
                                     ORDER BY score DESC, n_resources DESC, query_pos, item_pos LIMIT 1) WHERE score > 0"""),),
    ),
    "X3 S8-shaped catalog: U5 F4 O3 P10 O4 F6",
)
def reference_tables(spark, sf):
    out = catalog.reference_tables(B.datasets(spark, sf), B.resources(spark, sf), COMPOSITE_YEAR)
    return out.select("dataset_id", "pos", "title", "url", "format", "file_name")


@query(
    "resource_listing",
    with_views(("resources",), "SELECT dataset_id, pos, title, url FROM resources ORDER BY coalesce(title, ''), pos"),
    "O4: all resources, ordered by title, then position",
)
def resource_listing(spark, sf):
    return catalog.ordered_listing(B.resources(spark, sf)).select("dataset_id", "pos", "title", "url")


@query(
    "resource_listing_whole",
    with_views(
        ("resources",),
        "SELECT row_number() OVER (ORDER BY coalesce(title, ''), pos) AS place, pos, title FROM resources",
    ),
    "O4: order by title, then position, of all resources",
)
def resource_listing_whole(spark, sf):
    return catalog.listing_places(B.resources(spark, sf).select("pos", "title")).select("place", "pos", "title")


_GAPPY = """SELECT dataset_id, pos, CASE WHEN pos % 5 <> 0 THEN title END AS title,
                   CASE WHEN pos % 3 = 0 THEN '' WHEN pos % 3 = 2 THEN url END AS url,
                   CASE WHEN pos % 4 = 0 THEN url END AS latest FROM resources"""


@query(
    "resource_urls",
    with_views(
        ("resources",),
        f"""SELECT dataset_id, pos, (nullif(url, '') IS NOT NULL OR latest IS NOT NULL) AS has_url,
                   CASE WHEN nullif(url, '') IS NULL AND latest IS NULL
                        THEN concat('resource ', chr(39), coalesce(nullif(title, ''), '<untitled>'), chr(39), ' has no URL') END AS reason
            FROM ({_GAPPY})""",
    ),
    "F7: resources with a URL, and rejects with a reason",
)
def resource_urls(spark, sf):
    pos = F.col("pos")
    gappy = B.resources(spark, sf).select(
        "dataset_id", "pos", F.when(pos % 5 != 0, F.col("title")).alias("title"),
        F.when(pos % 3 == 0, F.lit("")).when(pos % 3 == 2, F.col("url")).alias("url"),
        F.when(pos % 4 == 0, F.col("url")).alias("latest"),
    )
    ok, rejects = catalog.split_missing_url(gappy)
    return ok.select("dataset_id", "pos", F.lit(True).alias("has_url"), F.lit(None).cast("string").alias("reason")).unionAll(
        rejects.select("dataset_id", "pos", F.lit(False), "reason")
    )


_REJECT_YEAR = 2022


@query(
    "catalog_rejects",
    with_views(
        ("datasets", "resources"),
        f"""SELECT dataset_id, count(*) AS n, 'no reference table of {_REJECT_YEAR}' AS reason
            FROM (SELECT dataset_id, {FOLD(TRUTHY('title', 'format', 'url'))} AS t FROM resources)
            GROUP BY dataset_id
            HAVING NOT bool_or(contains(t, '{_REJECT_YEAR}') AND contains(t, 'table') AND contains(t, 'refer'))
            UNION ALL
            SELECT NULL, count(*), 'no dataset mentions what is looked for'
            FROM scored WHERE title LIKE 'Corpus%' AND score = 0
            HAVING count(*) > 0""",
        extra=_DEDUP,
    ),
    "O3 P10: groups without an accepted record, as rows",
)
def catalog_rejects(spark, sf):
    none = catalog.no_match_rejects(B.resources(spark, sf), _REJECT_YEAR)
    scored = catalog.score_datasets(catalog.dedupe_datasets(B.datasets(spark, sf)))
    empty = catalog.no_dataset_reject(scored.filter(F.col("title").startswith("Corpus") & (F.col("score") == 0)))
    return none.select("dataset_id", F.col("n_resources").alias("n"), "reason").unionAll(
        empty.filter("n_datasets > 0").select(F.lit(None).cast("string"), "n_datasets", "reason")
    )
