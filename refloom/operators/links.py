"""Link operators over many groups at once (X4's pieces).

Rows are ``(group…, pos, link)``; ``pos`` is the input position and breaks every tie.
"Per group" decisions are aggregates (partial aggregation before the shuffle) or a
``row_number`` with a limit (which Spark plans as a partial ``WindowGroupLimit``
before the shuffle), never a driver loop over groups, and never a window over an
unbounded group without such a limit: one group may hold a third of all rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refloom.functions import links as L
from refloom.functions.text import fold, keyword_tokens
from refloom.session import cut_lineage

# The two ranking parameter sets of the reference.
SELECT_FOR_YEAR = {
    "extension_weights": (("csv", 80), ("xlsx", 70), ("xls", 60), ("zip", 50)),
    "target_bonus": 2000,
    "previous_bonus": 1800,
    "older_base": 1200,
    "future_base": 800,
}
PICK_BEST = {
    "extension_weights": (("csv", 60), ("zip", 50), ("xlsx", 40), ("xls", 30)),
    "target_bonus": 1000,
    "previous_bonus": None,
    "older_base": 500,
    "future_base": 500,
}
# Keywords, preferred tokens and accepted extensions per source kind.
KIND_KEYWORDS = {
    "codes": ("cog", "geographique", "commune", "depcom"),
    "units": ("unite", "urbaine", "tuu", "tduu", "uu2020", "base_tu_2020", "base_td_2020"),
    "units_search": ("unite", "urbaine", "tuu", "tduu", "uu2020"),
    "history": ("historique", "communes", "mouvement", "1943", "mvt"),
}
KIND_TOKENS = {
    "codes": ("cog",),
    "units": ("base_tu_2020", "base_td_2020", "tuu", "tduu", "unite", "urbaine"),
}
KIND_EXTENSIONS = {
    "codes": (".xls", ".xlsx", ".csv", ".zip"),
    "units": (".csv", ".xlsx", ".xls", ".zip"),
}
# Known download locations (product ids, then file-name patterns, in order).
KNOWN_CODE_IDS = ("2521852", "2560452", "8377162")
KNOWN_CODE_PATTERNS = (
    "cog{year}.xls", "cog{year}.xlsx", "cog_{year}.xls", "cog_{year}.xlsx",
    "v_commune_{year}.csv", "v_commune_{year}.zip", "cog_complet_{year}.xlsx",
)
KNOWN_HISTORY_IDS = ("8377162", "2521852", "2560452")
KNOWN_HISTORY_PATTERNS = (
    "v_commune_depuis_1943.csv", "v_commune_depuis_1943.dbf", "v_mvt_commune_{year}.csv",
    "v_mouv_commune_{year}.csv", "historique_communes_{year}.csv", "mouvements_communes_depuis_1943.csv",
    "historique_communes_depuis_1943.csv",
)


# ------------------------------------------------------------------ extraction
def explode_positions(df: DataFrame, keep: Sequence[str], array_col: Column, name: str = "link") -> DataFrame:
    """Array column -> rows ``(keep…, pos, name)``; ``pos`` is 0-based."""
    return df.select(*keep, F.posexplode(array_col).alias("pos", name))


def candidate_link_array(
    html: Column | str,
    base: str = L.DEFAULT_BASE,
    host: str = L.DEFAULT_HOST,
    marker: str = L.FILE_MARKER,
    file_path: str = L.FILE_PATH,
    extensions: Sequence[str] = L.FILE_EXTENSIONS,
    strict: bool = True,
) -> Column:
    """F11-F13 + P11/P12 + U7 + U4: the page's candidate file links, first-seen order.

    Strict: filtered hrefs joined to ``base``, then file paths anywhere in the text
    (joined), then absolute file links of ``host``; de-duplicated. Loose: every href
    with the marker, ``base`` prepended when not ``http…``; not de-duplicated.
    """
    text = L.unescape_html(html)
    found = L.hrefs(html)
    if not strict:
        kept = F.filter(found, lambda h: L.loose_link_predicate(h, marker, file_path))
        return F.transform(kept, lambda h: L.join_url_loose(base, h))
    kept = F.filter(found, lambda h: L.strict_link_predicate(h, marker, file_path, extensions))
    joined = F.transform(kept, lambda h: L.join_url(F.lit(base), h))
    blobs = F.transform(L.path_blobs(text, file_path), lambda h: L.join_url(F.lit(base), h))
    absolute = L.absolute_file_links(text, host, file_path)
    return F.array_distinct(F.concat(joined, blobs, absolute))


def file_links_only(links: Column, file_path: str = L.FILE_PATH) -> Column:
    """Keep links containing the file path, de-duplicated."""
    return F.array_distinct(F.filter(links, lambda x: F.lower(x).contains(file_path.lower())))


def result_page_array(html: Column | str, base: str = L.DEFAULT_BASE, page_path: str = L.STAT_PATH,
                      file_path: str = L.FILE_PATH) -> Column:
    """F16 + P14 + U4: result pages of a search page, joined to ``base``, first-seen."""
    kept = F.filter(L.result_page_hrefs(html), lambda h: L.page_link_predicate(h, page_path, file_path))
    return F.array_distinct(F.transform(kept, lambda h: L.join_url(F.lit(base), h)))


def first_seen(df: DataFrame, keys: Sequence[str], item: str, order: str = "pos", limit: int | None = None) -> DataFrame:
    """U4 (+O5 with ``limit``): first occurrence of each item per key, with its first
    position ``order`` (first-seen order = ascending ``order``).

    The per-item minimum is an aggregate (partial before the shuffle). With a
    ``limit``, only the first ``limit`` items per key are kept and numbered
    (``rank``, 1-based) by a ``row_number`` filter that Spark applies partially
    before the shuffle (``WindowGroupLimit``), so a hot key never reaches one task
    whole. Without a limit no window is needed: ``order`` already is the order.
    """
    firsts = df.groupBy(*keys, item).agg(F.min(order).alias(order))
    if limit is None:
        return firsts
    w = Window.partitionBy(*keys).orderBy(F.col(order), F.col(item))
    return firsts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= int(limit))


# ------------------------------------------------------------------ fallbacks
#: Groups whose flags or winners may be broadcast (a key and a number each); more are joined by shuffle.
BROADCAST_GROUPS = 200_000


def with_group_values(df: DataFrame, keys: Sequence[str], *values: Column) -> DataFrame:
    """``df`` plus aggregates of each row's group; null keys are a group like any other.

    The aggregates (one row a group, combined before the shuffle) are written once and counted;
    few are broadcast, so the rows are not moved; many are joined by shuffle, where AQE splits
    groups that hold a large part of the rows.
    """
    groups = cut_lineage(df.groupBy(*keys).agg(*values))
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    g = (F.broadcast(groups) if few else groups).alias("g")
    same = reduce(and_, [F.col(f"r.`{k}`").eqNullSafe(F.col(f"g.`{k}`")) for k in keys])
    added = [F.col(f"g.`{c}`") for c in groups.columns if c not in keys]
    return df.alias("r").join(g, same).select("r.*", *added)


def keep_matching_or_all(df: DataFrame, keys: Sequence[str], hit: Column) -> DataFrame:
    """Keep the rows of a group that hit; a group without any hit keeps all.

    A row whose test is null (a null link) does not hit; rows with null keys are a group.
    """
    flagged = df.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    kept = with_group_values(flagged, keys, F.max("_hit").alias("_any_hit"))
    return kept.filter(F.col("_hit") | ~F.col("_any_hit")).drop("_hit", "_any_hit")


def keyword_filter(df: DataFrame, keys: Sequence[str], link: str, keywords: Column | Sequence[str]) -> DataFrame:
    """Keep links containing any keyword (case-insensitive), else the whole group.

    ``keywords`` is a list, or an array column (e.g. per source kind).
    """
    kw = keywords if isinstance(keywords, Column) else F.array(*[F.lit(k) for k in keywords])
    low = F.lower(F.col(link))
    hit = F.exists(kw, lambda k: low.contains(F.lower(k)))
    return keep_matching_or_all(df, keys, hit)


def query_keywords(spark, query: str) -> list[str]:
    """F10 for a query parameter: the keyword list, computed once by Spark."""
    return list(spark.range(1).select(keyword_tokens(F.lit(query)).alias("k")).first()["k"])


def _contains_any_of(text: Column, words: Sequence[str]) -> Column:
    """Substring test for any of ``words`` with a single reference to ``text`` (one
    regex alternation), so an expensive ``text`` is evaluated once."""
    return text.rlike("|".join(re.escape(w) for w in words))


def _keyword_test(text: Column, keywords, key: Column | None) -> Column:
    """Any keyword contained in ``text``: one regex test; with keywords per key
    value, one CASE branch per key (only the matching branch runs)."""
    if isinstance(keywords, dict):
        out = None
        for k, words in keywords.items():
            test = _contains_any_of(text, list(words)) if words else F.lit(False)
            out = F.when(key == F.lit(k), test) if out is None else out.when(key == F.lit(k), test)
        return F.lit(False) if out is None else out.otherwise(F.lit(False))
    return _contains_any_of(text, list(keywords)) if keywords else F.lit(False)


def page_relevance(pages: DataFrame, keep: Sequence[str], html: str, links: Column, keywords,
                   keyword_key: str | None = None) -> DataFrame:
    """Per page, keep its links where a keyword is in the folded link or in the
    folded page text; when none is kept (or there are no keywords), keep all.

    ``keywords`` is a list, or a dict of lists keyed by the value of column
    ``keyword_key`` (e.g. one list per search query).

    The group is one page, so the decision is made inside the page's row (no
    shuffle). Keywords are space-free tokens and ``fold(a + ' ' + b)`` equals
    ``fold(a) + ' ' + fold(b)``, so "some link of the page hits" is tested on one
    fold of the space-joined links. Page-level values are computed below the
    generator (once per page); ``posexplode_outer`` keeps Spark from inferring and
    pushing a second evaluation of the link array below the scan.
    Rows: ``(keep…, pos, link)`` with ``pos`` the link's position in ``links``.
    """
    key = F.col(keyword_key) if keyword_key else None
    no_words = (not keywords) or (isinstance(keywords, dict) and not any(keywords.values()))
    if no_words:
        return pages.select(*keep, F.posexplode(links).alias("pos", "link"))
    page_hit = _keyword_test(fold(F.col(html)), keywords, key)
    any_link_hit = _keyword_test(fold(F.array_join(links, " ")), keywords, key)
    has_words = F.lit(True) if not isinstance(keywords, dict) else F.coalesce(
        key.isin(*[k for k, w in keywords.items() if w]), F.lit(False)
    )
    extra = [keyword_key] if keyword_key and keyword_key not in keep else []
    decided = pages.select(
        *keep, *extra, links.alias("_links"), (page_hit | ~any_link_hit | ~has_words).alias("_keep_all")
    )
    rows = decided.select(*keep, *extra, "_keep_all", F.posexplode_outer("_links").alias("pos", "link"))
    link_hit = _keyword_test(fold(F.col("link")), keywords, key)
    keep_row = F.col("link").isNotNull() & (F.col("_keep_all") | link_hit)
    return rows.filter(keep_row).select(*keep, "pos", "link")


def first_nonempty_stage(df: DataFrame, keys: Sequence[str], stage: str = "stage") -> DataFrame:
    """Per key (null is one), keep only the rows of the lowest stage that has any row; a null stage comes last."""
    kept = with_group_values(df, keys, F.min(stage).alias("_first_stage"))
    return kept.filter(F.col(stage).eqNullSafe(F.col("_first_stage"))).drop("_first_stage")


def collect_candidates(
    pages: DataFrame,
    keywords_by_query: dict[str, Sequence[str]] | None = None,
    relevance_stage: int = 3,
    self_link_stages: Sequence[int] = (2, 3),
    **candidate_kw,
) -> DataFrame:
    """U6 + U4 (+P16) for search queries: pages ``(query, stage, page_pos, page_url,
    html)`` fetched per stage (0 search page, 1 result pages, 2 web results, 3
    sitemap pages) -> per query, the candidate links of the first stage that yields
    any, first-seen over (page_pos, link_pos). On ``self_link_stages`` a page URL that
    is itself a file link comes first (link_pos 0; the page's links follow from 1); on
    ``relevance_stage`` the page relevance filter (P16) judges the page's links, and
    them alone, by the query's keywords.

    Rows ``(query, stage, link, page_pos, link_pos)``. Pages are read once: everything about
    a page is decided in its row, texts are folded for the judged stage alone, and the links
    that remain, each once a query and stage, are written before the first stage is taken.
    """
    file_path = candidate_kw.get("file_path", L.FILE_PATH)
    words = dict(keywords_by_query or {})
    key = F.col("query")
    judged = (F.col("stage") == relevance_stage) & key.isin(*[q for q, w in words.items() if w])
    judged = F.coalesce(judged, F.lit(False))
    # a page that is itself a file stands before its links, whatever they are judged to be
    is_self = F.col("stage").isin(*[int(x) for x in self_link_stages]) & F.lower("page_url").contains(file_path.lower())
    own = F.when(F.coalesce(is_self, F.lit(False)), F.array("page_url")).otherwise(F.array().cast("array<string>"))
    linked = pages.withColumns({"_links": candidate_link_array("html", **candidate_kw), "_judged": judged, "_own": own})
    page_hit = _keyword_test(fold(F.when(F.col("_judged"), F.col("html"))), words, key)
    link_hit = _keyword_test(fold(F.when(F.col("_judged"), F.array_join("_links", " "))), words, key)
    decided = linked.select(
        "query", "stage", "page_pos", "_own", F.concat("_own", "_links").alias("_all"),
        (~F.col("_judged") | F.coalesce(page_hit, F.lit(False)) | ~F.coalesce(link_hit, F.lit(False))).alias("_keep"),
    )
    rows = decided.select(
        "query", "stage", "page_pos", "_keep", F.size("_own").alias("_n_own"), F.posexplode_outer("_all").alias("_pos", "link")
    ).withColumn("_keep", F.col("_keep") | (F.col("_pos") < F.col("_n_own")))
    hit = F.coalesce(_keyword_test(fold(F.when(~F.col("_keep"), F.col("link"))), words, key), F.lit(False))
    found = rows.filter(F.col("link").isNotNull() & (F.col("_keep") | hit))
    place = F.struct("page_pos", (F.col("_pos") + 1 - F.col("_n_own")).alias("link_pos"))
    firsts = cut_lineage(found.groupBy("query", "stage", "link").agg(F.min(place).alias("_ord")))
    return first_nonempty_stage(firsts, ["query"]).select(
        "query", "stage", "link", F.col("_ord.page_pos").alias("page_pos"), F.col("_ord.link_pos").alias("link_pos")
    )


# ------------------------------------------------------------------ ranking
def score_links(
    df: DataFrame,
    link: str = "link",
    target_year: int | None = None,
    params: dict | None = None,
    preferred_tokens: Sequence[str] = (),
    accepted_extensions: Sequence[str] = (),
) -> DataFrame:
    """P17 + F14 + A8 + F15: accepted links with ``year`` and ``score``."""
    p = dict(PICK_BEST if params is None else params)
    out = df.filter(L.ends_with_any(link, accepted_extensions)) if accepted_extensions else df
    out = out.withColumn("year", L.best_year(link))
    return out.withColumn(
        "score", L.link_score(F.col(link), target_year, preferred_tokens=preferred_tokens, year=F.col("year"), **p)
    )


def best_link(
    df: DataFrame,
    keys: Sequence[str],
    link: str = "link",
    pos: str = "pos",
    target_year: int | None = None,
    params: dict | None = None,
    preferred_tokens: Sequence[str] = (),
    accepted_extensions: Sequence[str] = (),
) -> DataFrame:
    """O1 (``params=SELECT_FOR_YEAR`` + tokens + extensions) / O2 (``PICK_BEST``): per
    group the link with the highest score, then the lowest position. Groups without
    an accepted link produce no row.

    The best place per group is an aggregate on one number (hashed, combined before the
    shuffle); the chosen rows, one a group, are then filtered out in place (``with_group_values``).
    Rows of a group that share both are one link listed twice."""
    scored = score_links(df, link, target_year, params, preferred_tokens, accepted_extensions)
    rows = scored.select(
        *keys, F.col(link).alias("link"), F.col(pos).alias("pos"), "score", "year", best_first(F.col("score"), F.col(pos)).alias("_rank")
    )
    found = with_group_values(rows, keys, F.max("_rank").alias("_top")).filter("_rank = _top").dropDuplicates(list(keys))
    return found.select(*keys, "link", "pos", "score", "year")


def best_first(score: Column, pos: Column) -> Column:
    """Score, then lowest position, as one number whose maximum is the best."""
    return (score.cast("decimal(18,0)") * F.lit(Decimal(10**19)) - pos).cast("decimal(38,0)")


def link_rejects(df: DataFrame, keys: Sequence[str], accepted_extensions: Sequence[str], link: str = "link") -> DataFrame:
    """Quirk 16 as data: groups that have links but none with an accepted extension
    (where the reference raises), one row per group with a reason. An aggregate."""
    acc = L.ends_with_any(link, accepted_extensions).cast("int")
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_links"), F.max(acc).alias("_any"))
    return agg.filter(F.col("_any") == 0).select(
        *keys, "n_links", F.lit("no link with an accepted extension").alias("reason")
    )


# ------------------------------------------------------------------ candidates
def enumerate_urls(
    targets: DataFrame,
    product: str,
    target_year: str,
    patterns: Sequence[str] = KNOWN_CODE_PATTERNS,
    base: str = L.DEFAULT_BASE,
    file_path: str = L.FILE_PATH,
    years_back: int = 1,
) -> DataFrame:
    """Per target row, years ``t, t-1, …`` x patterns, in nested order, as URLs
    ``base + file_path + product + '/' + file``. A fixed fan-out per row (an explode
    of literal arrays), not a join. Rows: ``(targets…, year, ord, url)``."""
    pats = F.array(*[F.lit(p) for p in patterns])
    n = len(patterns)
    yrs = F.sequence(F.col(target_year), F.col(target_year) - F.lit(int(years_back)), F.lit(-1))
    out = targets.select("*", F.posexplode(yrs).alias("_yi", "year")).select(
        "*", F.posexplode(pats).alias("_pi", "_pattern")
    )
    fname = F.replace(F.col("_pattern"), F.lit("{year}"), F.col("year").cast("string"))
    return out.select(
        *targets.columns,
        "year",
        (F.col("_yi") * n + F.col("_pi")).alias("ord"),
        F.concat(F.lit(base + file_path), F.col(product).cast("string"), F.lit("/"), fname).alias("url"),
    )


def known_url_targets(spark, target_year: int, kind: str = "codes") -> DataFrame:
    """J4 input for the fixed download locations: one row per product id, in order,
    with the target year. ``enumerate_urls(known_url_targets(...), "product",
    "target_year", patterns)`` gives the 42 candidates (years x ids x patterns)."""
    ids = KNOWN_CODE_IDS if kind == "codes" else KNOWN_HISTORY_IDS
    rows = [(i, pid, int(target_year)) for i, pid in enumerate(ids)]
    return spark.createDataFrame(rows, "id_pos int, product string, target_year int")


def enumerate_known(spark, target_year: int, kind: str = "codes", base: str = L.DEFAULT_BASE) -> DataFrame:
    """J4 exactly as the reference orders it: year outer, product id, pattern inner."""
    patterns = KNOWN_CODE_PATTERNS if kind == "codes" else KNOWN_HISTORY_PATTERNS
    out = enumerate_urls(known_url_targets(spark, target_year, kind), "product", "target_year", patterns, base=base)
    n_ids, n_pat = len(KNOWN_CODE_IDS), len(patterns)
    order = (F.col("ord") / n_pat).cast("int") * (n_ids * n_pat) + F.col("id_pos") * n_pat + F.col("ord") % n_pat
    return out.select(order.alias("ord"), "year", "product", "url")


def available(candidates: DataFrame, inventory: DataFrame, url: str = "url", inventory_url: str = "link") -> DataFrame:
    """Keep candidates present in an inventory of known URLs (left semi join; the
    candidate order columns are kept for ordering)."""
    inv = inventory.select(F.col(inventory_url).alias(url)).distinct()
    return candidates.join(inv, url, "left_semi")


def available_candidates(
    targets: DataFrame,
    product: str,
    target_year: str,
    inventory: DataFrame,
    patterns: Sequence[str] = KNOWN_CODE_PATTERNS,
    base: str = L.DEFAULT_BASE,
    file_path: str = L.FILE_PATH,
    years_back: int = 1,
    inventory_url: str = "link",
) -> DataFrame:
    """J4 + J5 without the candidates: the rows of ``available(enumerate_urls(...), inventory)``.

    The inventory's URLs are read backwards into (product, pattern, year), where they are of
    that form, and joined to the targets on the product: one row a product, pattern and year
    that exists meets the targets, instead of every candidate of every target.
    """
    prefix = base + file_path
    rest = F.substring(F.col(inventory_url), len(prefix) + 1, 1 << 30)
    parts = inventory.where(F.startswith(F.col(inventory_url), F.lit(prefix))).select(F.split(rest, "/").alias("p")).where(F.size("p") == 2)
    parts = parts.select(F.col("p")[0].alias("_of"), F.col("p")[1].alias("_file"))
    read = []
    for n, pattern in enumerate(patterns):
        head, dated, tail = pattern.partition("{year}")
        if dated:  # every place of the year must say the same one, written as numbers are
            rx = rf"\A{re.escape(head)}(-?[0-9]{{1,9}}){re.escape(tail).replace(re.escape('{year}'), '(-?[0-9]{1,9})')}\z"
            said = [F.regexp_extract("_file", rx, k + 1) for k in range(pattern.count("{year}"))]
            fits = F.col("_file").rlike(rx) & reduce(and_, [s == said[0] for s in said]) & (said[0].try_cast("int").cast("string") == said[0])
            read.append(F.when(fits, F.struct(F.lit(n).alias("n"), said[0].try_cast("int").alias("y"))))
        else:
            read.append(F.when(F.col("_file") == pattern, F.struct(F.lit(n).alias("n"), F.lit(None).cast("int").alias("y"))))
    found = parts.select("_of", "_file", F.explode(F.array_compact(F.array(*read))).alias("r")).distinct()
    t, oldest = F.col(target_year), F.col(target_year) - F.lit(int(years_back))
    years = F.when(F.col("r.y").isNull(), F.sequence(t, oldest, F.lit(-1))).when(F.col("r.y").between(oldest, t), F.array("r.y"))
    out = targets.join(found, F.col(product).cast("string") == F.col("_of")).select("*", F.explode(years).alias("year"))
    return out.select(
        *targets.columns,
        "year",
        ((t - F.col("year")) * len(patterns) + F.col("r.n")).cast("int").alias("ord"),
        F.concat(F.lit(prefix), F.col("_of"), F.lit("/"), F.col("_file")).alias("url"),
    )


# ------------------------------------------------------------------ responses (P18), sitemaps
def response_link_array(
    endpoint_url: Column, final_url: Column, content_type: Column, content_disposition: Column, body: Column,
    file_path: str = L.FILE_PATH, body_kw: dict | None = None,
) -> Column:
    """A redirect into the file path, or a file-like content type / attachment,
    names the final URL; then the candidate links of the body; de-duplicated.
    ``body_kw`` are the ``candidate_link_array`` parameters for the body."""
    redirected = (
        final_url.isNotNull() & (final_url != F.lit("")) & (final_url != endpoint_url)
        & F.lower(final_url).contains(file_path.lower())
    )
    ct, cd = F.lower(F.coalesce(content_type, F.lit(""))), F.lower(F.coalesce(content_disposition, F.lit("")))
    is_file = ct.contains("csv") | ct.contains("excel") | ct.contains("zip") | cd.contains("filename=")
    first = F.array_compact(F.array(F.when(redirected, final_url), F.when(is_file, final_url)))
    body_links = F.when(F.coalesce(body, F.lit("")) != "", candidate_link_array(body, **(body_kw or {})))
    return F.array_distinct(F.concat(first, F.coalesce(body_links, F.array().cast("array<string>"))))


def select_sitemaps(index: DataFrame, url: str = "url", order: str = "pos", first: int = 8, fallback: int = 4) -> DataFrame:
    """F18, first half: sitemap URLs mentioning ``stat``/``information``/``fr`` (first
    ``first``), or when there is none the first ``fallback`` URLs. Two top-k's (per-task
    top-k, then merge), then a choice over at most ``first + fallback`` rows."""
    low = F.lower(F.col(url))
    likely = index.filter(low.contains("stat") | low.contains("information") | low.contains("fr"))
    picked = likely.orderBy(order).limit(first).withColumn("_fallback", F.lit(False))
    backup = index.orderBy(order).limit(fallback).withColumn("_fallback", F.lit(True))
    both = picked.unionByName(backup)
    # Window over the whole (bounded: <= first + fallback rows) union.
    any_likely = F.max((~F.col("_fallback")).cast("int")).over(Window.partitionBy()) == 1
    return both.withColumn("_any", any_likely).filter(F.col("_fallback") != F.col("_any")).drop("_fallback", "_any")


def sitemap_pages(selected: DataFrame, locs: DataFrame, max_pages: int = 12,
                  page_path: str = L.STAT_PATH, info_path: str = L.INFO_PATH,
                  order: str = "pos", loc_pos: str = "loc_pos", loc: str = "loc") -> DataFrame:
    """F18, second half: page URLs (statistics or information pages) of the selected
    sitemaps, in sitemap order then document order, at most ``max_pages``.

    ``selected`` has at most ``first`` rows (a proven bound), so it is broadcast."""
    low = F.lower(F.col(loc))
    pages = locs.filter(low.contains(page_path.lower()) | low.contains(info_path.lower()))
    return pages.join(F.broadcast(selected.select(order)), order).orderBy(order, loc_pos).limit(int(max_pages))


# ------------------------------------------------------------------ X4
# How each source kind and stage is filtered, ranked and dated.
# Stages per kind, in the order they are tried:
#   codes:   0 info page, 1 endpoint probe, 2 known locations, 3 search for t, 4 search for t-1
#   units:   0 info page, 1 endpoint probe, 2..5 the four search queries
#   history: 0 known locations, 1 search
# "target" is the target year's offset (None: no target year); "year" is how the chosen
# link's year is settled: "clamp" (F20), "target" (default to the stage's target, F21) or a
# fixed default year; "keywords" None means the stage is not keyword-filtered.
SOURCE_RULES = (
    {"kind": "codes", "stages": (0, 2), "params": SELECT_FOR_YEAR, "tokens": KIND_TOKENS["codes"],
     "extensions": KIND_EXTENSIONS["codes"], "keywords": KIND_KEYWORDS["codes"], "target": 0, "year": "clamp"},
    {"kind": "codes", "stages": (3, 3), "params": PICK_BEST, "tokens": (), "extensions": (),
     "keywords": KIND_KEYWORDS["codes"], "target": 0, "year": "target"},
    {"kind": "codes", "stages": (4, 4), "params": PICK_BEST, "tokens": (), "extensions": (),
     "keywords": KIND_KEYWORDS["codes"], "target": -1, "year": "target"},
    {"kind": "units", "stages": (0, 1), "params": SELECT_FOR_YEAR, "tokens": KIND_TOKENS["units"],
     "extensions": KIND_EXTENSIONS["units"], "keywords": KIND_KEYWORDS["units"], "target": 0, "year": "target"},
    {"kind": "units", "stages": (2, 5), "params": PICK_BEST, "tokens": (), "extensions": (),
     "keywords": KIND_KEYWORDS["units_search"], "target": 0, "year": "target"},
    {"kind": "history", "stages": (0, 0), "params": PICK_BEST, "tokens": (), "extensions": (),
     "keywords": None, "target": None, "year": 1943},
    {"kind": "history", "stages": (1, 1), "params": PICK_BEST, "tokens": (), "extensions": (),
     "keywords": KIND_KEYWORDS["history"], "target": None, "year": 1943},
)


def _by_rule(rules, value_of, default=None) -> Column:
    out = None
    for r in rules:
        lo, hi = r["stages"]
        cond = (F.col("kind") == r["kind"]) & F.col("stage").between(lo, hi)
        v = value_of(r)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(default) if default is not None else out


def source_rejects(chosen: DataFrame, kinds: Sequence[str] = ("codes", "units", "history")) -> DataFrame:
    """X4's error as data: the kinds for which no source was chosen, with a reason."""
    wanted = chosen.sparkSession.createDataFrame([(k,) for k in kinds], "kind string")
    return wanted.join(chosen.select("kind").distinct(), "kind", "left_anti").select("kind", F.lit("no source found").alias("reason"))


def choose_sources(df: DataFrame, target_year: int, rules=SOURCE_RULES) -> DataFrame:
    """Per source kind, the file to use.

    Rows ``(kind, stage, pos, link)``: U6 takes each kind's first stage that has any
    link; P13 keeps that stage's keyword links (or all of them); each (kind, stage)
    is ranked with its own parameters (O1 for the direct stages, O2 for searches)
    and its year settled (F20 clamp, or F21 default).

    One aggregate per (kind, stage) on numbers alone (combined before the shuffle, so a
    kind that holds most rows costs no more than another) gives the best place among the
    keyword links and among all; the few rows it leaves, at most kinds x stages, decide
    and go back to the links for the chosen one. Rows: ``(kind, stage, link, pos, score,
    year, selected_year)``.
    """
    t = int(target_year)
    empty = F.array().cast("array<string>")
    keywords = _by_rule(
        rules, lambda r: F.array(*[F.lit(w) for w in r["keywords"]]) if r["keywords"] else empty, empty
    )
    low = F.lower("link")
    accepted = _by_rule(rules, lambda r: L.ends_with_any("link", r["extensions"]), F.lit(False))
    # the year is computed once per row; every rule's score reads the column
    dated = df.withColumn("year", L.best_year("link"))
    score = _by_rule(
        rules,
        lambda r: L.link_score(F.col("link"), None if r["target"] is None else t + r["target"],
                               preferred_tokens=r["tokens"], year=F.col("year"), **r["params"]),
    )
    scored = dated.select(
        "kind", "stage", "pos", "link", "year", score.alias("score"),
        F.exists(keywords, lambda k: low.contains(F.lower(k))).alias("_hit"),
        F.when(accepted, best_first(score, F.col("pos"))).alias("_rank"),
    )
    per_stage = scored.groupBy("kind", "stage").agg(
        F.max(F.col("_hit").cast("int")).alias("_any"), F.max(F.when(F.col("_hit"), F.col("_rank"))).alias("_best_hit"),
        F.max("_rank").alias("_best"),
    )
    first = Window.partitionBy("kind").orderBy("stage")
    winners = (
        per_stage.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1")
        .select("kind", "stage", F.when(F.col("_any") == 1, F.col("_best_hit")).otherwise(F.col("_best")).alias("_rank"))
    )
    # one row a kind; equal rows of a kind and place are one link listed twice
    chosen = (
        scored.join(F.broadcast(winners), ["kind", "stage", "_rank"])
        .dropDuplicates(["kind"])
        .select("kind", "stage", "link", "pos", "score", "year")
    )

    def settle(r):
        rule = r["year"]
        if rule == "clamp":
            return L.clamp_year("year", t + (r["target"] or 0))
        if rule == "target":
            return L.default_year("year", t + (r["target"] or 0))
        return L.default_year("year", int(rule))

    return chosen.withColumn("selected_year", _by_rule(rules, settle))
