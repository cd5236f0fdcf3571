"""Link column functions (F11-F22, P11, P12, P14, P15, P17), built-in expressions only."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``\s`` for str patterns, as an explicit class (Java's ``\s``
# is ASCII-only and misses \x1c-\x1f).
PY_SPACE = (
    r"\t\n\x0B\f\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# The site layout the reference looks for.
DEFAULT_BASE = "https://www.insee.fr"
DEFAULT_HOST = "www.insee.fr"
FILE_PATH = "/fr/statistiques/fichier/"
FILE_MARKER = "fichier"
STAT_PATH = "/fr/statistiques/"
INFO_PATH = "/fr/information/"
FILE_EXTENSIONS = (".csv", ".zip", ".xls", ".xlsx")
YEAR_PATTERN = "(19[0-9]{2}|20[0-9]{2})"
DEFAULT_FILE_NAME = "insee_file"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def unescape_html(html: Column | str) -> Column:
    """``\\/`` -> ``/``, then ``&amp;`` -> ``&`` (in that order)."""
    return F.replace(F.replace(_col(html), F.lit("\\/"), F.lit("/")), F.lit("&amp;"), F.lit("&"))


def hrefs(html: Column | str) -> Column:
    """every ``href = '…'`` / ``"…"`` value, any case, after unescaping."""
    pattern = rf"(?i)href[{PY_SPACE}]*=[{PY_SPACE}]*['\"]([^'\"]+)['\"]"
    return F.regexp_extract_all(unescape_html(html), F.lit(pattern), 1)


def result_page_hrefs(html: Column | str) -> Column:
    """F16: ``href="…"`` only (double quotes, case-sensitive), no unescaping."""
    return F.regexp_extract_all(_col(html), F.lit(r'href="([^"]+)"'), 1)


def sitemap_locs(xml: Column | str) -> Column:
    """``<loc>…</loc>`` values, any case."""
    return F.regexp_extract_all(_col(xml), F.lit(r"(?i)<loc>([^<]+)</loc>"), 1)


def path_blobs(text: Column | str, file_path: str = FILE_PATH) -> Column:
    """file paths anywhere in the text (up to a quote, whitespace or ``<``)."""
    pattern = f"(?i)({re.escape(file_path)}[^\"'{PY_SPACE}<]+)"
    return F.regexp_extract_all(_col(text), F.lit(pattern), 1)


def absolute_file_links(text: Column | str, host: str = DEFAULT_HOST, file_path: str = FILE_PATH) -> Column:
    """absolute ``http(s)://host/<file path>…`` links anywhere in the text."""
    pattern = f"(?i)(https?://{re.escape(host)}{re.escape(file_path)}[^\"'{PY_SPACE}<]+)"
    return F.regexp_extract_all(_col(text), F.lit(pattern), 1)


# ------------------------------------------------------------------ F13
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def _remove_dot_segments(path: Column, relative: bool) -> Column:
    """Dot-segment removal at any depth: one fold of the segments that pushes a name and
    pops on ``..`` (above the root there is nothing to pop). Inner empty segments go where
    a relative path was joined to a directory."""
    ends = parts = F.split(path, "/", -1)
    if relative:
        n = F.size(parts)
        inner = F.filter(F.slice(parts, 2, F.greatest(n - 2, F.lit(0))), lambda s: s != "")
        ends = F.when(n > 1, F.concat(F.slice(parts, 1, 1), inner, F.slice(parts, -1, 1))).otherwise(parts)

    def step(done: Column, s: Column) -> Column:
        popped = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(s == "..", popped).when(s == ".", done).otherwise(F.concat(done, F.array(s)))

    kept = F.aggregate(ends, F.array().cast("array<string>"), step)
    at_dot = F.element_at(parts, -1).isin(".", "..")
    joined = F.array_join(F.when(at_dot, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def _dots(path: Column, relative: bool = False) -> Column:
    """Segment removal only where there can be something to remove."""
    needed = path.contains("/.")
    if relative:
        needed = needed | path.contains("//")
    return F.when(needed, _remove_dot_segments(path, relative)).otherwise(path)


def join_url(base: Column | str, link: Column | str) -> Column:
    """resolve ``link`` against ``base`` like ``urllib.parse.urljoin`` for
    hierarchical http(s) URLs: scheme -> as is; ``//`` -> base scheme; ``/`` -> base
    authority; ``?``/``#`` -> base path; else relative to the base directory."""
    b, u = _lit(base), _col(link)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    authority = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    bpath = F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    bquery = F.regexp_extract(b, r"^[^?#]*(\?[^#]*)?", 1)
    bdir = F.regexp_extract(bpath, r"^(.*/)", 1)
    lpath = F.regexp_extract(u, r"^([^?#]*)", 1)
    lrest = F.regexp_extract(u, r"^[^?#]*(.*)$", 1)
    rel_path = F.when(bpath == "", F.concat(F.lit("/"), lpath)).otherwise(F.concat(bdir, lpath))
    return (
        F.when(u == "", b)
        .when(u.rlike(_SCHEME), u)
        .when(u.startswith("//"), F.concat(scheme, F.lit(":"), u))
        .when(u.startswith("/"), F.concat(authority, _dots(lpath), lrest))
        .when(u.startswith("?"), F.concat(authority, bpath, u))
        .when(u.startswith("#"), F.concat(authority, bpath, bquery, u))
        .otherwise(F.concat(authority, _dots(rel_path, relative=True), lrest))
    )


def join_url_loose(base: str, link: Column | str) -> Column:
    """P12's join: anything not starting with ``http`` gets the base prepended."""
    u = _col(link)
    return F.when(u.startswith("http"), u).otherwise(F.concat(F.lit(base), u))


# ------------------------------------------------------------------ predicates
def contains_any(c: Column | str, needles: Sequence[str]) -> Column:
    low = F.lower(_col(c))
    cond = F.lit(False)
    for n in needles:
        cond = cond | low.contains(n.lower())
    return cond


def strict_link_predicate(
    link: Column | str, marker: str = FILE_MARKER, file_path: str = FILE_PATH, extensions: Sequence[str] = FILE_EXTENSIONS
) -> Column:
    """Contains the marker, and (the file path, or an extension anywhere)."""
    low = F.lower(_col(link))
    in_path = low.contains(file_path.lower())
    return (in_path | low.contains(marker.lower())) & (in_path | contains_any(low, extensions))


def loose_link_predicate(link: Column | str, marker: str = FILE_MARKER, file_path: str = FILE_PATH) -> Column:
    """Contains the marker (or the file path)."""
    low = F.lower(_col(link))
    return low.contains(file_path.lower()) | low.contains(marker.lower())


def page_link_predicate(link: Column | str, page_path: str = STAT_PATH, file_path: str = FILE_PATH) -> Column:
    """A statistics page, not a file."""
    low = F.lower(_col(link))
    return low.contains(page_path.lower()) & ~low.contains(file_path.lower())


def ends_with_any(link: Column | str, extensions: Sequence[str]) -> Column:
    """Lowercase link ends with one of the extensions; none given accepts all."""
    if not extensions:
        return F.lit(True)
    low = F.lower(_col(link))
    cond = F.lit(False)
    for e in extensions:
        cond = cond | low.endswith(e.lower())
    return cond


# ------------------------------------------------------------------ F14, A8, F15
def years(link: Column | str) -> Column:
    """distinct 19xx/20xx years anywhere in the lowercase link, first-seen order
    (non-overlapping; no word boundary)."""
    found = F.regexp_extract_all(F.lower(_col(link)), F.lit(YEAR_PATTERN), 1)
    return F.array_distinct(F.transform(found, lambda y: y.cast("int")))


def best_year(link: Column | str) -> Column:
    """The largest year, NULL when there is none."""
    return F.array_max(years(link))


def link_score(
    link: Column | str,
    target_year: int | None,
    extension_weights: Sequence[tuple[str, int]],
    preferred_tokens: Sequence[str] = (),
    target_bonus: int = 1000,
    previous_bonus: int | None = None,
    older_base: int = 500,
    future_base: int = 500,
    year: Column | None = None,
) -> Column:
    """year points + the first matching extension's weight + 120 per preferred token."""
    low = F.lower(_col(link))
    y = best_year(link) if year is None else year
    if target_year is None:
        pts = F.lit(0)
    else:
        t = int(target_year)
        pts = F.when(y.isNull(), F.lit(0)).when(y == t, F.lit(target_bonus))
        if previous_bonus is not None:
            pts = pts.when(y == t - 1, F.lit(previous_bonus))
        pts = pts.when(y <= t, F.lit(older_base) - F.abs(F.lit(t) - y)).otherwise(F.lit(future_base) - F.abs(F.lit(t) - y))
    ext = None
    for e, w in extension_weights:
        cond = low.endswith(f".{e}")
        ext = F.when(cond, F.lit(int(w))) if ext is None else ext.when(cond, F.lit(int(w)))
    ext_pts = F.lit(0) if ext is None else ext.otherwise(F.lit(0))
    tok = F.lit(0)
    for token in preferred_tokens:
        tok = tok + F.when(low.contains(token), F.lit(120)).otherwise(F.lit(0))
    return pts + ext_pts + tok


def clamp_year(year: Column | str, target_year: int) -> Column:
    """none -> target; above target -> target; below target-1 -> target-1."""
    t = int(target_year)
    return F.greatest(F.least(F.coalesce(_col(year), F.lit(t)), F.lit(t)), F.lit(t - 1))


def default_year(year: Column | str, default: int) -> Column:
    """F21."""
    return F.coalesce(_col(year), F.lit(int(default)))


def file_name_from_url(url: Column | str, default: str = DEFAULT_FILE_NAME) -> Column:
    """drop the query string, take the last non-empty path part, else the default."""
    head = F.regexp_extract(_col(url), r"^([^?]*)", 1)
    name = F.regexp_extract(head, r"([^/]+)/*$", 1)
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(default))


def redirect_targets(html: Column | str, param: str = "uddg") -> Column:
    """values of ``param=`` up to ``&``/quote, percent-decoded (``+`` kept)."""
    raw = F.regexp_extract_all(_col(html), F.lit(f"{re.escape(param)}=([^&\"']+)"), 1)
    return F.transform(raw, lambda x: F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x))
