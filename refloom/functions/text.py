"""Text column functions.

All are built-in Spark expressions but for ``fold`` (F2): Spark has no Unicode
decomposition, so it is one vectorised pass of Arrow's kernels over each batch.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Keyword-token rule.
STOPWORDS = ("de", "des", "du", "la", "le", "les", "et", "sur", "pour", "fichier")
MIN_TOKEN_LEN = 3
# Dataset keyword weights (F4), in order.
DATASET_TERMS = (("installation", 3), ("radioelectrique", 4), ("5w", 5), ("plus de 5w", 6), ("refer", 1))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python's ASCII white space.
_SPACES = r"[\t-\r\x1C-\x1F ]+"


@F.arrow_udf(StringType())
def _folded(v: pa.Array) -> pa.Array:
    plain = pc.replace_substring_regex(pc.utf8_normalize(v, form="NFKD"), r"[^\x00-\x7F]+", "")
    return pc.ascii_lower(pc.ascii_trim(pc.replace_substring_regex(plain, _SPACES, " "), " "))


def fold(c: Column | str) -> Column:
    """NFKD, drop non-ASCII, collapse whitespace runs to one space, strip, lowercase.

    Whole Arrow batches at a time, so a value is decomposed once; several tests on the same
    folded column share one evaluation.
    """
    return _folded(_col(c))


def concat_truthy(*cols: Column | str) -> Column:
    """join the non-empty values with one space (NULL and '' are skipped)."""
    return F.concat_ws(" ", *[F.nullif(_col(c), F.lit("")) for c in cols])


def first_truthy(*cols: Column | str, default: str | None = None) -> Column:
    """first non-NULL, non-empty value, else ``default``."""
    parts = [F.nullif(_col(c), F.lit("")) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def keyword_tokens(
    c: Column | str, stopwords: Sequence[str] = STOPWORDS, min_len: int = MIN_TOKEN_LEN, folded: bool = False
) -> Column:
    """``[a-zA-Z0-9]+`` tokens of the folded text, length >= min_len, minus
    stopwords; duplicates and order kept.

    ``[a-zA-Z0-9]{min_len,}`` matched left to right yields exactly the maximal runs
    of at least ``min_len`` characters (a greedy match at a run's start takes the
    whole run; a shorter run cannot match anywhere inside it). Stopwords are then
    removed with ``array_remove`` (every occurrence, other duplicates kept).
    """
    text = _col(c) if folded else fold(c)
    toks = F.regexp_extract_all(text, F.lit(f"([a-zA-Z0-9]{{{int(min_len)},}})"), 1)
    for w in sorted({w for w in stopwords if len(w) >= min_len}):
        toks = F.array_remove(toks, w)
    return toks


def keyword_score(folded: Column | str, weights: Sequence[tuple[str, int]] = DATASET_TERMS) -> Column:
    """sum of the weights of the terms contained (substring) in the folded text."""
    t = _col(folded)
    total = F.lit(0)
    for term, w in weights:
        total = total + F.when(t.contains(term), F.lit(int(w))).otherwise(F.lit(0))
    return total


def identifier(c: Column | str) -> Column:
    """F8: non-alphanumerics to ``_`` and lowercase (accents kept), collapse and strip
    ``_``, empty -> ``table_data``, leading digit -> ``t_`` prefix.

    Replace before lowercasing: lowercasing some letters adds a combining mark that
    must not be replaced.
    """
    x = F.lower(F.regexp_replace(_col(c), r"[^\p{L}\p{N}]", "_"))
    x = F.regexp_replace(F.regexp_replace(x, "_+", "_"), "^_|_$", "")
    return F.when(x == "", F.lit("table_data")).when(x.rlike(r"^\p{Nd}"), F.concat(F.lit("t_"), x)).otherwise(x)


def slug(c: Column | str, default: str = "resource") -> Column:
    """Folded text with runs of non-``[a-z0-9]`` as ``-``, stripped of ``-``; empty -> default."""
    s = F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", F.lit(default)).otherwise(s)


def url_path(url: Column | str) -> Column:
    """Path part of a URL, as ``urlparse`` splits it (scheme, ``//netloc``, then up to
    ``?``/``#``), without ``;params`` of the last segment."""
    p = F.regexp_extract(_col(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(p, ";[^/]*$", "")


def path_suffix(path: Column | str) -> Column:
    """Suffix of the last path component (``.gz`` for ``a.tar.gz``; none for dot files)."""
    return F.regexp_extract(_col(path), r"[^/](\.[^./]+)/*$", 1)


def safe_file_name(
    title: Column | str, id_: Column | str | None, url: Column | str, latest: Column | str | None,
    format_: Column | str | None, type_: Column | str | None,
) -> Column:
    """slug of title/id/``resource`` + URL path suffix (case kept), else
    ``.`` + lower(format or type or ``bin``)."""
    def opt(c):
        return F.lit(None).cast("string") if c is None else _col(c)

    name = first_truthy(opt(title), opt(id_), default="resource")
    u = first_truthy(opt(url), opt(latest), default="")
    suffix = path_suffix(url_path(u))
    fallback = F.concat(F.lit("."), F.lower(first_truthy(opt(format_), opt(type_), default="bin")))
    return F.concat(slug(name), F.when(suffix == "", fallback).otherwise(suffix))
