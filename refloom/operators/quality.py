"""Quality gates: row-count control (K4, A1) and the HTML-instead-of-data gate (K5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How many leading bytes are sniffed, and the markers of an HTML page.
SNIFF_BYTES = 4096
HTML_MARKERS = ("<html", "<!doctype html")


class RowCountError(RuntimeError):
    pass


def row_count_report(df: DataFrame, expected: int | None, tolerance: int = 0) -> DataFrame:
    """K4 + A1 as a one-row report ``(n_rows, expected_rows, tolerance, passed)``.

    ``passed`` is NULL when no expectation is given (the check is skipped).
    """
    n = F.count(F.lit(1))
    exp = F.lit(expected).cast("long")
    passed = F.lit(None).cast("boolean") if expected is None else (F.abs(n - exp) <= F.lit(int(tolerance)))
    return df.agg(
        n.alias("n_rows"),
        exp.alias("expected_rows"),
        F.lit(int(tolerance)).cast("long").alias("tolerance"),
        passed.alias("passed"),
    )


def row_count_control(df: DataFrame, expected: int | None, tolerance: int = 0) -> int:
    """K4: count once and fail when ``abs(n - expected) > tolerance``; call it *before*
    writing the table so a failed check leaves nothing behind. Returns the count."""
    row = row_count_report(df, expected, tolerance).first()
    n = int(row["n_rows"])
    if expected is not None and not row["passed"]:
        raise RowCountError(f"row-count control failed: expected {expected} +/- {tolerance}, got {n}")
    return n


def looks_like_html(content: Column, sniff_bytes: int = SNIFF_BYTES) -> Column:
    """K5 on binary content (``binaryFile``) or text: the first ``sniff_bytes`` bytes,
    read leniently as text, lowercased, contain an HTML marker.

    ``cast(binary as string)`` never fails on bad bytes (``decode`` can), and a cut
    multi-byte character at the end cannot create or hide an ASCII marker.
    """
    head = F.substring(content, 1, sniff_bytes).cast("string")
    low = F.lower(head)
    cond = F.lit(False)
    for m in HTML_MARKERS:
        cond = cond | low.contains(m)
    return cond


def html_gate_text(text: Column, sniff_bytes: int = SNIFF_BYTES) -> Column:
    """K5 for text columns: the window is in UTF-8 bytes, so no more than that many characters
    are encoded."""
    return looks_like_html(F.encode(F.substring(text, 1, sniff_bytes), "UTF-8"), sniff_bytes)
