"""Spans of a text (kind, start, end in code points, end exclusive) as Spark columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def kind_order(kind: Column, kinds: Sequence[str]) -> Column:
    return F.array_position(F.array(*map(F.lit, kinds)), kind)


def joined(spans: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), kind_order(s["kind"], kinds).alias("at"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return F.array_join(
        F.transform(
            F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(spans: Column, kinds: Sequence[str]) -> Column:
    return F.sha2(joined(of_kinds(spans, kinds), kinds).cast("binary"), 256)


def blanked(text: str, spans: Sequence[tuple[int, int]], mark: str) -> str:
    """``text`` with every stretch that spans cover replaced by ``mark`` (overlaps once)."""
    out, at, end = [], 0, -1
    for a, b in sorted(spans):
        if a >= end:  # a new stretch; one that overlaps the last only lengthens it
            out += [text[at:a] if at <= a else "", mark]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]])
