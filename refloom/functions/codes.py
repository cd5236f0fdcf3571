"""Column functions for official commune codes (F1, P4, P5 helpers, P8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's rules):
#   a valid code is five ASCII digits, or "2A"/"2B" followed by three ASCII digits;
#   the match covers the whole value.
CODE_PATTERN = r"\A(?:[0-9]{5}|2[AB][0-9]{3})\z"
#   metropolitan departments: the two-character prefix lies between "01" and "95"
#   (string comparison), or is "2A"/"2B".
METRO_LOW, METRO_HIGH, METRO_EXTRA = "01", "95", ("2A", "2B")
#   code types: districts and delegated communes point to their parent.
REMAPPED_TYPES = ("ARM", "COMD")
DISTRICT_TYPE = "ARM"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: Column | str) -> Column:
    """Codes compared as text; numeric inputs are cast (leading zeros must already be there)."""
    return _col(c).cast("string")


def valid_code(c: Column | str) -> Column:
    """Full-match code predicate. NULL is not valid.

    ``\\A…\\z`` rather than ``^…$``: Java's ``$`` also matches before a final newline.
    """
    return F.coalesce(as_text(c).rlike(CODE_PATTERN), F.lit(False))


def in_prefix_range(
    c: Column | str, low: str = METRO_LOW, high: str = METRO_HIGH, extra: tuple[str, ...] = METRO_EXTRA
) -> Column:
    """``substr(code,1,2) BETWEEN low AND high OR substr(code,1,2) IN extra``."""
    prefix = F.substring(_col(c), 1, 2)
    cond = prefix.between(F.lit(low), F.lit(high))
    if extra:
        cond = cond | prefix.isin(*extra)
    return cond


def reference_code(code: Column | str, type_: Column | str, parent: Column | str) -> Column:
    """P5: districts/delegated communes with a non-blank parent map to the parent (untrimmed)."""
    code, type_, parent = _col(code), _col(type_), _col(parent)
    remapped = F.upper(F.coalesce(type_, F.lit(""))).isin(*REMAPPED_TYPES) & (
        F.coalesce(F.trim(parent), F.lit("")) != F.lit("")
    )
    return F.when(remapped, parent).otherwise(code)


def is_type(type_: Column | str, value: str) -> Column:
    return F.upper(F.coalesce(_col(type_), F.lit(""))) == F.lit(value)
