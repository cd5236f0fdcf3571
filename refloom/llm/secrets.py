"""Secret scan with multipart credential linking.

Strong secrets stand for themselves. Weak candidates (an account name, a random-looking
token, a server address) mean nothing alone: they are reported only where complementary
parts stand in one scope. A part's scope is the interval of ``reach`` code points around
it, cut at blank lines. Parts are joined by these intervals: for each part, the sorted
intervals of the other kinds are searched for one that reaches into its scope, so no pairs
are listed. How long a part is does not matter, nor which of two comes first.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame

from refloom.llm.common import add_from_text, fresh
from refloom.llm.spans import blanked

BASE_KINDS = ("assign", "access", "hex")
#: Weak kinds, reported only when linked.
LINKED_KINDS = ("identifier", "weak", "endpoint")
KINDS = BASE_KINDS + LINKED_KINDS

_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_IDENTIFIER_WORDS = ("user", "login", "client", "account", "access")
_IDENTIFIER = re.compile(
    r"""(?ai:\b(user(?:_?name|_?id)?|login|client_?id|account(?:_?id)?|access_?key(?:_?id)?))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]{3,})"""
)
_ENDPOINT = re.compile(
    r"""[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s"'<>]{4,}|(?ai:\b(?:host|hostname|server|endpoint))["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::[0-9]{2,5})?"""
)
_ENDPOINT_WORDS = ("://", "host", "server", "endpoint")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_SHORT = re.compile(r"""(?ai:\b(pass|pwd|passphrase|auth|bearer|credential))["']?\x20*[:=]?\x20*["']?([A-Za-z0-9+/_.=-]{4,})""")
_BLANK = re.compile(r"\n[ \t\r]*\n")

Span = tuple[str, int, int]


def base_spans(text: str, lower: str) -> list[Span]:
    found: list[Span] = []
    if any(w in lower for w in _ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def looks_random(token: str, least_bits: float = 3.0) -> bool:
    """Letters and digits mixed, with at least ``least_bits`` of entropy a character."""
    if not (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)):
        return False
    n = len(token)
    return -sum(k / n * math.log2(k / n) for k in Counter(token).values()) >= least_bits


def by_start(spans: list[Span]) -> tuple[list[int], list[int]]:
    """The sorted starts of ``spans``, and how far each of them and the earlier ones reach."""
    ordered = sorted((a, b) for _, a, b in spans)
    return [a for a, _ in ordered], list(accumulate((b for _, b in ordered), max))


def clear_of(spans: list[Span]) -> Callable[[int, int], bool]:
    """Whether an interval overlaps none of ``spans``; one binary search a question."""
    starts, reached = by_start(spans)

    def free(a: int, b: int) -> bool:
        at = bisect_left(starts, b)
        return not at or reached[at - 1] <= a

    return free


def linked_spans(text: str, lower: str, base: list[Span], reach: int) -> list[Span]:
    """The weak candidates that complementary parts in their scope confirm.

    A weak secret needs an identifier or an endpoint; a weak identifier needs a secret;
    an endpoint needs an identifier and a secret.
    """
    identifiers: list[Span] = []
    endpoints: list[Span] = []
    if any(w in lower for w in _IDENTIFIER_WORDS):
        identifiers = [("identifier", m.start(), m.end()) for m in _IDENTIFIER.finditer(text)]
    if any(w in lower for w in _ENDPOINT_WORDS):
        endpoints = [("endpoint", m.start(), m.end()) for m in _ENDPOINT.finditer(text)]
    access = [s for s in base if s[0] == "access"]
    if not (identifiers or endpoints or access):
        return []  # whatever else there is has no complement
    free = clear_of([*base, *identifiers, *endpoints])
    weak = [("weak", m.start(), m.end()) for m in _SHORT.finditer(text) if free(*m.span())]
    free_too = clear_of(weak)
    weak += [
        ("weak", m.start(), m.end())
        for m in _TOKEN.finditer(text)
        if free(*m.span()) and free_too(*m.span()) and looks_random(m[0])
    ]
    borders = [0, *(m.start() for m in _BLANK.finditer(text)), len(text)]

    def near(part: Span, others: tuple[list[int], list[int]]) -> bool:
        """Whether one of ``others`` overlaps the scope of ``part``, what starts where it starts apart."""
        _, a, b = part
        starts, reached = others
        k = bisect_left(borders, a + 1)
        low, high = max(a - reach, borders[k - 1] if k else 0), min(b + reach, borders[min(k, len(borders) - 1)])
        before, after = bisect_left(starts, a), bisect_right(starts, a)
        return bool(before and reached[before - 1] > low) or (after < len(starts) and starts[after] < high)

    ids, ends = by_start([*identifiers, *access]), by_start(endpoints)
    weak = [s for s in weak if near(s, ids) or near(s, ends)]
    keys = by_start([*(s for s in base if s[0] != "access"), *weak])
    return [
        *(s for s in identifiers if near(s, keys)),
        *weak,
        *(s for s in endpoints if near(s, ids) and near(s, keys)),
    ]


def secret_spans(text: str, reach: int = 300) -> list[Span]:
    lower = text.lower()
    base = base_spans(text, lower)
    return base + linked_spans(text, lower, base, reach)


def scan_secrets(docs: DataFrame, *, text: str = "text", spans: str = "spans", reach: int = 300) -> DataFrame:
    """``docs`` plus ``spans``: array of (kind, start, end), base kinds first.

    Works on whole texts (null: empty, no spans) in one pass without a shuffle: a
    document's parts stand in its own row. Repeated rows are scanned each; an empty table
    gives an empty result. The name ``spans`` is lengthened where it is taken.
    """
    spans = fresh(docs, spans)

    def make():
        return lambda texts: {spans: [[{"kind": k, "start": a, "end": b} for k, a, b in secret_spans(t, reach)] for t in texts]}

    return add_from_text(docs, text, f"`{spans}` array<struct<kind:string,start:int,end:int>>", make)


def redact_secrets(docs: DataFrame, *, text: str = "text", into: str = "redacted", mark: str = "[secret]", reach: int = 300) -> DataFrame:
    """``docs`` plus ``into`` (lengthened where taken): the text with every span (base and linked) replaced by ``mark``.

    Null texts are empty; texts without spans stay as they are. Repeated rows are treated
    alike; an empty table gives an empty result.
    """
    into = fresh(docs, into)

    def make():
        return lambda texts: {into: [blanked(t, [s[1:] for s in found], mark) if (found := secret_spans(t, reach)) else t for t in texts]}

    return add_from_text(docs, text, f"`{into}` string", make)
