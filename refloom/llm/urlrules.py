"""URL filters: pattern rules indexed by their rarest literal token.

A rule's pattern is a host and a path (``example.net/en/``: that host, its subdomains,
and paths that start so; ``*`` stands for any characters). Every literal token (run of
ASCII letters and digits with an end on both sides) of the pattern must stand in a URL
that the rule fits, so each rule is filed under the one that the fewest URLs hold. A
URL's tokens fetch the rules filed under them, and only those run their regular
expression. Rules with no such token are filed under a token that every URL has.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import fresh

_TOKEN = "[A-Za-z0-9]+"
#: Filed here: rules whose pattern has no literal token. Not a token itself.
_EVERY = "*"

#: Up to this many rules (some MB) the index is sent to every executor; above, it is joined by shuffle.
BROADCAST_RULES = 50_000


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    pattern: str  # host and path; "*/..." fits every host

    def regex(self) -> str:
        host, slash, path = self.pattern.partition("/")
        any_of = lambda s, one: one.join(re.escape(x) for x in s.split("*"))
        start = "[^/]*" if host == "*" else r"(?:[^/]*\.)?" + any_of(host, "[^/]*")
        return "(?s)^" + start + re.escape(slash) + any_of(path, ".*")

    def tokens(self) -> list[str]:
        """Literal tokens that any URL must have that the rule fits, as whole tokens."""
        found = []
        for m in re.finditer(_TOKEN, self.pattern):
            left, right = self.pattern[: m.start()][-1:], self.pattern[m.end() :][:1]
            if left != "*" and right not in ("", "*"):  # "" : a longer word may start so
                found.append(m[0])
        return found or [_EVERY]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for a null url."""
    url = F.coalesce(url, F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, parts, 2)


def _places(hosts_paths: DataFrame) -> DataFrame:
    """Distinct ``place`` (host and path) with its distinct tokens."""
    tokens = F.array_distinct(F.regexp_extract_all("place", F.lit(_TOKEN), F.lit(0)))
    return hosts_paths.select(F.explode(F.concat(tokens, F.array(F.lit(_EVERY)))).alias("token"), "place")


def rule_index(places: DataFrame, rules: Sequence[Rule], patterns: Sequence[Rule]) -> DataFrame:
    """``token, pattern, rule_verdict, named, regex``: each rule under its rarest token.

    ``named`` tells rules from patterns. Frequencies are counted over all places, for the
    rules' own tokens only.
    """
    every = [(r, True) for r in dict.fromkeys(rules)] + [(r, False) for r in dict.fromkeys(patterns)]
    given = places.sparkSession.createDataFrame(
        [(r.pattern, r.verdict, named, r.regex(), t) for r, named in every for t in dict.fromkeys(r.tokens())],
        "pattern string, rule_verdict string, named boolean, regex string, token string",
    )
    wanted = given.select("token").distinct()
    if len(every) <= BROADCAST_RULES:
        wanted = F.broadcast(wanted)
    counts = _places(places).join(wanted, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token"))).alias("rarest")
    index = (
        given.join(counts, "token", "left")
        .groupBy("pattern", "rule_verdict", "named", "regex")
        .agg(rarest)
        .select("rarest.token", "pattern", "rule_verdict", "named", "regex")
    )
    return F.broadcast(index) if len(every) <= BROADCAST_RULES else index


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], patterns: Sequence[Rule] = (), default: str = "allow", url: str = "url"
) -> DataFrame:
    """``pages`` plus ``host, path, rule, verdict`` (lengthened where a name is taken).

    The longest rule that fits gives ``rule`` and the verdict (ties: block, then the
    smaller pattern). Else, of the ``patterns`` that fit, the longest gives the verdict
    and ``rule`` stays null; else ``default``. Null urls and urls without ``://`` have an
    empty host and path, which no rule with a host fits. Rows with equal places are
    judged once; repeated rows stay. Empty tables give empty results.
    """
    host_col, path_col, rule_col, verdict_col, place_col = (fresh(pages, n) for n in ("host", "path", "rule", "verdict", "place"))
    host, path = host_and_path(F.col(url))
    rows = pages.withColumns({host_col: host, path_col: path, place_col: F.concat(host, path)})
    places = rows.select(F.col(place_col).alias("place")).distinct()
    order = F.struct((-F.length("pattern")).alias("long"), (F.col("rule_verdict") != "block").alias("allow"), "pattern", "rule_verdict")
    fits = (
        _places(places)
        .join(rule_index(places, rules, patterns), "token")
        .filter(F.expr("place rlike regex"))
        .groupBy("place")
        .agg(F.min(F.when(F.col("named"), order)).alias("by_rule"), F.min(F.when(~F.col("named"), order)).alias("by_pattern"))
    )
    return rows.alias("r").join(fits.alias("f"), F.col(f"r.`{place_col}`") == F.col("f.place"), "left").select(
        *[F.col(f"r.`{c}`") for c in rows.columns if c != place_col],
        F.col("f.by_rule.pattern").alias(rule_col),
        F.coalesce("f.by_rule.rule_verdict", "f.by_pattern.rule_verdict", F.lit(default)).alias(verdict_col),
    )
