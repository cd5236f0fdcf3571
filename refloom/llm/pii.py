"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Strict patterns (the base kinds) always count. Beside them loose candidates are taken
from each text. Five labelers (strict pattern, known format, gazetteer, context, shape)
vote yes, no or nothing on every candidate. How often each pattern of votes occurs is
counted over the whole corpus; expectation-maximisation on these counts (at most 3^5
rows) estimates each labeler's reliability. The posteriors then train a logistic span
classifier on all candidates, counted by feature vector, and it decides on the loose ones.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import add_from_text
from refloom.llm.secrets import clear_of
from refloom.llm.spans import blanked
from refloom.session import cut_lineage

BASE_KINDS = ("email", "ip", "card", "phone")
LOOSE_KINDS = ("masked_email", "iban", "number", "name")
KINDS = BASE_KINDS + LOOSE_KINDS
LABELERS = ("strict", "format", "gazetteer", "context", "shape")

Span = tuple[str, int, int]

# --- base spans -------------------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_AT = re.compile("@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A match never starts inside a run of digits: where it fails at the run's start, it fails there too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGITS = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _is_card(s: str) -> bool:
    digits = _NOT_DIGITS.sub("", s)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _addresses(text: str, mark: re.Pattern, host: re.Pattern, kind: str, gap: bool = False) -> list[Span]:
    """Leftmost non-overlapping ``local mark host``: from each mark once to the left over the local part's
    characters (with ``gap``, one space may stand before the mark) and once to the right. No local part
    holds a mark, so this takes time linear in the text, however long its runs are."""
    found: list[Span] = []
    low = 0
    for m in mark.finditer(text):
        at = m.start()
        if at < low:
            continue
        tail = host.match(text, m.end())
        end = at - (gap and text[at - 1 : at] == " ")
        start = low + len(text[low:end].rstrip(_LOCAL))
        low = m.end()
        if tail and start < end:
            found.append((kind, start, tail.end()))
            low = tail.end()
    return found


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check."""
    found: list[Span] = []
    found += _addresses(text, _AT, _DOMAIN, "email")
    if _DIGIT.search(text):
        found += [
            ("ip", m.start(), m.end())
            for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
        ]
        found += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if _is_card(m[0])]
        if "+" in text:
            found += [
                ("phone", m.start(), m.end())
                for m in _PHONE.finditer(text)
                if 10 <= len(_NOT_DIGITS.sub("", m[0])) <= 15
            ]
    return found


# --- loose candidates -------------------------------------------------------------------------

_MASKED_AT = re.compile(r"\(at\)|\[at\]|\{at\}")
_MASKED_DOMAIN = re.compile(r" ?+[A-Za-z0-9-]++(?: ?+(?:\.|\(dot\)|\[dot\]|\{dot\}) ?+[A-Za-z0-9-]++)++")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_NUMBER = re.compile(r"(?<![\w.,+-])\(?[0-9](?:[\x20()./-]?[0-9]){5,18}(?![\w])")
_TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Señora", "Sr", "Sra")
_NAME = re.compile(rf"\b(?:{'|'.join(_TITLES)})\.? (?:[A-ZÀ-ÖØ-Þ][\w'’-]+)(?: [A-ZÀ-ÖØ-Þ][\w'’-]+){{0,2}}")
_TITLE_MARKS = tuple(f"{t}{end}" for t in _TITLES for end in (". ", " "))

#: Words beside personal data, in four languages.
_FOR = re.compile(
    r"(?i)\b(?:phone|tel|telephone|mobile|fax|call|contact|e-?mail|mail|ssn|social security|account|iban|card|passport|born|name|address"
    r"|telefon|handy|konto|ausweis|geboren|anschrift|téléphone|portable|compte|carte|né|née|adresse"
    r"|teléfono|móvil|cuenta|tarjeta|pasaporte|nacido|dirección|correo)\b"
)
#: Words beside numbers that are not personal.
_AGAINST = re.compile(
    r"(?i)\b(?:page|pages|chapter|figure|table|version|isbn|issn|doi|order|invoice|article|year|total|price|km|kg|seite|kapitel|band"
    r"|chapitre|prix|página|capítulo|precio)\b|[%€$£]"
)
#: First names and country codes that speak for a person or a bank account.
_FIRST_NAMES = frozenset(
    "james mary john anna maria peter michael thomas laura julia paul sarah david emma lukas sophie marie pierre jean claire luc "
    "hans karl ute petra josé juan carmen luis ana carlos lucía pablo elena marta".split()
)
_BANK_COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
_KNOWN_FORMATS = (
    re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),  # social security
    re.compile(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"),  # phone without a country
    re.compile(r"0[0-9](?:[ .][0-9]{2}){4}"),
    re.compile(r"0[0-9]{2,4}[ /-][0-9]{5,8}"),
)
_OTHER_FORMATS = (
    re.compile(r"(?:1[5-9]|20)[0-9]{2}([-/.])[0-9]{1,2}\1[0-9]{1,2}"),  # dates
    re.compile(r"[0-9]{1,2}([-/.])[0-9]{1,2}\1(?:1[5-9]|20)?[0-9]{2}"),
    re.compile(r"(?:1[5-9]|20)[0-9]{2} ?- ?(?:1[5-9]|20)[0-9]{2}"),  # years
    re.compile(r"[0-9]{1,3}(?:\.[0-9]{3})+"),  # grouped thousands
)
#: Code points on either side that the context labeler sees.
CONTEXT = 40


def iban_valid(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and s.isascii() and s.isalnum() and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def loose_spans(text: str, base: list[Span]) -> list[Span]:
    found: list[Span] = []
    found += _addresses(text, _MASKED_AT, _MASKED_DOMAIN, "masked_email", gap=True)
    if _DIGIT.search(text):
        found += [("iban", m.start(), m.end()) for m in _IBAN.finditer(text)]
        free = clear_of([*base, *found])
        found += [("number", m.start(), m.end()) for m in _NUMBER.finditer(text) if free(*m.span())]
    if any(t in text for t in _TITLE_MARKS):
        found += [("name", m.start(), m.end()) for m in _NAME.finditer(text)]
    free = clear_of(base)
    return [s for s in found if free(*s[1:])]


# --- labelers and features --------------------------------------------------------------------


def votes(text: str, span: Span) -> list[int]:
    """What each labeler says: 1 yes, -1 no, 0 nothing."""
    kind, a, b = span
    s = text[a:b]
    digits = _NOT_DIGITS.sub("", s)
    around = text[max(0, a - CONTEXT) : a] + " \n " + text[b : b + CONTEXT // 2]
    # digits that fit no strict pattern speak against; for the other kinds it has no pattern
    strict = 1 if kind in BASE_KINDS else -1 if kind == "number" or (kind == "iban" and not iban_valid(s)) else 0
    known = 0
    if kind in ("iban", "masked_email") or (kind == "phone" and "(" in s):
        known = 1 if kind != "iban" or iban_valid(s) else -1
    elif kind == "number":
        known = 1 if any(r.fullmatch(s) for r in _KNOWN_FORMATS) else -1 if any(r.fullmatch(s) for r in _OTHER_FORMATS) else 0
    listed = 0
    if kind == "name":
        listed = 1 if any(w.lower() in _FIRST_NAMES for w in s.split()[1:]) else 0
    elif kind == "iban":
        listed = 1 if s[:2] in _BANK_COUNTRIES else -1
    context = bool(_FOR.search(around)) - bool(_AGAINST.search(around))
    if kind in ("email", "masked_email"):
        shape = 1
    elif kind == "name":
        shape = 1 if len(s.split()) >= 3 else 0
    elif kind in ("ip", "card", "iban"):
        shape = 0  # their strict checks say all that their shape can
    else:
        shape = 1 if 9 <= len(digits) <= 19 and len(s) > len(digits) else -1 if len(digits) < 8 or len(s) == len(digits) else 0
    return [strict, known, listed, int(context), shape]


def features(text: str, span: Span) -> list[int]:
    """What the span classifier sees, 0 or 1 each: the kind, lengths, separators, surroundings."""
    kind, a, b = span
    s = text[a:b]
    digits = sum(c in "0123456789" for c in s)
    before, after = text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT // 2]
    return [
        1,
        *(int(kind == k) for k in KINDS),
        int(digits >= 9),
        int(digits >= 14),
        int(len(s) - digits >= 2),
        int(" " in s),
        int("-" in s),
        int("." in s),
        int("(" in s or "+" in s),
        int(bool(_FOR.search(before) or _FOR.search(after))),
        int(bool(_AGAINST.search(before) or _AGAINST.search(after))),
        int(any(r.fullmatch(s) for r in _KNOWN_FORMATS)),
        int(any(r.fullmatch(s) for r in _OTHER_FORMATS)),
        int(iban_valid(s) if kind == "iban" else 0),
    ]


# --- estimation -------------------------------------------------------------------------------


def fit_reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, prior: float = 0.5) -> tuple[np.ndarray, dict]:
    """Posterior of each vote pattern, and the estimates, by expectation-maximisation.

    ``patterns`` (n, labelers) holds -1, 0, 1; labelers are independent given the truth.
    Each labeler has a distribution over its three answers for real and for false spans,
    with a pseudo-count of one on each answer and three on "yes" for real and "no" for
    false ones, so a labeler that never speaks stays neutral. Starts from the majority. Two
    bounds keep the classes what they are called: no labeler counts against its own word,
    and a span that nobody votes for is not personal.
    """
    if not len(patterns):
        return np.zeros(0), {"prior": prior, "answers": np.full((2, patterns.shape[1], 3), 1 / 3)}
    answer = patterns + 1
    named = (patterns > 0).any(axis=1)
    post = np.where(named, 1 / (1 + np.exp(-2.0 * patterns.sum(axis=1))), 0.0)
    pseudo = np.ones((2, patterns.shape[1], 3))
    pseudo[0, :, 0] += 3
    pseudo[1, :, 2] += 3
    answers = pseudo
    for _ in range(rounds):
        weight = np.stack([counts * (1 - post), counts * post])
        answers = pseudo.copy()
        for y in (0, 1):
            for lab in range(patterns.shape[1]):
                answers[y, lab] += np.bincount(answer[:, lab], weights=weight[y], minlength=3)
        answers /= answers.sum(axis=2, keepdims=True)
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        score = np.log(prior) - np.log1p(-prior)
        for lab in range(patterns.shape[1]):
            ratio = np.log(answers[1, lab]) - np.log(answers[0, lab])
            ratio = np.array([min(ratio[0], 0.0), 0.0, max(ratio[2], 0.0)])  # nothing said: no evidence
            score = score + ratio[answer[:, lab]]
        new = np.where(named, 1 / (1 + np.exp(-np.clip(score, -30, 30))), 0.0)
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return post, {"prior": prior, "answers": answers}


def fit_classifier(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression on soft targets, by Newton steps with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (target - p)) - ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curve, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


# --- the operator -----------------------------------------------------------------------------

_CANDIDATE = "array<struct<kind:string,start:int,end:int,votes:string,features:string>>"


def with_candidates(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` plus each text's candidates, base kinds first, with votes (``+0-`` a labeler) and features (``01``)."""

    def make():
        def one(t: str) -> list[dict]:
            base = base_spans(t)
            return [
                {
                    "kind": s[0],
                    "start": s[1],
                    "end": s[2],
                    "votes": "".join("-0+"[v + 1] for v in votes(t, s)),
                    "features": "".join(map(str, features(t, s))),
                }
                for s in [*base, *loose_spans(t, base)]
            ]

        return lambda texts: {name: [one(t) for t in texts]}

    return add_from_text(docs, text, f"`{name}` {_CANDIDATE}", make)


def fit(candidates: DataFrame, column: str) -> tuple[np.ndarray, dict]:
    """Classifier weights and labeler estimates from all candidates.

    Only counts leave the executors: rows by (votes, features), both of fixed length, so
    their number is bounded by the feature space and not by the corpus.
    """
    rows = (
        candidates.select(F.explode(column).alias("c"))
        .groupBy("c.votes", "c.features")
        .agg(F.count("*").alias("n"))
        .orderBy("votes", "features")
        .collect()
    )
    if not rows:
        return np.zeros(0), {}
    said: dict[str, int] = {}
    for r in rows:
        said[r.votes] = said.get(r.votes, 0) + r.n
    patterns = np.array([["-0+".index(c) - 1 for c in v] for v in said], dtype=int).reshape(-1, len(LABELERS))
    post, estimates = fit_reliabilities(patterns, np.array(list(said.values()), dtype=float))
    truth = dict(zip(said, post))
    x = np.array([[int(c) for c in r.features] for r in rows], dtype=float).reshape(len(rows), -1)
    weights = fit_classifier(x, np.array([truth[r.votes] for r in rows]), np.array([r.n for r in rows], dtype=float))
    return weights, estimates


def decided(found: Column, weights: Sequence[float], threshold: float) -> Column:
    """The candidates that stand: base kinds, and loose ones that the classifier takes."""

    def likely(c: Column) -> Column:
        score = F.lit(0.0)
        for k, w in enumerate(weights):
            score = score + F.when(F.substring(c["features"], k + 1, 1) == "1", F.lit(float(w))).otherwise(0.0)
        return 1 / (1 + F.exp(-score)) >= threshold

    kept = F.filter(found, lambda c: c["kind"].isin(*BASE_KINDS) | likely(c)) if len(weights) else F.filter(found, lambda c: c["kind"].isin(*BASE_KINDS))
    return F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))


def find_pii(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``doc_id, spans``: one row a row of ``docs``, spans as array of (kind, start, end).

    Whole texts (null: empty) are read once; the candidates, which are few, are written to
    the checkpoint folder, counted for the estimates and then decided on in place. A
    corpus without candidates trains nothing. Repeated rows count as often as they stand;
    null ids are kept; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = cut_lineage(with_candidates(rows, "text", "found").select("doc_id", "found"))
    weights, _ = fit(rows, "found")
    return rows.select("doc_id", decided(F.col("found"), weights.tolist(), threshold).alias("spans"))


def masked(text: str, spans: Sequence[Span], mark: str = "[private]") -> str:
    return blanked(text, [(a, b) for _, a, b in spans], mark)
