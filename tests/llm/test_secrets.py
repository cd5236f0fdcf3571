"""Secret spans against the definition, linking by example."""

import hashlib
import random
import re

from refloom.llm import secrets
from refloom.llm.secrets import KINDS, redact_secrets, scan_secrets, secret_spans
from refloom.llm.spans import blanked


def base(text):
    rules = [
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ]
    found = []
    for k, (kind, rule, good) in enumerate(rules):
        flags = re.ASCII | re.IGNORECASE if kind == "assign" else 0
        found += [(m.start(), k, kind, m.end()) for m in re.finditer(rule, text or "", flags) if good(m)]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]


def odd_texts():
    rng = random.Random(2)
    bits = ["password", "PassWd", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc", "secretsecret", "x1y2z3w4", "AKIA", "ABCD1234EFGH5678",
            "0123456789abcdef", "deadbeef", "é", "\n", "\n\n", ".", "ſecret", "toKen"]
    return [None, "", " ", "token=token:abcdef", "secret = 12345", "AKIAAKIA" + "A" * 20] + [
        "".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(400)
    ]


def listed(spans):
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted((a, KINDS.index(k), k, b) for k, a, b in spans)]


def test_base_spans_follow_the_definition():
    for t in odd_texts():
        own = [s for s in secret_spans(t or "") if s[0] in ("assign", "access", "hex")]
        assert listed(own) == base(t), t


def kinds(text, **options):
    return sorted(k for k, _, _ in secret_spans(text, **options))


def test_weak_parts_count_only_together():
    random_token = "Zx81kQp0Lm92vTrW"
    assert kinds(f"the run {random_token} stands alone") == []
    assert kinds("user=alice went home") == []
    assert kinds("see https://db.host.org/path") == []
    assert kinds(f"user=alice key {random_token}") == ["identifier", "weak"]
    assert kinds(f"https://db.host.org/path with {random_token}") == ["weak"]
    assert kinds(f"user=alice https://db.host.org/x {random_token}") == ["endpoint", "identifier", "weak"]
    assert kinds("client_id: abc123 password=hunter22") == ["assign", "identifier"]
    assert kinds("user=alice pwd=ab12") == ["identifier", "weak"]
    # scopes end at blank lines and at the reach
    assert kinds(f"user=alice\n\n{random_token}") == []
    assert kinds(f"user=alice\n \n{random_token}") == []
    assert kinds("user=alice " + "word " * 100 + random_token) == []
    assert kinds("user=alice " + "word " * 100 + random_token, reach=600) == ["identifier", "weak"]


def test_long_partners_link_on_either_side():
    key, token = "k3Y" * 140, "Zx81kQp0Lm92vTrW"
    assert kinds(f"token={key} client_id: abc123") == kinds(f"client_id: abc123 token={key}") == ["assign", "identifier"]
    url = "https://host.org/file?sig=" + "aB3" * 130
    assert kinds(f"{url} {token}") == kinds(f"{token} {url}") == ["weak"]
    assert kinds(f"token={key}\n\nclient_id: abc123") == ["assign"]
    assert kinds(f"token={key}" + " word" * 80 + " client_id: abc123") == ["assign"]


def scopes_overlap(text, x, y, reach):
    """By hand: the parts differ in place, are less than ``reach`` apart, and no blank line is between them."""
    (_, a, b), (_, c, d) = sorted((x, y), key=lambda s: s[1:])
    return a != c and c < b + reach and not re.search(r"\n[ \t\r]*\n", text[b:c] if c > b else "")


def test_links_against_all_pairs():
    rng, linked = random.Random(8), 0
    parts = ["token=" + "q7R" * 20, "token=abcdef12", "password: " + "Ab1" * 12, "user=alice", "client_id: " + "n0de" * 20, "https://db.host.org/x",
             "https://db.host.org/" + "pQ4" * 25, "host: db.org", "AKIA" + "ABCD1234" * 3, "deadbeef" * 9, "word word", "\n\n", "a\n \nb", "."]
    for _ in range(500):
        text = " ".join(rng.choices(parts, k=rng.randint(2, 12)))
        reach = rng.choice([5, 20, 60])
        every = {k: [(k, m.start(), m.end()) for m in r.finditer(text)] for k, r in (("identifier", secrets._IDENTIFIER), ("endpoint", secrets._ENDPOINT))}
        spans = secret_spans(text, reach)
        keys = [s for s in spans if s[0] in ("assign", "hex", "weak")]
        ids = every["identifier"] + [s for s in spans if s[0] == "access"]
        near = lambda s, others: any(scopes_overlap(text, s, o, reach) for o in others)
        wanted = [s for s in every["identifier"] if near(s, keys)] + [s for s in every["endpoint"] if near(s, keys) and near(s, ids)]
        assert sorted(s for s in spans if s[0] in ("identifier", "endpoint")) == sorted(wanted), text
        linked += len(wanted)
    assert linked > 300


def test_very_long_text():
    text = "user=bob " * 20_000 + "\n\n" + "token=abcdef12 " * 20_000
    spans = secret_spans(text)
    assert sum(k == "assign" for k, _, _ in spans) == 20_000 and all(k == "assign" for k, _, _ in spans)


def test_blanked_covers_overlaps_once():
    assert blanked("abcdefgh", [(1, 3), (2, 5), (6, 7)], "*") == "a*f*h"
    assert blanked("abc", [(0, 3), (1, 2)], "*") == "*"
    assert blanked("abcd", [(0, 2), (2, 3)], "*") == "**d"


def test_operator_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, "", None), (None, "token=abcdef12 and", "b")], "doc_id long, text string, kind string")
    out = scan_secrets(docs)
    assert out.columns == ["doc_id", "text", "kind", "spans"]
    assert sorted(len(r.spans) for r in out.collect()) == [0, 0, 0, 1]
    assert sorted(r.redacted for r in redact_secrets(docs).collect()) == ["", "", "", "[secret] and"]
    assert scan_secrets(docs.limit(0)).count() == 0


def test_query_against_the_definition(spark):
    from refloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op3_secret_scans"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = base(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in own) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert r.spans == ",".join(listed(secret_spans(texts[r.doc_id] or "")))
        assert [s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")] == own
