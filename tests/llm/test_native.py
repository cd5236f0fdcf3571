"""The native operators (URL rules, chat formatting, mixing) against plain loops, on odd rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from refloom.llm import chat, mixing, urlrules
from refloom.llm.urlrules import Rule

# --- URL rules --------------------------------------------------------------------------------

RULES = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]


def judged(url, rules=RULES, patterns=(), default="allow"):
    """The definition, rule by rule."""
    at = (url or "").find("://")
    tail = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", tail)[0]
    path = re.match(r"[^?#]*", tail[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)

    def fits(rule):
        h, _, p = rule.pattern.partition("/")
        if "*" not in rule.pattern:
            return (host == h or host.endswith("." + h)) and path.startswith("/" + p)
        pattern = ("" if h.startswith("*") else r"(.*\.)?") + re.escape(h).replace(r"\*", "[^/]*") + re.escape("/" + p).replace(r"\*", ".*")
        return re.match(pattern, host + path, re.S) is not None

    best = lambda rs: min((r for r in rs if fits(r)), key=lambda r: (-len(r.pattern), r.verdict != "block", r.pattern), default=None)
    rule, loose = best(rules), best(patterns)
    return host, path, rule and rule.pattern, (rule or loose).verdict if rule or loose else default


def urls():
    rng = random.Random(1)
    hosts = ["a.example.net", "example.net", "EXAMPLE.net", "xexample.com", "www.example.com", "b.org", ".net", "net", "ads.x.io", "münchen.net", "c_net", ""]
    paths = ["", "/", "/en/", "/en", "/en/1", "/de/2?x=/en/", "/fr/#top", "/fr", "//en/", "/x/login/y", "/a\nb/tag/", "/cart/1"]
    made = [f"{rng.choice(['http', 'https', ''])}://{h}{p}" for h in hosts for p in paths]
    return [None, "", "no scheme", "a://b://c.net/x", "://", *made, *rng.choices(made, k=50)]


PATTERNS = [Rule("block", "*/login/"), Rule("block", "*/*/login/"), Rule("block", "ads.*/"), Rule("allow", "*/cart/"), Rule("block", "*/*tag*"), Rule("block", "*/ca*")]


@pytest.mark.parametrize("rules,patterns", [(RULES, PATTERNS), (RULES, []), ([], PATTERNS), ([], [])])
@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_urls_against_every_rule(spark, monkeypatch, rules, patterns, broadcast):
    monkeypatch.setattr(urlrules, "BROADCAST_RULES", broadcast)
    rows = [(i if i % 9 else None, u, "x") for i, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    out = urlrules.judge_urls(pages, rules, patterns)
    assert out.columns == ["page_id", "url", "host", "host_", "path", "rule", "verdict"]
    got = sorted(((r.page_id, r.url, r.host_, r.path, r.rule, r.verdict) for r in out.collect()), key=repr)
    assert got == sorted(((i, u, *judged(u, rules, patterns)) for i, u, _ in rows), key=repr)
    assert urlrules.judge_urls(pages.limit(0), rules, patterns).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    places = spark.createDataFrame([(f"h{i}.example.net/en/{i % 3}",) for i in range(20)] + [("q.rare.net/en/",)], "place string")
    index = urlrules.rule_index(places, [Rule("block", "rare.net/en/"), Rule("block", "example.net/en"), Rule("block", "*/*x")], []).collect()
    assert {r.pattern: r.token for r in index} == {"rare.net/en/": "rare", "example.net/en": "example", "*/*x": "*"}


# --- chat -------------------------------------------------------------------------------------


def turns_table(spark):
    rng = random.Random(2)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<\\s>", "</\\s>", "[\\\\/INST]", "<", "[", "/", "s>", "INST]", "é", "\n", " ", "ok", "$1"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a</s>b", "assistant"]), "".join(rng.choices(bits, k=rng.randint(0, 9)))) for c in range(120) for t in range(rng.randint(1, 6))]
    rows += [(None, 0, "user", "x"), (None, None, "assistant", None), (500, 1, "assistant", "same"), (500, 1, "assistant", "same"), (501, 0, "assistant", "long [INST] " * 5000)]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")


def test_conversations_come_back_identical(spark):
    rows, table = turns_table(spark)
    got = chat.format_conversations(table).withColumns(
        {"back": chat.parse(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))}
    ).collect()
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert len(got) == len(by)
    for r in got:
        turns = [(role, text) for _, _, role, text in sorted(by[r.conv_id])]
        assert [(b.role, b.text) for b in r.back] == turns and r.round_trip_ok
        assert r.loss == "".join(x for role, x in turns if role == "assistant")
        assert r.formatted.count("<s>") == r.formatted.count("</s>") == r.formatted.count("[/INST]") == len(turns)
        plain = "".join(f"<s>[INST]{a}[/INST]{b}</s>" for a, b in turns)
        assert r.escaped_turns or r.formatted == plain
    assert chat.format_conversations(table.limit(0)).count() == 0


# --- mixing -----------------------------------------------------------------------------------


def plain_mix(rows):
    """Targets by repeated resharing, then each source in key order."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total = {s: sum(size(t) for _, x, t in rows if x == s) for s in names}
    target, stopped = {}, set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in stopped)
        free = [s for s in names if s not in stopped]
        target = {s: 3 * total[s] if s in stopped else left * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if target[s] > 3 * total[s]}
        if not over:
            break
        stopped |= over
    out = []
    for s in names:
        mine = [(hashlib.md5(f"mix:{'' if i is None else i}:{size(t)}".encode()).hexdigest(), i is not None, i or 0, size(t), i) for i, x, t in rows if x == s]
        budget, n = int(target[s] + 1e-9), total[s]
        left = budget % n if n else 0
        for _, _, _, k, i in sorted(mine, key=lambda r: r[:4]):
            out.append((i, s, k, n, round(target[s], 6), (budget // n * k if n else 0) + max(0, min(k, left))))
            left -= k
    return sorted(out, key=repr)


def docs_rows():
    rng = random.Random(4)
    sources = ["a", "B", "é", "", None, "hot", "hot", "hot", "tiny"]
    rows = [(i, rng.choice(sources[:-1]), " ".join("w" * rng.randint(0, 12) for _ in range(rng.randint(0, 30)))) for i in range(300)]
    return rows + [(900, "tiny", "one two"), (901, "empty", ""), (902, "empty", None), (None, "a", "x y"), (5, "a", "same"), (5, "a", "same"), (903, "a", "long " * 30_000)]


def test_mix_against_plain_loop(spark):
    rows = docs_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, part int")
    out = mixing.mix(docs)
    got = sorted(((r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in out.collect()), key=repr)
    assert got == plain_mix(rows)
    assert all(t <= 3 * k for _, _, k, _, _, t in got)
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=repr) == sorted(map(tuple, out.collect()), key=repr)


def test_mixed_documents_stand_as_often_as_taken(spark):
    rows = [(i, "s" if i % 4 else "t", "w " * (10 + i % 5)) for i in range(200)]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, source string, text string, copy int, times string")
    taken = {i: t / max(k, 1) for i, _, k, _, _, t in plain_mix(rows)}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    times = {}
    for r in out.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert all(abs(times.get(i, 0) - x) <= 0.5 for i, x in taken.items())
    assert mixing.mixed_documents(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_mixed_documents_without_ids_have_their_own_shares(spark):
    rows = [(None, "s" if i % 4 else "t", f"w{i} " * 10) for i in range(200)] + [(None, "t", "same " * 10)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    taken = {s: sum(t for _, x, _, _, _, t in plain_mix(rows) if x == s) for s in "st"}
    kept = mixing.mixed_documents(docs).collect()
    for s, words in taken.items():
        assert abs(10 * sum(r.source == s for r in kept) - words) <= 5
    times = [sum(r.text == t for r in kept) for t in {t for _, x, t in rows if x == "s"}]
    assert max(times) - min(times) <= 1


def test_queries_match_their_sql(spark):
    import duckdb

    from refloom.llm.queries import QUERIES, SQL

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in SQL.items():
        df = QUERIES[name](spark, sf)
        assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, con.execute(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()))


@pytest.mark.parametrize("limit", [None, 0])
def test_mixed_documents_stand_as_often_as_the_mix_takes_them(spark, monkeypatch, limit):
    """Against the mix row by row: ties, copies alike in every column, null ids and sources; joined by broadcast and by shuffle."""
    from collections import Counter

    from refloom.llm import common, mixing

    if limit is not None:
        monkeypatch.setattr(mixing, "small", lambda df: False)
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(40)]), " ".join(["w"] * rng.choice([0, 1, 2, 5, 30])), rng.choice(["a", "b", None, "c", "hot", "hot"])) for _ in range(300)]
    rows += [(7, "one two three four", "hot")] * 90 + [(8, "one two", "d")] * 41 + [(9, None, "e"), (9, "", "e")]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id int, text string, source string, key string, times int").repartition(5)
    columns = [F.col("doc_id"), F.col("source"), mixing.word_count(F.col("text")).alias("size"), common.row_key(docs).alias("row"), F.col("text")]
    want = Counter()
    for r in mixing._taken(docs.select(*columns), (1, 2, 3), 3, "mix").collect():
        want[r.doc_id, r.text, r.source] += int(r.taken / max(r.size, 1) + 0.5)
    got = Counter((r.doc_id, r.text, r.source) for r in mixing.mixed_documents(docs).collect())
    assert got == +want
    assert mixing.mixed_documents(docs).columns == docs.columns and mixing.mixed_documents(docs.limit(0)).count() == 0
