"""The registered queries of the operators, one each, and their SQL where SQL can say it.

Every query applies its operator with production parameters to its whole table and
derives the digest columns of its result from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.llm import (
    chat,
    collocations,
    hard_negatives,
    htmltext,
    minhash,
    mixing,
    packing,
    pii,
    quality_model,
    quality_rules,
    secrets,
    simhash,
    spans,
    urlrules,
)
from refloom.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


# --- 1: URL filters ---------------------------------------------------------------------------

URL_RULES = (
    urlrules.Rule("block", "net/"),
    urlrules.Rule("allow", "example.net/en/"),
    urlrules.Rule("block", "example.com/de/"),
    urlrules.Rule("allow", "org/fr/"),
)
#: Rules of any host, for pages that hold no running text.
URL_PATTERNS = (
    urlrules.Rule("block", "*/login/"),
    urlrules.Rule("block", "*/*/login/"),
    urlrules.Rule("block", "*/cart/"),
    urlrules.Rule("block", "*/*/tag/"),
    urlrules.Rule("block", "ads.*/"),
)


@query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urlrules.judge_urls(pages, URL_RULES, URL_PATTERNS).select("page_id", "host", "path", "rule", "verdict")


SQL["op1_url_filters"] = r"""
WITH cut AS (
  SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS pos FROM pages
), tail AS (
  SELECT page_id, CASE WHEN pos > 0 THEN substr(u, pos + 3) ELSE '' END AS t FROM cut
), parts AS (
  SELECT page_id,
         translate(regexp_extract(t, '(?s)^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(t, '(?s)^[^/?#]*([^?#]*)', 1) AS path
  FROM tail
), rules(rule, verdict, h, p) AS (
  VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
         ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
)
SELECT page_id, host, path,
       (SELECT arg_max(rule, length(rule)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
       coalesce(
         (SELECT arg_max(verdict, length(rule)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
         CASE WHEN starts_with(path, '/login/') OR regexp_matches(path, '(?s)^/.*/(login|tag)/')
                OR starts_with(path, '/cart/') OR (regexp_matches(host, '(^|\.)ads\.') AND starts_with(path, '/'))
              THEN 'block' ELSE 'allow' END) AS verdict
FROM parts
"""

# --- 2: quality rules -------------------------------------------------------------------------


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "quality.*")


# --- 3: secret scans --------------------------------------------------------------------------


@query
def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    found = F.col("spans")
    return out.select(
        "doc_id",
        *[spans.count_of(found, k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        spans.digest(found, secrets.BASE_KINDS).alias("base_sha256"),
        spans.joined(found, secrets.KINDS).alias("spans"),
    )


# --- 4: document fingerprints -----------------------------------------------------------------


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.successor_likeness(read(spark, sf_dir, "documents"))


# --- 5: quality classifier --------------------------------------------------------------------

#: Documents scored at least so are predicted to be of label 1.
GOOD_FROM = 0.3


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.fit(docs, read(spark, sf_dir, "labels"))
    return quality_model.score(docs, model).select(
        "doc_id",
        quality_model.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
    )


# --- 6: SimHash near-duplicates ---------------------------------------------------------------


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return out.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


# --- 7: best-fit packing ----------------------------------------------------------------------


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op7_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_file())


# --- 8: chat formatting -----------------------------------------------------------------------

_CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", _CONTROL_TEXT), (-1, 1, "assistant", _CONTROL_TEXT)], turns.schema)
    out = chat.format_conversations(turns.unionByName(added))
    back = chat.parse(F.col("formatted"))
    return out.withColumns({"back": back, "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))}).select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "escaped_turns",
        "round_trip_ok",
    )


SQL["op8_chat_formatting"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(role, '(<|\[)(\\*)(/?s>|/?INST\])', '\1\2\\\3', 'g') AS r2,
            regexp_replace(text, '(<|\[)(\\*)(/?s>|/?INST\])', '\1\2\\\3', 'g') AS t2 FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(length('<s>[INST]') + length(r2) + length('[/INST]') + length(t2) + length('</s>'))::BIGINT AS formatted_chars,
       sum(CASE WHEN r2 <> role OR t2 <> text THEN 1 ELSE 0 END)::BIGINT AS escaped_turns,
       true AS round_trip_ok
FROM e GROUP BY conv_id
"""

# --- 9: mixing --------------------------------------------------------------------------------


@query
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL["op9_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) AS k FROM d GROUP BY source
), w AS (
  SELECT *, (k - 1) % 3 + 1 AS wt, 3 * n AS cap, sum(n) OVER () AS total FROM s
), o AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS c, sum(wt) OVER () - coalesce(sum(wt) OVER before, 0) AS left_w
  FROM w WINDOW before AS (ORDER BY cap / wt, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), st AS (
  SELECT *, min(CASE WHEN cap * left_w < (total - c) * wt THEN 1 ELSE 0 END)
         OVER (ORDER BY cap / wt, k ROWS UNBOUNDED PRECEDING) AS stopped FROM o
), tg AS (
  SELECT source, n AS source_size, CASE WHEN stopped = 1 THEN cap::DOUBLE
    ELSE ((total - sum(cap * stopped) OVER ()) * wt)::DOUBLE / (sum(wt * (1 - stopped)) OVER ())::DOUBLE END AS target FROM st
), r AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY d.source
           ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR), doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN tg ON d.source IS NOT DISTINCT FROM tg.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
          + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
FROM r
"""

# --- 10: PII ----------------------------------------------------------------------------------


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(read(spark, sf_dir, "documents"))
    found = F.col("spans")
    return out.select(
        "doc_id",
        *[spans.count_of(found, k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        spans.digest(found, pii.BASE_KINDS).alias("base_sha256"),
        spans.joined(found, pii.KINDS).alias("spans"),
    )

# --- 11: HTML extraction ----------------------------------------------------------------------


@query
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = htmltext.extract_main_text(pages, into="text")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# --- 12: hard-negative mining -----------------------------------------------------------------


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved))


SQL["op12_hard_negatives"] = r"""
WITH e AS (
  SELECT vec_id::BIGINT AS id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
  SELECT a.id AS anchor_id, b.id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.id <> b.id WHERE a.id % 50 = 0
), pos AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM pos p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 3
"""

# --- 13: phrase collocations ------------------------------------------------------------------


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


SQL["op13_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), total AS (
  SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, size, unnest([array_to_string(ws[k:k + size - 1], ' ') FOR k IN range(1, len(ws) - size + 2)]) AS phrase
  FROM w, (VALUES (1), (2), (3)) s(size)
), f AS (
  SELECT lang, size, phrase, count(*)::BIGINT AS n FROM g GROUP BY ALL HAVING count(*) >= 10
), sides AS (
  SELECT lang, phrase, size, n AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:size], ' ') AS rest
  FROM f JOIN (VALUES (1), (2)) ks(k) ON size > k
), cut AS (
  SELECT c.lang, c.phrase, c.size, a, k, l.n AS l, r.n AS r,
         ((1000000::HUGEINT * a * a) // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM sides c JOIN f l ON l.lang = c.lang AND l.phrase = head JOIN f r ON r.lang = c.lang AND r.phrase = rest
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), around AS (
  SELECT lang, phrase, max(n) AS n FROM (
    SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[k:k + 1], ' ') FOR k IN [1, 2]]) AS phrase, n FROM f WHERE size = 3
  ) GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN around x ON b.lang = x.lang AND b.phrase = x.phrase
  WHERE b.size = 3 OR x.n IS NULL OR 100 * x.n < 50 * b.a
)
SELECT kept.lang, row_number() OVER w AS rank, phrase, a, l, r, total.n, score
FROM kept JOIN total ON kept.lang = total.lang
WINDOW w AS (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER w <= 2000
"""
