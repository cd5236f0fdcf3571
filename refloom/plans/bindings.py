"""Bindings of the operators' inputs to the driver's tables.

The driver tables hold no commune codes, catalog records or file links, so these
views derive them from whole tables (every row of the source flows through). The
SQL twins of these views, used by the oracle, are in ``refloom.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def code_of(k: Column) -> Column:
    """CODE(k): invalid (``X…``), Corsican (``2A…``) and ordinary five-digit codes.

    ``k*67 mod 99000`` is one-to-one below 99,000, so ordinary codes do not collide.
    """
    return (
        F.when(k % 97 == 0, F.concat(F.lit("X"), k.cast("string")))
        .when(k % 50 == 7, F.concat(F.lit("2A"), F.lpad((k % 1000).cast("string"), 3, "0")))
        .otherwise(F.lpad(((k * 67) % 99000).cast("string"), 5, "0"))
    )


def invalid_code(k: Column) -> Column:
    return F.concat(F.lit("X"), k.cast("string"))


def cog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code list ``(com, typecom, comparent)`` from ``customer``."""
    c = table(spark, sf_dir, "customer")
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    typecom = (
        F.when(seg == "HOUSEHOLD", "COM")
        .when(seg == "MACHINERY", "ARM")
        .when(seg == "BUILDING", "comd")
        .when(seg == "AUTOMOBILE", "COMA")
    )
    parent = F.when(k % 10 == 3, F.lit("  ")).when(seg.isin("MACHINERY", "BUILDING"), code_of(F.expr("c_custkey div 10")))
    return c.select(code_of(k).alias("com"), typecom.alias("typecom"), parent.alias("comparent"))


def uu_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urban units ``(codgeo, tuu2020, tduu2020)`` from ``part``: partial coverage, some
    codes twice. Uncovered parts get an invalid code, which the code filter drops."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    base = p.select(
        F.when(k % 3 != 0, code_of(k)).otherwise(invalid_code(k)).alias("codgeo"),
        (F.col("p_size") % 9).cast("string").alias("tuu2020"),
        F.col("p_brand").alias("tduu2020"),
    )
    dup = p.select(
        F.when(k % 40 == 1, code_of(k)).otherwise(invalid_code(k)).alias("codgeo"),
        F.lit("dup").alias("tuu2020"),
        F.col("p_brand").alias("tduu2020"),
    )
    return base.unionAll(dup)


def history_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event history ``(com_av, com_ap)`` from ``part``: a doubling chain, no cycles."""
    p = table(spark, sf_dir, "part")
    return p.select(code_of(F.col("p_partkey")).alias("com_av"), code_of(F.col("p_partkey") * 2).alias("com_ap"))


def history_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot history ``(COM, DATE_DEBUT, DATE_FIN)`` from ``orders``: one validity
    interval per order, keyed by the customer's code."""
    o = table(spark, sf_dir, "orders")
    start = F.to_date("o_orderdate")
    return o.select(
        code_of(F.col("o_custkey")).alias("COM"),
        F.date_format(start, "yyyy-MM-dd").alias("DATE_DEBUT"),
        F.date_format(F.date_add(start, 365), "yyyy-MM-dd").alias("DATE_FIN"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File links ``(grp, pos, link)`` from ``pages``: 7 groups, position = page id. The file's
    kind comes from the page's language, its suffix from how the url ends, its year from
    the length of the markup."""
    p = table(spark, sf_dir, "pages")
    i, url = F.col("page_id"), F.col("url")
    name = F.when(url.contains("/en/"), "/cog_").when(url.contains("/fr/"), "/base_tu_2020_").otherwise("/map_")
    ext = (
        F.when(url.contains("?page"), ".csv").when(url.contains("?utm"), ".xlsx").when(url.contains("#"), ".xls")
        .when(url.endswith("/"), ".zip").when(url.endswith(".html"), ".html").otherwise(".csv")
    )
    link = F.concat(
        F.lit("https://data.example.org/fr/statistiques/fichier/"), i.cast("string"), name,
        (F.lit(2015) + F.length("html") % 15).cast("string"), ext,
    )
    return p.select(F.concat(F.lit("g"), (i % 7).cast("string")).alias("grp"), i.alias("pos"), link.alias("link"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive members ``(archive, member)`` from ``pages`` urls."""
    p = table(spark, sf_dir, "pages")
    archive = F.regexp_replace(F.regexp_replace("url", r"^https?://", ""), "/.*$", "")
    path = F.regexp_replace(F.regexp_replace("url", r"^https?://[^/]+/", ""), r"[?#].*$", "")
    member = F.concat(path, F.lit("/Données-"), (F.col("page_id") % 4).cast("string"), F.lit(".CSV"))
    return p.select(archive.alias("archive"), member.alias("member"))


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog records from ``documents``; the whole text is the description."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    title = (
        F.when(k % 5 == 0, "Installations radioélectriques de plus de 5W")
        .when(k % 5 == 1, "Données  radioélectriques 5w")
        .when(k % 5 == 2, "Table de références")
        .otherwise(F.concat_ws(" ", F.lit("Corpus"), F.col("source"), F.col("lang")))
    )
    return d.select(
        F.when(k % 11 == 0, F.lit("")).otherwise(F.concat_ws("-", "source", "lang")).alias("id"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("source")).alias("slug"),
        F.concat(F.lit("p"), k.cast("string")).alias("page"),
        title.alias("title"),
        F.col("text").alias("description"),
        (k % 7).alias("query_pos"),
        k.alias("item_pos"),
        (k % 4).alias("n_resources"),
    )


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog resources ``(dataset_id, pos, title, url, format)`` from ``documents``."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    year = (F.lit(2020) + k % 8).cast("string")
    title = (
        F.when(k % 3 == 0, F.concat(F.lit("Table de références "), year))
        .when(k % 3 == 1, F.concat(F.lit("Cartographie "), year))
        .otherwise(F.concat_ws(" ", F.col("lang"), k.cast("string")))
    )
    url = F.concat(
        F.lit("https://data.example.org/d/"), k.cast("string"),
        F.when(k % 3 == 0, ".csv").when(k % 3 == 1, ".tar.gz").otherwise(""),
    )
    return d.select(
        F.col("source").alias("dataset_id"), k.alias("pos"), title.alias("title"), url.alias("url"),
        F.when(k % 2 == 0, "CSV").otherwise("").alias("format"),
    )


def described_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resources with all seven fields that are searched; the description is the document's whole text, and what
    is looked for is spread over type, mime and latest."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    return d.select(
        k.alias("pos"), F.when(k % 5 > 0, F.concat(F.lit("Liste "), k.cast("string"))).alias("title"), F.col("text").alias("description"),
        F.when(k % 2 == 0, "TABLE").alias("type"), F.when(k % 7 > 0, F.col("lang")).alias("format"),
        F.when(k % 3 == 0, "text/référence").alias("mime"), F.col("source").alias("url"),
        F.concat(F.lit("https://data.example.org/"), (F.lit(2020) + k % 8).cast("string")).alias("latest"),
    )
