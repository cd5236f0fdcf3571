"""Registered queries for ingestion metadata (F8, F9, A7, K3, O6) and union by name
(S5, P3). Archive members are derived from ``pages`` urls; the union-by-name load
reads ``customer`` and ``supplier`` as all-text tables with raw headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from refloom.operators.schema import union_by_name, with_normalized_headers
from refloom.plans import bindings as B
from refloom.plans.oracle import with_views
from refloom.plans.registry import query
from refloom.sources import archives as A

_STEM = "regexp_replace(member, '([^/])\\.[^./]+$', '\\1')"
_ID1 = f"lower(regexp_replace({_STEM}, '[^\\p{{L}}\\p{{N}}]', '_', 'g'))"
_ID2 = f"regexp_replace(regexp_replace({_ID1}, '_+', '_', 'g'), '^_|_$', '', 'g')"
TABLE_NAME_SQL = (
    f"CASE WHEN {_ID2} = '' THEN 'table_data' WHEN regexp_matches({_ID2}, '^\\p{{Nd}}') THEN 't_' || {_ID2} "
    f"ELSE {_ID2} END"
)


def _members(spark, sf):
    m = B.members(spark, sf)
    return m.select(
        "archive",
        F.col("archive").alias("archive_path"),
        F.array().cast("array<string>").alias("chain"),
        "member",
        F.lit(0).alias("depth"),
        F.lower(F.regexp_extract("member", r"[^/](\.[^./]+)$", 1)).alias("suffix"),
        F.lit(None).cast("string").alias("error"),
    )


@query(
    "table_names",
    with_views(("members",), f"SELECT archive, member, {TABLE_NAME_SQL} AS table_name FROM members"),
    "F8 F9",
)
def table_names(spark, sf):
    m = B.members(spark, sf)
    return m.select("archive", "member", A.table_name(F.col("member")).alias("table_name"))


@query(
    "files_per_table",
    with_views(
        ("members",),
        f"""SELECT table_name, count(*) AS n_files, count(DISTINCT archive) AS n_archives
            FROM (SELECT DISTINCT archive, member, {TABLE_NAME_SQL} AS table_name FROM members)
            GROUP BY table_name""",
    ),
    "A7 K3",
)
def files_per_table(spark, sf):
    m = B.members(spark, sf).withColumn("table_name", A.table_name(F.col("member")))
    return A.files_per_table(m)


@query(
    "first_tabular_member",
    with_views(
        ("members",),
        """SELECT archive, arg_min(member, [CASE WHEN lower(member) LIKE '%.csv' THEN 0 ELSE 1 END::VARCHAR]
                                            || str_split(member, '/')) AS member
           FROM members GROUP BY archive""",
    ),
    "O6 S3",
)
def first_tabular_member(spark, sf):
    return A.first_tabular_member(_members(spark, sf)).select("archive", "member")


def _as_text_with_headers(df, mapping):
    return df.select(*[F.col(src).cast("string").alias(raw) for raw, src in mapping])


@query(
    "union_by_name_load",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS nom, CAST(c_nationkey AS VARCHAR) AS cle_nation,
              CAST(c_acctbal AS VARCHAR) AS solde_compte, c_mktsegment AS segment_marche,
              CAST(NULL AS VARCHAR) AS soldecompte, 'customer' AS filename FROM customer
       UNION ALL
       SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), NULL, NULL,
              CAST(s_acctbal AS VARCHAR), 'supplier' FROM supplier""",
    "S5 P3",
)
def union_by_name_load(spark, sf):
    cust = _as_text_with_headers(
        B.table(spark, sf, "customer"),
        [("ID", "c_custkey"), ("Nom", "c_name"), ("Clé Nation", "c_nationkey"), ("Solde Compte", "c_acctbal"),
         ("Segment Marché", "c_mktsegment")],
    )
    supp = _as_text_with_headers(
        B.table(spark, sf, "supplier"),
        [("Id", "s_suppkey"), ("NOM", "s_name"), ("Clé  nation", "s_nationkey"), ("Solde-Compte", "s_acctbal")],
    )
    frames = [
        with_normalized_headers(cust).withColumn("filename", F.lit("customer")),
        with_normalized_headers(supp).withColumn("filename", F.lit("supplier")),
    ]
    return union_by_name(frames)
