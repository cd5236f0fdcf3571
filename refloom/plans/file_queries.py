"""Registered queries for the readers (S1-S8, S10, X2, K3), over files that a Spark
job derives from whole driver tables (see ``fixture_files``): zip archives of CSV
members from ``customer``/``supplier``, delimited files from ``part``, dBASE and
GeoJSON files from ``part``, catalog responses from ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from refloom.plans import bindings as B
from refloom.plans import fixture_files as FF
from refloom.plans.oracle import CODE, MAP_COLS, METRO, with_views
from refloom.plans.registry import query
from refloom.session import cut_lineage
from refloom.sources import archives as A
from refloom.sources import delimited
from refloom.sources.catalog import read_catalog
from refloom.sources.dbf import read_dbf
from refloom.sources.delimited import read_lenient_csv, read_tabular
from refloom.sources.geojson import read_geojson

# Rows whose keys are this far apart stand in different files, so files grow in number with
# the rows and not in size: some 80 KB of a narrow table, 2 MB of documents.
KEYS_A_FILE = 2_000
DOCS_A_FILE = 500
# The manifest and the rejects are rows and counts of archives, so theirs are many and small.
KEYS_AN_ARCHIVE = 250


def _block(k, keys=KEYS_A_FILE):
    """Number of a row's archive: two for each block of ``keys`` keys, by parity of the key."""
    return F.floor(k / keys) * 2 + k % 2


def _BLOCK(k: str, keys: int = KEYS_A_FILE) -> str:
    return f"({k} // {keys} * 2 + {k} % 2)"


def _archive_dir(spark, sf, keys=KEYS_A_FILE) -> str:
    """Archives ``clients-<n>.zip``: ``exports/clients.csv`` (two header layouts and
    delimiters, by parity of n) and ``exports/fournisseurs.csv``."""
    c = B.table(spark, sf, "customer")
    k = F.col("c_custkey")
    even = (k % 2) == 0
    clients = c.select(
        F.concat(F.lit("clients-"), _block(k, keys).cast("string"), F.lit(".zip")).alias("archive"),
        F.lit("exports/clients.csv").alias("member"),
        F.when(even, F.array(F.lit("ID"), F.lit("Nom"), F.lit("Segment Marché")))
        .otherwise(F.array(F.lit("nom"), F.lit("id"), F.lit("Solde"))).alias("header"),
        F.when(even, F.lit(";")).otherwise(F.lit(",")).alias("sep"),
        k.alias("ord"),
        F.when(even, FF.text_fields(k, F.col("c_name"), F.col("c_mktsegment")))
        .otherwise(FF.text_fields(F.col("c_name"), k, F.format_string("%.2f", F.col("c_acctbal")))).alias("fields"),
    )
    s = B.table(spark, sf, "supplier")
    sk = F.col("s_suppkey")
    suppliers = s.select(
        F.concat(F.lit("clients-"), _block(sk, keys).cast("string"), F.lit(".zip")).alias("archive"),
        F.lit("exports/fournisseurs.csv").alias("member"),
        F.array(F.lit("Id"), F.lit("Nom Fournisseur"), F.lit("Nation")).alias("header"),
        F.lit(";").alias("sep"),
        sk.alias("ord"),
        FF.text_fields(sk, F.col("s_name"), F.col("s_nationkey")).alias("fields"),
    )
    out = FF.scratch_dir(spark, "archives")
    FF.write_archives(clients.unionByName(suppliers), out)
    return out


@query(
    "archive_load",
    f"""SELECT 'exports_clients' AS table_name, CAST(c_custkey AS VARCHAR) AS id, c_name AS nom,
               CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment_marche,
               CASE WHEN c_custkey % 2 = 1 THEN printf('%.2f', c_acctbal) END AS solde,
               NULL AS nom_fournisseur, NULL AS nation,
               'clients-' || CAST({_BLOCK('c_custkey')} AS VARCHAR) || '.zip' AS archive,
               'exports/clients.csv' AS member, CAST(NULL AS VARCHAR[]) AS _extra
        FROM customer
        UNION ALL
        SELECT 'exports_fournisseurs', CAST(s_suppkey AS VARCHAR), NULL, NULL, NULL, s_name, CAST(s_nationkey AS VARCHAR),
               'clients-' || CAST({_BLOCK('s_suppkey')} AS VARCHAR) || '.zip', 'exports/fournisseurs.csv', NULL
        FROM supplier""",
    "X2 S1 S2 S5 P3 F9: both tables of the archives",
)
def archive_load(spark, sf):
    tables, _ = A.load_archives(spark, _archive_dir(spark, sf))
    named = [df.withColumn("table_name", F.lit(name)) for name, df in sorted(tables.items())]
    return named[0].unionByName(named[1], allowMissingColumns=True)


@query(
    "archive_manifest",
    f"""SELECT 'exports_clients' AS table_name, count(DISTINCT {_BLOCK('c_custkey', KEYS_AN_ARCHIVE)}) AS n_files,
               count(DISTINCT {_BLOCK('c_custkey', KEYS_AN_ARCHIVE)}) AS n_archives FROM customer
        UNION ALL
        SELECT 'exports_fournisseurs', count(DISTINCT {_BLOCK('s_suppkey', KEYS_AN_ARCHIVE)}),
               count(DISTINCT {_BLOCK('s_suppkey', KEYS_AN_ARCHIVE)}) FROM supplier""",
    "K3 A7 X2",
)
def archive_manifest(spark, sf):
    _, manifest = A.load_archives(spark, _archive_dir(spark, sf, KEYS_AN_ARCHIVE))
    return manifest


@query(
    "archive_files",
    f"""SELECT DISTINCT 'clients-' || {_BLOCK('c_custkey')} || '.zip' AS archive, 'exports/clients.csv' AS member,
               'exports_clients' AS table_name, true AS has_size FROM customer
        UNION ALL
        SELECT DISTINCT 'clients-' || {_BLOCK('s_suppkey')} || '.zip', 'exports/fournisseurs.csv', 'exports_fournisseurs', true FROM supplier""",
    "S2 K3 X2: the files that a load reads, with their tables",
)
def archive_files(spark, sf):
    listed = A.list_members(A.archive_index(spark, _archive_dir(spark, sf)))
    return A.extracted_files(listed).select("archive", "member", "table_name", (F.col("size") > 0).alias("has_size"))


@query(
    "lenient_csv_load",
    """SELECT CAST(p_partkey AS VARCHAR) AS code_partie, p_name AS nom, p_brand AS marque,
              CAST(p_size AS VARCHAR) AS taille FROM part""",
    "S4 S10 P3",
)
def lenient_csv_load(spark, sf):
    out = FF.scratch_dir(spark, "csv")
    p = B.table(spark, sf, "part").select(
        F.col("p_partkey").alias("Code Partie"), F.col("p_name").alias("Nom"), F.col("p_brand").alias("Marque"),
        F.col("p_size").alias("Taille"),
    )
    p.write.mode("overwrite").option("header", True).option("sep", ";").csv(out)
    return read_tabular(spark, out + "/*.csv").drop("_extra")


def _units_rows(spark, sf):
    p = B.table(spark, sf, "part")
    k = F.col("p_partkey")
    return p.select(
        F.floor(k / KEYS_A_FILE).cast("string").alias("file"),
        k.alias("ord"),
        B.code_of(k).alias("CODGEO"),
        (F.col("p_size") % 9).cast("string").alias("TUU2020"),
        F.col("p_brand").alias("LIBUU2020"),
    )


_UNITS_SQL = f"""SELECT {CODE('p_partkey')} AS CODGEO, CAST(p_size % 9 AS VARCHAR) AS TUU2020,
                        p_brand AS LIBUU2020 FROM part"""


@query("dbf_load", _UNITS_SQL, "S6")
def dbf_load(spark, sf):
    out = FF.scratch_dir(spark, "dbf")
    FF.write_dbf_files(_units_rows(spark, sf), "file", ["CODGEO", "TUU2020", "LIBUU2020"], out)
    return read_dbf(spark, out)


@query("geojson_load", _UNITS_SQL, "S7")
def geojson_load(spark, sf):
    out = FF.scratch_dir(spark, "geojson")
    FF.write_json_lists(
        _units_rows(spark, sf), "file", out, ".geojson",
        lambda _k: ('{"type": "FeatureCollection", "features": [', "]}"),
        lambda r: {"type": "Feature", "geometry": None,
                   "properties": {"CODGEO": r["CODGEO"], "TUU2020": int(r["TUU2020"]), "LIBUU2020": r["LIBUU2020"]}},
    )
    return read_geojson(spark, out).select("CODGEO", "TUU2020", "LIBUU2020")


@query(
    "geojson_values",
    f"""SELECT {CODE('p_partkey')} AS code, printf('%.2f', p_retailprice) AS prix, CAST(p_size AS VARCHAR) || 'e' || CAST(p_size % 9 AS VARCHAR) AS exposant,
               CASE WHEN p_partkey % 3 = 0 THEN '{{"k": [' || CAST(p_size AS VARCHAR) || ', {{"b": "' || p_brand || '"}}, 1.50]}}' END AS nested,
               CASE WHEN p_partkey % 3 = 1 THEN '[ ]' END AS liste, CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE 'false' END AS pair
        FROM part WHERE p_partkey % 13 <> 0
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 13 = 0""",
    "S7: numbers and nested values as written, features without properties, lists without features",
)
def geojson_values(spark, sf):
    out = FF.scratch_dir(spark, "geojson-values")
    p = B.table(spark, sf, "part")
    k = F.col("p_partkey")
    nested = F.concat(F.lit('{"k": ['), F.col("p_size").cast("string"), F.lit(', {"b": '), F.to_json(F.array("p_brand")), F.lit("}, 1.50]}"))
    nested = F.regexp_replace(nested, r'\{"b": \[("[^"]*")\]\}', r'{"b": $1}')
    props = F.concat(
        F.lit('{"code": "'), B.code_of(k), F.lit('", "prix": '), F.format_string("%.2f", F.col("p_retailprice").cast("double")),
        F.lit(', "exposant": '), F.col("p_size").cast("string"), F.lit("e"), (F.col("p_size") % 9).cast("string"),
        F.when(k % 3 == 0, F.concat(F.lit(', "nested": '), nested)).when(k % 3 == 1, F.lit(', "liste": [ ]')).otherwise(F.lit(', "nested": null')),
        F.lit(', "pair": '), F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("false")), F.lit("}"),
    )
    rows = p.select(F.floor(k / KEYS_A_FILE).cast("string").alias("file"), k.alias("ord"), F.when(k % 13 == 0, F.lit("null")).otherwise(props).alias("props"))
    FF.write_json_lists(
        rows, "file", out, ".geojson", lambda _k: ('{"type": "FeatureCollection", "name": "x", "features": [', '], "crs": null}'),
        lambda r: '{"type": "Feature", "properties": ' + r["props"] + ', "geometry": {"type": "Point", "coordinates": [1.5, 2]}}',
    )
    # as many files again whose list is empty
    FF.write_text_files(
        rows.select(F.concat(F.lit("empty-"), "file").alias("file")).distinct().select("file", F.lit(0).alias("ord"), F.lit("").alias("line")),
        "file", '{"type": "FeatureCollection", "features": []}', out, ".geojson",
    )
    return read_geojson(spark, out).select("code", "prix", "exposant", "nested", "liste", "pair")


@query(
    "catalog_json_load",
    f"""SELECT CAST(dense_rank() OVER (ORDER BY doc_id // {DOCS_A_FILE}) - 1 AS INTEGER) AS query_pos,
              CAST(row_number() OVER (PARTITION BY doc_id // {DOCS_A_FILE} ORDER BY doc_id) - 1 AS INTEGER) AS item_pos,
              CASE WHEN doc_id % 11 = 0 THEN NULL ELSE source || '-' || lang END AS id, source AS slug,
              'p' || CAST(doc_id AS VARCHAR) AS page, lang || ' ' || CAST(doc_id AS VARCHAR) AS title,
              text AS description, CAST(doc_id % 3 AS INTEGER) AS n_resources
       FROM documents""",
    "S8",
)
def catalog_json_load(spark, sf):
    out = FF.scratch_dir(spark, "catalog")
    d = B.table(spark, sf, "documents")
    k = F.col("doc_id")
    rows = d.select(
        F.lpad(F.floor(k / DOCS_A_FILE).cast("string"), 12, "0").alias("file"), k.alias("ord"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.concat_ws("-", "source", "lang")).alias("id"),
        F.col("source").alias("slug"), F.concat(F.lit("p"), k.cast("string")).alias("page"),
        F.concat_ws(" ", F.col("lang"), k.cast("string")).alias("title"), F.col("text").alias("description"),
        (k % 3).alias("n_res"),
    )

    def item(r):
        def clean(v):
            return None if isinstance(v, float) and v != v else v

        return {
            "id": clean(r["id"]), "slug": clean(r["slug"]), "page": r["page"], "title": r["title"],
            "description": clean(r["description"]),
            "resources": [{"title": f"r{j}", "url": f"https://data.example.org/d/{r['ord']}/{j}.csv"}
                          for j in range(int(r["n_res"]))],
        }

    def envelope(key):
        return ('{"data": [', "]}") if int(key) % 2 == 0 else ('{"data": [], "results": [', "]}")

    FF.write_json_lists(rows, "file", out, ".json", envelope, item)
    return read_catalog(spark, out).select(
        "query_pos", "item_pos", "id", "slug", "page", "title", "description", "n_resources"
    )


@query(
    "dbf_urban_units",
    f"""SELECT CODE AS code, TUU AS tuu, TDUU AS tduu FROM (
          SELECT {CODE('p_partkey')} AS CODE, CAST(p_size % 9 AS VARCHAR) AS TUU, p_brand AS TDUU FROM part)
        WHERE regexp_full_match(CODE, '^[0-9]{{5}}$|^2[AB][0-9]{{3}}$')
        GROUP BY ALL""",
    "S6 + P1 + P4 + A3: urban units read from dBASE files",
)
def dbf_urban_units(spark, sf):
    from refloom.operators import codes

    out = FF.scratch_dir(spark, "dbf-units")
    FF.write_dbf_files(_units_rows(spark, sf), "file", ["CODGEO", "TUU2020", "LIBUU2020"], out)
    return codes.urban_units(read_dbf(spark, out))


# ------------------------------------------------------------------ ragged and unreadable files
def _quoted(c):
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def _ragged_rows(spark, sf):
    """Documents as records: the text quoted, every seventh row short, every fifth with surplus cells."""
    d = B.table(spark, sf, "documents")
    k = F.col("doc_id")
    cells = [k.cast("string"), F.coalesce(F.col("text"), F.lit(""))]
    return d.select(
        F.floor(k / DOCS_A_FILE).cast("string").alias("file"), k.alias("ord"),
        F.when(k % 7 == 0, F.array(*cells)).when(
            k % 5 == 0, F.array(*cells, F.coalesce("lang", F.lit("")), F.lit("more"), F.lit(""), F.col("source"))
        ).otherwise(F.array(*cells, F.coalesce("lang", F.lit("")))).alias("fields"),
    )


@query(
    "ragged_csv_load",
    """SELECT via, CAST(doc_id AS VARCHAR) AS no, nullif(text, '') AS texte,
              CASE WHEN doc_id % 7 <> 0 THEN nullif(lang, '') END AS langue,
              CASE WHEN doc_id % 7 <> 0 AND doc_id % 5 = 0 THEN ['more', '', source] END AS extra
       FROM documents, (VALUES ('file'), ('zip')) v(via)""",
    "S4 S5: quotes, line breaks, short and surplus cells, the same rows through both readers",
)
def ragged_csv_load(spark, sf):
    rows = _ragged_rows(spark, sf)
    header = F.array(F.lit("No."), F.lit("Texte"), F.lit("Langue"))
    boxed = FF.scratch_dir(spark, "ragged-zip")
    FF.write_archives(
        rows.select(F.concat("file", F.lit(".zip")).alias("archive"), F.lit("t.csv").alias("member"), header.alias("header"),
                    F.lit(";").alias("sep"), "ord", "fields"),
        boxed,
    )
    plain = FF.scratch_dir(spark, "ragged-file")
    line = F.array_join(F.transform("fields", _quoted), ";")
    FF.write_text_files(rows.select("file", "ord", line.alias("line")), "file", "\n\nNo.;Texte;Langue\n", plain, ".csv")
    zipped, _ = A.load_archives(spark, boxed)
    cols = [F.col("_no").alias("no"), "texte", "langue", F.col("_extra").alias("extra")]
    return (
        read_tabular(spark, plain + "/*.csv").select(F.lit("file").alias("via"), *cols)
        .unionAll(zipped["t"].select(F.lit("zip").alias("via"), *cols))
    )


_CODECS = (("utf-8", ";", "utf-8"), ("latin-1", ",", "latin-1"), ("utf-16-le", "\t", "utf-16-le"), ("utf-8-sig", "|", "utf-8"))


def _dialect_rows(spark, sf):
    """Customers in files of four encodings and delimiters; names hold accents and the delimiters of the others."""
    c = B.table(spark, sf, "customer")
    k = F.col("c_custkey")
    kind = k % 4

    def pick(at):
        return F.element_at(F.array(*[F.lit(x[at]) for x in _CODECS]), (kind + 1).cast("int"))

    cells = [k.cast("string"), F.concat(F.lit("Été; "), F.col("c_name"), F.lit(", dit | né")), F.coalesce("c_mktsegment", F.lit(""))]
    line = F.concat(cells[0], pick(1), _quoted(cells[1]), pick(1), _quoted(cells[2]))
    head = F.concat(F.lit('"Clé; n°"'), pick(1), F.lit('"Nom, prénom"'), pick(1), F.lit("Marché\n"))
    return c.select(
        F.concat(F.floor(k / KEYS_A_FILE).cast("string"), F.lit("-"), kind.cast("string")).alias("file"), k.alias("ord"),
        line.alias("line"), head.alias("head"), pick(0).alias("codec"),
    )


@query(
    "csv_dialects",
    """SELECT CAST(c_custkey AS VARCHAR) AS cle_n, 'Été; ' || c_name || ', dit | né' AS nom_prenom, nullif(c_mktsegment, '') AS marche
       FROM customer""",
    "S4: encoding, delimiter and quotes found for each file",
)
def csv_dialects(spark, sf):
    out = FF.scratch_dir(spark, "dialects")
    FF.write_text_files(_dialect_rows(spark, sf), "file", None, out, ".csv")
    return read_lenient_csv(spark, out + "/*.csv").drop("_extra")


@query(
    "csv_layouts",
    f"""SELECT encoding, sep, '"' AS quote, count(DISTINCT file) AS n_files FROM (
          SELECT c_custkey // {KEYS_A_FILE} || '-' || c_custkey % 4 AS file, c_custkey % 4 AS k FROM customer)
        JOIN (VALUES (0, 'utf-8', ';'), (1, 'latin-1', ','), (2, 'utf-16-le', chr(9)), (3, 'utf-8', '|')) t(kind, encoding, sep) ON kind = k
        GROUP BY encoding, sep""",
    "S4: what was found of the files",
)
def csv_layouts(spark, sf):
    out = FF.scratch_dir(spark, "layouts")
    FF.write_text_files(_dialect_rows(spark, sf), "file", None, out, ".csv")
    return delimited.csv_layouts(spark, out + "/*.csv").groupBy("encoding", "sep", "quote").agg(F.count("*").alias("n_files"))


@query(
    "csv_rejects",
    f"""WITH d AS (
          SELECT doc_id // {DOCS_A_FILE} AS file, row_number() OVER (PARTITION BY doc_id // {DOCS_A_FILE} ORDER BY doc_id) + 3 AS record,
                 CASE WHEN doc_id % 7 = 0 THEN 2 WHEN doc_id % 5 = 0 THEN 6 ELSE 3 END AS cells, doc_id % 11 = 0 AS broken FROM documents)
        SELECT CAST(file AS VARCHAR) AS file, record, CASE WHEN broken THEN 'invalid bytes' ELSE 'surplus cells' END AS reason,
               CAST(cells AS INTEGER) AS cells, (SELECT count(*) FROM d WHERE NOT broken AND cells <= 3) AS rows_loaded
        FROM d WHERE broken OR cells > 3""",
    "S4: records that a strict load skips, by their number among quoted cells with line breaks; the others load",
)
def csv_rejects(spark, sf):
    out = FF.scratch_dir(spark, "csv-rejects")
    line = F.array_join(F.transform("fields", _quoted), ";")
    line = F.when(F.col("ord") % 11 == 0, F.concat(line, F.lit(FF.BROKEN))).otherwise(line)
    FF.write_text_files(_ragged_rows(spark, sf).select("file", "ord", line.alias("line")), "file", "\n\nNo.;Texte;Langue\n", out, ".csv")
    loaded = read_lenient_csv(spark, out + "/*.csv", skip_rejects=True).agg(F.count(F.lit(1)).alias("rows_loaded"))
    rejects = delimited.csv_rejects(spark, out + "/*.csv")
    return rejects.select(F.regexp_extract("file", r"([0-9]+)\.csv$", 1).alias("file"), "record", "reason", "cells", loaded.scalar().alias("rows_loaded"))


@query(
    "archive_rejects",
    f"""SELECT DISTINCT {_BLOCK('c_custkey', KEYS_AN_ARCHIVE)} || '-clients.zip' AS archive, '' AS member_path,
               CASE {_BLOCK('c_custkey', KEYS_AN_ARCHIVE)} % 3 WHEN 1 THEN 'the archive is an HTML page'
                    ELSE 'BadZipFile: File is not a zip file' END AS reason,
               (SELECT count(*) FROM customer WHERE {_BLOCK('c_custkey', KEYS_AN_ARCHIVE)} % 3 = 0) AS rows_loaded
        FROM customer WHERE {_BLOCK('c_custkey', KEYS_AN_ARCHIVE)} % 3 <> 0""",
    "S2 X2: archives that are pages or torn are named, the others load",
)
def archive_rejects(spark, sf):
    k = F.col("c_custkey")
    rows = B.table(spark, sf, "customer").select(
        F.concat(_block(k, KEYS_AN_ARCHIVE).cast("string"), F.lit("-clients.zip")).alias("archive"), F.lit("clients.csv").alias("member"),
        F.array(F.lit("ID"), F.lit("Nom")).alias("header"), F.lit(";").alias("sep"), k.alias("ord"),
        FF.text_fields(k, F.col("c_name")).alias("fields"),
    )
    out = FF.scratch_dir(spark, "rejects")
    FF.write_archives(rows, out, spoil=True)
    tables, _ = A.load_archives(spark, out, strict=False)
    loaded = tables["clients"].agg(F.count(F.lit(1)).alias("rows_loaded"))
    rejects = A.archive_rejects(A.list_members(A.archive_index(spark, out)))
    return rejects.select("*", loaded.scalar().alias("rows_loaded"))


def _from_boxes(spark, rows, name, names, kind="csv"):
    """Write a table into nested archives, choose each archive's table, and read it."""
    out = FF.scratch_dir(spark, f"boxed-{name}")
    FF.write_boxed(rows, name, names, out, kind)
    members = A.list_members(A.archive_index(spark, out), descend=True)
    # the choice and the rows are used several times: each is made once
    return cut_lineage(A.read_chosen(cut_lineage(A.first_tabular_member(members))))


@query(
    "code_mapping_from_archives",
    with_views(("event_map",), f"SELECT {MAP_COLS} FROM event_map WHERE {METRO}"),
    "S1 S2 S3 S7 S10 P1 X1: the mapping from files, CSV, GeoJSON and dBASE tables in zips inside zips",
)
def code_mapping_from_archives(spark, sf):
    from refloom.operators import codes

    def numbered(df):
        # any split of the rows over files gives the same table; files grow in number with the rows
        files = max(2, df.count() // KEYS_A_FILE)
        part = F.pmod(F.xxhash64(*df.columns), F.lit(files))
        return df.select(part.cast("string").alias("file"), F.lit(0).alias("ord"), *df.columns)

    cog, history = B.cog_raw(spark, sf), B.history_raw(spark, sf)
    units = B.uu_raw(spark, sf).toDF("CODGEO", "TUU2020", "TDUU2020")
    return codes.code_mapping(
        _from_boxes(spark, numbered(cog), "liste", cog.columns),
        _from_boxes(spark, numbered(units), "unites", units.columns, "geojson"),
        _from_boxes(spark, numbered(history), "mouvements", history.columns, "dbf"),
        2025,
        metro_only=True,
    )
