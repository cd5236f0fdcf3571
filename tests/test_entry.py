"""Driver contract: entry runs, every query of the library has SQL, and returns as many rows as that."""

import duckdb
import pytest

import __spark_entry__ as E
from refloom.plans import load_all

SMOKE = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Queries that have no rows on so small a table.
EMPTY = set()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["cog_initial", "cog_reference", "tuu", "tduu", "cog_year", "target_year"]
    assert df.count() == 313


def test_registered_names():
    own = set(load_all())
    assert own <= set(E.queries()) and own <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(load_all()))
def test_query_returns_the_oracles_rows(spark, tables, name):
    df = E.queries()[name](spark, SMOKE)
    wanted = tables.execute(f"SELECT count(*) FROM ({E.oracle_sql()[name]})").fetchone()[0]
    assert df.count() == wanted
    assert wanted > 0 or name in EMPTY
    assert len(set(df.columns)) == len(df.columns)


def _clients(spark, folder, n_customers, n_suppliers):
    """Customers and suppliers with keys from 0 on."""
    spark.range(n_customers).selectExpr(
        "id c_custkey", "concat('c', id) c_name", "'BUILDING' c_mktsegment", "CAST(id AS DOUBLE) c_acctbal"
    ).write.parquet(f"{folder}/customer.parquet")
    spark.range(n_suppliers).selectExpr("id s_suppkey", "concat('s', id) s_name", "id % 5 s_nationkey").write.parquet(
        f"{folder}/supplier.parquet"
    )
    return str(folder)


def test_manifest_counts_two_archives_for_each_250_keys(spark, tmp_path):
    rows = E.queries()["archive_manifest"](spark, _clients(spark, tmp_path, 1_501, 600)).collect()
    # the 1,501st customer has an archive of its own
    assert sorted(map(tuple, rows)) == [("exports_clients", 13, 13), ("exports_fournisseurs", 6, 6)]


def test_rejects_name_two_of_three_archives_of_each_250_keys(spark, tmp_path):
    rows = E.queries()["archive_rejects"](spark, _clients(spark, tmp_path, 1_501, 1)).collect()
    # archives 0 to 11 hold 125 customers each, archive 12 holds the last one
    page, torn = "the archive is an HTML page", "BadZipFile: File is not a zip file"
    assert sorted(map(tuple, rows)) == sorted(
        (f"{n}-clients.zip", "", page if n % 3 == 1 else torn, 4 * 125 + 1) for n in range(13) if n % 3
    )
