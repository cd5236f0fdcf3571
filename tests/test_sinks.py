"""Create or replace (K1): a job that fails leaves the old table, one that succeeds takes its place."""

import os

import pytest
from pyspark.sql import functions as F

from refloom.operators.sinks import write_table


def _failing(spark):
    return spark.range(100).select((F.col("id") / F.when(F.col("id") == 99, F.raise_error(F.lit("torn"))).otherwise(1)).alias("v"))


def test_a_failed_write_leaves_the_old_folder(spark, tmp_path):
    where = write_table(spark.range(3), "t", path=str(tmp_path))
    with pytest.raises(Exception, match="torn"):
        write_table(_failing(spark), "t", path=str(tmp_path))
    assert spark.read.parquet(where).count() == 3 and os.listdir(tmp_path) == ["t"]
    assert write_table(spark.read.parquet(where).limit(2), "t", path=str(tmp_path)) == where  # read from what it replaces
    assert spark.read.parquet(where).count() == 2 and os.listdir(tmp_path) == ["t"]


def test_a_failed_write_leaves_the_old_table(spark):
    where = write_table(spark.range(4), "kept_table", schema="sinks_test")
    with pytest.raises(Exception, match="torn"):
        write_table(_failing(spark), "kept_table", schema="sinks_test")
    assert spark.table(where).count() == 4
    write_table(spark.range(5), "kept_table", schema="sinks_test", bucket_by="id", buckets=4)
    assert spark.table(where).count() == 5
    assert [r.tableName for r in spark.sql("SHOW TABLES IN sinks_test").collect()] == ["kept_table"]
    write_table(spark.range(1), "kept_table", schema="sinks_test", mode="append", bucket_by="id", buckets=4)
    assert spark.table(where).count() == 6
    spark.sql("DROP SCHEMA sinks_test CASCADE")


def test_build_from_sources_says_what_it_made_of_what(spark, tmp_path):
    from refloom.operators.quality import RowCountError
    from refloom.operators.sinks import Source, build_from_sources
    from refloom.sources.delimited import read_lenient_csv

    files = {
        "codes": "TYPECOM;COM;COMPARENT\nCOM;01001;\nCOM;01002;\nCOMD;01003;01001\n", "units": "CODGEO;TUU2020;TDUU2020\n01001;5;51\n",
        "history": "COM_AV;COM_AP\n01009;01002\n",
    }
    sources = {}
    for k, text in files.items():
        (tmp_path / f"{k}.csv").write_text(text)
        sources[k] = Source(2025, f"https://files.example.org/{k}.csv", f"{tmp_path}/{k}.csv")
    made = build_from_sources(spark, sources, 2025, read_lenient_csv, path=str(tmp_path), expected_rows=5, tolerance=2)
    stored = spark.read.parquet(made.table_name)
    assert made.row_count == stored.count() and made.table_name.endswith("cog_tuu_tduu_2025")
    assert made.codes.url.endswith("codes.csv") and made.history.year == 2025
    row = made.as_row(spark).first()
    assert row.units.path == sources["units"].path and row.row_count == made.row_count
    bare = build_from_sources(spark, {k: v for k, v in sources.items() if k != "history"}, 2024, read_lenient_csv, path=str(tmp_path))
    assert bare.history is None and bare.row_count < made.row_count + 1 and bare.as_row(spark).first().history is None
    with pytest.raises(RowCountError):
        build_from_sources(spark, sources, 2025, read_lenient_csv, path=str(tmp_path), expected_rows=400)
    assert spark.read.parquet(made.table_name).count() == made.row_count
