"""Sinks (K1, K2) and the end-to-end X1 build with its row-count control (K4).

Writes go through the DataFrame writer, so they are parallel and atomic per job
commit; the row-count control runs *before* the write, so a failed check leaves no
table behind (the reference stored first and checked after).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from refloom.operators import codes, quality
from refloom.operators.history import empty_history


def _swap_folder(spark: SparkSession, made: str, target: str) -> None:
    """``made`` takes the place of ``target``; the old folder is set aside first and goes last."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, old, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (made, target, f"{made}-old"))
    fs = old.getFileSystem(conf)
    replaced = fs.exists(old)
    if replaced and not fs.rename(old, aside):
        raise OSError(f"{target} cannot be set aside")
    if not fs.rename(new, old):
        if replaced:
            fs.rename(aside, old)
        raise OSError(f"{target} cannot be replaced")
    if replaced:
        fs.delete(aside, True)


def write_table(df: DataFrame, name: str, schema: str | None = None, path: str | None = None,
                partition_by: str | None = None, mode: str = "overwrite",
                bucket_by: str | None = None, buckets: int = 64) -> str:
    """K1: create-or-replace a table (``schema.name`` in the catalog, created when
    absent) or a parquet directory when ``path`` is given. Returns where it went.

    A replacement is written beside the old table under a name of its own and takes its
    place when it is complete, so a job that fails leaves the old table as it was (and
    nothing else); the new rows may be read from the old table. Other modes write in place.

    ``bucket_by`` (catalog tables only) stores the rows hashed into ``buckets`` by a
    key, e.g. a code list by ``code``: later joins on that key with a table bucketed
    the same way need no shuffle on either side.
    """
    staged = mode == "overwrite"
    spark = df.sparkSession
    writer = df.write.mode("error" if staged else mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        if path is not None:
            raise ValueError("bucketing needs a catalog table (path writes cannot be bucketed)")
        writer = writer.bucketBy(int(buckets), bucket_by).sortBy(bucket_by)
    made = f"{name}__new_{uuid.uuid4().hex[:12]}" if staged else name
    if path is not None:
        folder = path.rstrip("/")
        try:
            writer.parquet(f"{folder}/{made}")
        except BaseException:
            if staged:
                left = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{made}")
                left.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(left, True)
            raise
        if staged:
            _swap_folder(spark, f"{folder}/{made}", f"{folder}/{name}")
        return f"{folder}/{name}"
    in_schema = f"`{schema}`." if schema else ""
    if schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    try:
        writer.format("parquet").saveAsTable(f"{in_schema}`{made}`")
    except BaseException:
        if staged:
            spark.sql(f"DROP TABLE IF EXISTS {in_schema}`{made}`")
        raise
    if staged:
        spark.sql(f"DROP TABLE IF EXISTS {in_schema}`{name}`")
        spark.sql(f"ALTER TABLE {in_schema}`{made}` RENAME TO {in_schema}`{name}`")
    return f"{in_schema}`{name}`" if schema else name


class Source(NamedTuple):
    """Where one of a build's three inputs came from: its year, its address, its file."""

    year: int
    url: str
    path: str


class BuildResult(NamedTuple):
    """What a build made, and of what."""

    table_name: str
    row_count: int
    codes: Source | None
    units: Source | None
    history: Source | None

    def as_row(self, spark: SparkSession) -> DataFrame:
        """The result as one row, to be stored beside the table."""
        source = "struct<year:int,url:string,path:string>"
        return spark.createDataFrame([tuple(self)], f"table_name string, row_count long, codes {source}, units {source}, history {source}")


def build_from_sources(
    spark: SparkSession,
    sources: dict[str, Source],
    target_year: int,
    read: Callable[[SparkSession, str], DataFrame],
    **options,
) -> BuildResult:
    """X1 from chosen files (``codes``, ``units``, ``history``): each is opened by ``read``, the mapping is built,
    checked and written (``build_mapping_table``), and its table, rows and sources are returned. Without a history
    file the build takes the empty history (S9)."""
    frames = {k: read(spark, sources[k].path) for k in ("codes", "units")}
    history = read(spark, sources["history"].path) if "history" in sources else empty_history(spark)
    where, n = build_mapping_table(spark, frames["codes"], frames["units"], history, target_year, **options)
    return BuildResult(where, n, sources["codes"], sources["units"], sources.get("history"))


def build_mapping_table(
    spark: SparkSession,
    codes_raw: DataFrame,
    units_raw: DataFrame,
    history_raw: DataFrame,
    target_year: int,
    metro_only: bool = True,
    expected_rows: int | None = None,
    tolerance: int = 0,
    schema: str | None = "insee",
    path: str | None = None,
) -> tuple[str, int]:
    """X1 + K4 + K1 + K2: build ``cog_tuu_tduu_<year>``, check its row count, write it.

    The mapping is checkpointed to the reliable checkpoint directory once, so the
    count and the write read the same materialized rows.
    """
    from refloom.session import cut_lineage

    mapping = cut_lineage(codes.code_mapping(codes_raw, units_raw, history_raw, target_year, metro_only=metro_only))
    n = quality.row_count_control(mapping, expected_rows, tolerance)
    where = write_table(mapping, codes.mapping_table_name(target_year), schema=schema, path=path)
    return where, n
