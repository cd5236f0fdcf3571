"""GeoJSON attribute scan (S7): the ``properties`` of every feature, as text.

A file is read as a stream: features are cut out of the ``features`` list one by one, so
a task holds one feature and one block of the file, whatever the file's size. Geometries
are skipped, not parsed. Values are kept as written: numbers with their digits, nested
values as their JSON text; strings are unescaped, ``null`` is NULL.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.operators.schema import free_name
from refloom.session import ship_package
from refloom.sources import jsonstream


def features(raw) -> Iterator[dict[str, str | None]]:
    """The properties of each feature of an open GeoJSON file (none: an empty dictionary)."""
    for listed, found in jsonstream.list_objects(raw, ["features"]):
        of = dict(jsonstream.members(found))
        if listed or of.get("type") == '"Feature"':  # a root that is a feature itself counts as one
            held = of.get("properties", "null")
            yield {k: jsonstream.as_text(v) for k, v in jsonstream.members(held)} if held[0] == "{" else {}


def property_names(raw) -> list[str]:
    """Names of all properties, in order of first appearance."""
    return list(dict.fromkeys(k for f in features(raw) for k in f))


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from refloom.sources.archives import open_path

    for batch in batches:
        for path in batch.column(0).to_pylist():
            with open_path(path) as raw:
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([property_names(raw)], pa.list_(pa.string()))], names=["path", "names"])


def _rows(batches: Iterator[pa.RecordBatch], keys: list[str], names: list[str], block: int = 4096) -> Iterator[pa.RecordBatch]:
    from refloom.sources.archives import open_path

    for batch in batches:
        for path in batch.column(0).to_pylist():
            with open_path(path) as raw:
                found = features(raw)
                while rows := list(itertools.islice(found, block)):
                    yield pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], pa.string()) for k in keys], names=names)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature, one text column per property, in order of first appearance over the
    files in path order. Names that differ in case alone are told apart by underscores.

    Files are spread over tasks and read twice (names, then rows). Files without features
    give no rows; without any property the frame has no columns and no rows.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("path")
    files = files.repartition(max(1, spark.sparkContext.defaultParallelism * 2), "path")
    # one row per distinct list of names: metadata, however many files there are
    known = files.mapInArrow(_names, "path string, names array<string>").groupBy("names").agg(F.min("path").alias("first")).orderBy("first", "names").collect()
    keys = list(dict.fromkeys(k for r in known for k in r["names"]))
    names: list[str] = []
    for k in keys:
        names.append(free_name(k, names))
    if not keys:
        return spark.createDataFrame([], "struct<>")
    rows = files.mapInArrow(lambda it: _rows(it, keys, names), ", ".join(f"`{n.replace('`', '``')}` string" for n in names))
    return rows.hint("rebalance")
