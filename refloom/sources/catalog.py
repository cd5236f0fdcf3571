"""Catalog JSON scan (S8): search responses -> one row per dataset record.

Each response file holds ``data`` or else ``results`` (an empty list falls
through). ``query_pos`` is the response's rank in path order, ``item_pos`` the
record's position in its list.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.operators.order import ordered_places
from refloom.session import ship_package
from refloom.sources import jsonstream
from refloom.sources.archives import open_path

#: Records handed on at once.
BATCH_RECORDS = 256

RESOURCE = (
    "struct<id:string,title:string,description:string,type:string,format:string,mime:string,url:string,latest:string>"
)
DATASET = f"struct<id:string,slug:string,page:string,title:string,description:string,resources:array<{RESOURCE}>>"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each response, one by one, as JSON text: of ``data``, or of ``results`` where that is empty."""
    for batch in batches:
        for place, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with open_path(path) as raw:
                lists = {name for name, _ in jsonstream.list_objects(raw, ["data"]) if name}
            wanted = "data" if lists else "results"
            with open_path(path) as raw:
                found = (text for name, text in jsonstream.list_objects(raw, [wanted]) if name)
                for first in itertools.count(step=BATCH_RECORDS):
                    if not (texts := list(itertools.islice(found, BATCH_RECORDS))):
                        break
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([place] * len(texts), pa.int64()), pa.array(range(first, first + len(texts)), pa.int32()), pa.array(texts, pa.string())],
                        names=["query_pos", "item_pos", "json"],
                    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row per dataset record. Responses are read as streams, so a task holds few records of one, whatever
    its size. Files are ranked by ranges of their names (``ordered_places``): no task sees them all."""
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"))
    ranked = ordered_places(files, [F.col("file")], "place").select((F.col("place") - 1).alias("query_pos"), "file")
    tasks = max(1, spark.sparkContext.defaultParallelism * 2)
    rows = ranked.repartition(tasks, "file").mapInArrow(_records, "query_pos long, item_pos int, json string")
    d = rows.select(F.col("query_pos").cast("int").alias("query_pos"), "item_pos", F.from_json("json", DATASET).alias("d"))
    return d.select(
        "query_pos", "item_pos", "d.id", "d.slug", "d.page", "d.title", "d.description",
        F.greatest(F.coalesce(F.size("d.resources"), F.lit(0)), F.lit(0)).alias("n_resources"), "d.resources",
    )


def explode_resources(datasets: DataFrame, key: str = "dataset_key") -> DataFrame:
    """Resources of the chosen dataset(s), with their input position."""
    return datasets.select(key, F.posexplode("resources").alias("pos", "r")).select(key, "pos", "r.*")
