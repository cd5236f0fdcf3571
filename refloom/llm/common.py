"""Helpers shared by the operators: table reading, free column names, text to columns."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a maximal run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

_ARROW = {
    T.LongType: pa.int64(),
    T.IntegerType: pa.int32(),
    T.DoubleType: pa.float64(),
    T.StringType: pa.string(),
    T.BooleanType: pa.bool_(),
    T.BinaryType: pa.binary(),
}

#: Rows handled at once in a task; bounds the Python objects alive, not what is processed.
SLICE_ROWS = 500


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def row_key(df: DataFrame, prefix: str = "") -> Column:
    """A digest of all columns of a row (``prefix``: ``alias.`` in a join): rows with the same one are copies of each other."""
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.md5(F.to_json(F.struct(*[F.col(f"{prefix}`{c}`").alias(c) for c in df.columns]), exact))


#: Rows that a join may broadcast (of a key and a few numbers each: some 30 MB); more are joined by shuffle.
BROADCAST_ROWS = 400_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df``, which should be cheap to count, has at most ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows


#: Bytes of texts that go to a Python worker at once. Spark's own bound of 64 MB is held by the JVM, outside its
#: heap, and by the worker, each time with what comes back, for every task.
_BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's bound on Arrow batches to ``BATCH_BYTES`` where it is not set; a bound that is set stays."""
    if spark.conf.get(_BATCH_KEY, BATCH_BYTES) == BATCH_BYTES:
        spark.conf.set(_BATCH_KEY, BATCH_BYTES)


_KEPT: dict[Any, Any] = {}


def kept(owner: Any, make: Callable[[], Any]) -> Any:
    """What an operator keeps in a worker process between its tasks; what another one kept there goes."""
    if owner not in _KEPT:
        forget()
        _KEPT[owner] = make()
    return _KEPT[owner]


def forget() -> None:
    """Gives back what earlier operators kept in this worker process."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, arrow_type(f.dataType)) for f in kind])
    return _ARROW[type(kind)]


def add_from_text(
    df: DataFrame,
    text_col: str,
    ddl: str,
    make: Callable[[], Callable[[list[str]], dict[str, Iterable]]],
) -> DataFrame:
    """``df`` plus the columns of ``ddl``, computed in tasks from whole texts (null: empty).

    ``make`` runs once a task and returns a function from a list of texts to one
    sequence per new column. All columns of ``df`` pass through untouched, so the
    operator needs no shuffle and no join to bring its result back to its row.
    """
    new = T._parse_datatype_string(ddl)
    schema = T.StructType([*df.schema.fields, *new.fields])
    kinds = [(f.name, arrow_type(f.dataType)) for f in new]
    at = df.columns.index(text_col)
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                out = work([t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(out[n], type=k) for n, k in kinds)],
                    names=[*part.schema.names, *(n for n, _ in kinds)],
                )
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
