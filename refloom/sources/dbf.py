"""dBASE attribute-table scan.

The urban-unit base arrives as a shapefile whose attributes live in a ``.dbf``:
fixed-width records after a header. Tasks read the headers; record ranges of a fixed
number are rows that are dealt to tasks, each seeking to its slice.
Every field is returned as trimmed text (codes keep their leading zeros); deleted
records are skipped. The text encoding comes from the ``encoding`` option, else
each file's ``.cpg`` sidecar, else UTF-8. A directory is read file by file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.session import cut_lineage, ship_package

RECORDS_PER_PARTITION = 200_000


def _open(path: str):
    from refloom.sources.archives import open_path

    return open_path(path)


def parse_header(fh) -> tuple[int, int, int, list[tuple[str, str, int]]]:
    """(n_records, header_len, record_len, [(name, type, width)]) of an open file."""
    head = fh.read(32)
    n_records, header_len, record_len = struct.unpack("<IHH", head[4:12])
    desc = fh.read(header_len - 32)
    fields = []
    for off in range(0, len(desc), 32):
        chunk = desc[off : off + 32]
        if chunk[:1] == b"\x0d" or len(chunk) < 32:
            break
        name = chunk[:11].split(b"\x00", 1)[0].decode("ascii", errors="replace").strip()
        fields.append((name, chr(chunk[11]), chunk[16]))
    return n_records, header_len, record_len, fields


def _text_column(cells: np.ndarray, encoding: str) -> pa.Array:
    """A fixed-width field of many records (one row of bytes each) as trimmed text."""
    n, width = cells.shape
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, pa.py_buffer(np.ascontiguousarray(cells))])
    if encoding.lower().replace("-", "") in ("utf8", "ascii"):
        try:
            return pc.utf8_trim_whitespace(fixed.cast(pa.binary()).cast(pa.string()))
        except pa.ArrowInvalid:  # bytes that are no UTF-8: decoded with replacement below
            pass
    return pa.array([v.decode(encoding, errors="replace").strip() for v in fixed.to_pylist()], pa.string())


def record_batches(fh, record_len: int, fields: list[tuple[str, str, int]], remaining: int, encoding: str, block: int = 8192):
    """Arrow batches of up to ``remaining`` records from the current place; deleted ones are left out."""
    names = [n for n, _, _ in fields]
    ends = np.cumsum([1, *(w for _, _, w in fields)])
    while remaining > 0:
        data = fh.read(min(block, remaining) * record_len)
        got = len(data) // record_len
        if not got:
            break
        table = np.frombuffer(data, np.uint8, got * record_len).reshape(got, record_len)
        table = table[table[:, 0] != ord("*")]
        if len(table):
            columns = [_text_column(table[:, a:b], encoding) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        remaining -= got


def sidecar_encoding(path: str) -> str | None:
    base = path[:-4] if path.lower().endswith(".dbf") else path
    for ext in (".cpg", ".CPG"):
        try:
            with _open(base + ext) as fh:
                enc = fh.read(64).decode("ascii", errors="ignore").strip()
                if enc:
                    return {"utf8": "utf-8"}.get(enc.lower().replace("-", ""), enc)
        except OSError:
            continue
    return None


_LAYOUT = pa.schema([
    ("path", pa.string()), ("names", pa.list_(pa.string())), ("widths", pa.list_(pa.int32())), ("records", pa.int64()),
    ("header_len", pa.int32()), ("record_len", pa.int32()), ("encoding", pa.string()),
])
_LAYOUT_DDL = "path string, names array<string>, widths array<int>, records long, header_len int, record_len int, encoding string"


def _layouts(batches: Iterator[pa.RecordBatch], encoding: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path in batch.column(0).to_pylist():
            with _open(path) as fh:
                n, header_len, record_len, fields = parse_header(fh)
            names, widths = [f for f, _, _ in fields], [w for _, _, w in fields]
            rows.append((path, names, widths, n, header_len, record_len, encoding or sidecar_encoding(path) or "utf-8"))
        yield pa.RecordBatch.from_pylist([dict(zip(_LAYOUT.names, r, strict=True)) for r in rows], schema=_LAYOUT)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow record batches, one per block of records (no per-row conversion)."""
    for batch in batches:
        for r in batch.to_pylist():
            fields = [(n, "C", w) for n, w in zip(r["names"], r["widths"], strict=True)]
            with _open(r["path"]) as fh:
                fh.seek(r["header_len"] + r["start"] * r["record_len"])
                yield from record_batches(fh, r["record_len"], fields, min(RECORDS_PER_PARTITION, r["records"] - r["start"]), r["encoding"])


def read_dbf(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """The records of a ``.dbf`` file, or of every ``.dbf`` file of a directory; all share the first file's fields.

    Headers are read in tasks; one row per distinct list of fields reaches the driver.
    """
    ship_package(spark)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.[dD][bB][fF]").load(path).select("path")
    tasks = max(1, spark.sparkContext.defaultParallelism * 2)
    layouts = cut_lineage(listing.repartition(tasks, "path").mapInArrow(lambda it: _layouts(it, encoding), _LAYOUT_DDL))
    kinds = layouts.groupBy("names").agg(F.min("path").alias("first"), F.count("*").alias("files")).orderBy("first").take(4)
    if not kinds:
        raise ValueError(f"no dBASE file in {path}")
    if len(kinds) > 1:  # one schema for all: a file with other fields would be mislabelled
        raise ValueError(f"dBASE files have other fields than {kinds[0]['first']}: {[k['first'] for k in kinds[1:]]}")
    last = F.greatest(F.lit(0).cast("long"), F.col("records") - 1)
    ranges = layouts.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(RECORDS_PER_PARTITION).cast("long"))))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in kinds[0]["names"])
    return ranges.repartition(tasks, "path", "start").mapInArrow(_records, schema)
