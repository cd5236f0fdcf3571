"""Delimited-text scan (S4, S10, P3): header on, every column as text, empty cells NULL,
short rows padded with NULL, surplus cells in ``_extra``, column names normalized.

Files are read in byte ranges of bounded size, whatever their cells hold. A first job
reads each range and says, for a start inside and for a start outside a quoted cell,
how many records end in it and how it ends. Running those answers along a file (a prefix
XOR: a range keeps, flips or sets the state) gives every range its true start and the
number of its first record. The second job parses the records that begin in each range.
Encoding, delimiter and quote are found for each file (``dialect``).
"""

from __future__ import annotations

import itertools
import posixpath
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refloom.operators.schema import free_name, normalize_headers
from refloom.session import cut_lineage, ship_package
from refloom.sources import dialect as D
from refloom.sources.archives import TABULAR_SUFFIXES, columns_of, open_path

#: Bytes that one task reads and holds at once in the first job, and parses in the second.
RANGE_BYTES = 32 << 20
#: Records handed on at once.
BATCH_RECORDS = 8192

SURPLUS, BROKEN, UNCLOSED = "surplus cells", "invalid bytes", "quote not closed"


class UnsupportedFormat(ValueError):
    pass


def _aligned(fh, at: int, mark: int, codec: str) -> int:
    """Where the first line that starts at ``at`` or later does."""
    if at <= mark:
        return mark
    wide = codec.startswith("utf-16")
    at -= (at - mark) % 2 if wide else 0
    fh.seek(at - (2 if wide else 1))
    return fh.tell() + next((n for n, _, _ in D.lines(fh, codec)), 0)


_DIALECT = "sep string, quote string, codec string, mark int"


def _dialects(batches: Iterator[pa.RecordBatch], sep: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            with open_path(path) as raw:
                head = raw.read(D.SAMPLE_BYTES)
            found.append(D.detect(head, len(head) < D.SAMPLE_BYTES, sep))
        cols = [pa.array([d.sep for d in found], pa.string()), pa.array([d.quote for d in found], pa.string()),
                pa.array([d.codec for d in found], pa.string()), pa.array([d.mark for d in found], pa.int32())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, "sep", "quote", "codec", "mark"])


def _first_record(raw, mark: int, codec: str, sep: str, quote: str) -> tuple[list[str], int]:
    """The first record that is not blank, and its number (0: none)."""
    raw.seek(mark)
    texts = (p for _, line, _ in D.lines(raw, codec) for p in D.pieces(line))
    return next(((r, k) for k, r in enumerate(D.reader(texts, sep, quote), 1) if r), ([], 0))


_SCANNED = [
    ("start", "long", pa.int64()), ("end", "long", pa.int64()), ("n0", "long", pa.int64()), ("n1", "long", pa.int64()),
    ("f0", "int", pa.int32()), ("f1", "int", pa.int32()), ("wide", "long", pa.int64()), ("broken", "long", pa.int64()),
    ("header", "array<string>", pa.list_(pa.string())), ("header_latin", "array<string>", pa.list_(pa.string())),
    ("header_record", "long", pa.int64()),
]


def _scan_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            sep, quote, codec, mark = row["sep"], row["quote"], row["codec"], row["mark"]
            with open_path(row["path"]) as raw:
                fh = D.buffered(raw)
                start = _aligned(fh, row["nominal"], mark, codec)
                end = row["length"] if row["nominal"] + row["step"] >= row["length"] else _aligned(fh, row["nominal"] + row["step"], mark, codec)
                fh.seek(start)
                data = fh.read(max(0, end - start))
                if codec == "utf-8":
                    wide, broken = D.characters(data)
                else:
                    data, wide, broken = data.decode(codec, "replace").encode("utf-8"), 1, 0
                (n0, f0), (n1, f1) = (D.scan(data, sep, quote, inside) for inside in (False, True))
                header, header_latin, number = None, None, None
                if row["nominal"] == 0:
                    header, number = _first_record(fh, mark, codec, sep, quote)
                    header_latin = _first_record(fh, mark, "latin-1", sep, quote)[0] if codec == "utf-8" else header
            new = [start, end, n0, n1, int(f0), int(f1), wide, broken, header, header_latin, number]
            out = row | {n: v for (n, _, _), v in zip(_SCANNED, new, strict=True)}
            yield pa.RecordBatch.from_pylist([out], schema=pa.schema([*batch.schema, *((n, k) for n, _, k in _SCANNED)]))


def file_ranges(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """``ranges_of`` the files under ``path``."""
    return ranges_of(spark.read.format("binaryFile").load(path).select("path", "length"), sep)


def ranges_of(listing: DataFrame, sep: str | None = None) -> DataFrame:
    """One row a range of each file of a listing (path, length): its dialect, header, bytes, whether it starts
    (``state``) and ends (``end_state``) inside a quoted cell, and the records that end before it (``before``)."""
    spark = listing.sparkSession
    ship_package(spark)
    tasks = spark.sparkContext.defaultParallelism * 2
    known = listing.repartition(tasks).mapInArrow(lambda it: _dialects(it, sep), f"path string, length long, {_DIALECT}")
    step = F.lit(RANGE_BYTES).cast("long")
    last = F.greatest(F.lit(0).cast("long"), F.col("length") - 1)
    ranges = known.withColumn("step", step).withColumn("nominal", F.explode(F.sequence(F.lit(0).cast("long"), last, step)))
    ranges = ranges.repartition(max(tasks, 1), "path", "nominal")
    schema = ", ".join(f"{n} {k}" for n, k in [*ranges.dtypes, *((n, k) for n, k, _ in _SCANNED)])
    seen = cut_lineage(ranges.mapInArrow(_scan_ranges, schema))
    # keep: (0, 1), flip: (1, 0), set: both the same
    file = Window.partitionBy("path")
    here = Window.partitionBy("path").orderBy("nominal")
    to_here, earlier = here.rowsBetween(Window.unboundedPreceding, 0), here.rowsBetween(Window.unboundedPreceding, -1)
    flip, fixed = (F.col("f0") == 1) & (F.col("f1") == 0), F.col("f0") == F.col("f1")
    seen = seen.withColumn("flips", F.sum(flip.cast("long")).over(to_here))
    seen = seen.withColumn("set_to", F.last(F.when(fixed, F.struct(F.col("f0").alias("v"), F.col("flips").alias("at"))), ignorenulls=True).over(earlier))
    flips_since = F.col("flips") - flip.cast("long") - F.coalesce("set_to.at", F.lit(0))
    seen = seen.withColumn("state", ((F.coalesce("set_to.v", F.lit(0)) + flips_since) % 2).cast("int"))
    inside = F.col("state") == 1
    latin = (F.col("codec") == "utf-8") & (F.sum("broken").over(file) > 0) & (F.sum("wide").over(file) == 0)
    seen = seen.withColumns({
        "end_state": F.when(inside, F.col("f1")).otherwise(F.col("f0")),
        "before": F.coalesce(F.sum(F.when(inside, F.col("n1")).otherwise(F.col("n0"))).over(earlier), F.lit(0)),
        "codec": F.when(latin, "latin-1").otherwise(F.col("codec")),
    })
    header = F.when(F.col("codec") == "latin-1", F.col("header_latin")).otherwise(F.col("header"))
    return cut_lineage(seen.select(
        "path", "length", "sep", "quote", "codec", "mark", "start", "end", "state", "end_state", "before",
        F.first(header, ignorenulls=True).over(file).alias("header"),
        F.first("header_record", ignorenulls=True).over(file).alias("header_record"),
    ))


def csv_layouts(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """``path, encoding, sep, quote, header`` of each file."""
    ranges = file_ranges(spark, path, sep)
    return ranges.where(F.col("before") == 0).groupBy("path", F.col("codec").alias("encoding"), "sep", "quote", "header").agg(F.lit(0)).select(
        "path", "encoding", "sep", "quote", "header"
    )


def _records(row: dict) -> Iterator[tuple[int, list[str], str | None]]:
    """(number, cells, what is wrong) of the records that begin in a range; the header and blank ones are left out."""
    sep, quote, codec = row["sep"], row["quote"], row["codec"]
    with open_path(row["path"]) as raw:
        fh = D.buffered(raw)
        at, number, broken = row["start"], row["before"], False
        fh.seek(at)
        source = D.lines(fh, codec)
        if row["state"]:  # the rest of a record that began earlier
            inside = True
            for n, line, _ in source:
                at += n
                ended, inside = D.scan(line.encode("utf-8", "replace"), sep, quote, inside)
                if ended and not inside:
                    break
            number += 1

        def texts() -> Iterator[str]:
            nonlocal at, broken
            for n, line, bad in source:
                parts = D.pieces(line)
                for k, part in enumerate(parts):
                    broken |= bad
                    if k == len(parts) - 1:
                        at += n  # known before the record that this line ends is handed on
                    yield part

        rows = D.reader(texts(), sep, quote)
        while at < row["end"] and (cells := next(rows, None)) is not None:
            number += 1
            reason = BROKEN if broken else None
            broken = False
            if at >= row["length"] and row["end_state"] and row["end"] >= row["length"]:
                reason = UNCLOSED
            if cells and number > row["header_record"]:
                yield number, cells, reason or (SURPLUS if len(cells) > len(row["header"]) else None)


def _parse_ranges(batches: Iterator[pa.RecordBatch], columns: Sequence[str], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    place = {c: i for i, c in enumerate(columns)}
    for batch in batches:
        for row in batch.to_pylist():
            header = normalize_headers(row["header"] or [])
            records = _records(row)
            while block := list(itertools.islice(records, BATCH_RECORDS)):
                cells = columns_of([r for _, r, _ in block], [place[h] for h in header], len(columns), len(header))
                yield pa.RecordBatch.from_arrays(
                    [*cells, pa.array([row["path"]] * len(block), pa.string()), pa.array([n for n, _, _ in block], pa.int64()),
                     pa.array([w for _, _, w in block], pa.string()), pa.array([len(r) for _, r, _ in block], pa.int32())],
                    names=names,
                )


def read_records(spark: SparkSession, path: str, sep: str | None = None) -> tuple[DataFrame, list[str], dict[str, str]]:
    """Every record of the files, their columns, and the names of the further columns: surplus cells
    (``_extra``), ``file``, ``record`` (its number, the header's being the first that is not blank),
    ``reason`` and ``cells``; a further name that a file has taken is lengthened."""
    ranges = file_ranges(spark, path, sep)
    # one row per distinct header: metadata, however many files there are
    layouts = ranges.where(F.size("header") > 0).groupBy("header").agg(F.min("path").alias("first")).orderBy("first", "header").collect()
    columns = list(dict.fromkeys(n for r in layouts for n in normalize_headers(r["header"])))
    rows, further = records_of(ranges, columns)
    return rows, columns, further


def records_of(ranges: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """The records of ``ranges_of`` some files under ``columns``, and the names of the further columns."""
    spark = ranges.sparkSession
    further = {n: free_name(n, columns) for n in ("_extra", "file", "record", "reason", "cells")}
    names = [*columns, *further.values()]
    kinds = ["string"] * len(columns) + ["array<string>", "string", "long", "string", "int"]
    todo = ranges.where(F.size("header") > 0).repartition(max(1, spark.sparkContext.defaultParallelism * 2), "path", "start")
    rows = todo.mapInArrow(lambda it: _parse_ranges(it, columns, names), ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True)))
    return rows, further


def read_lenient_csv(spark: SparkSession, path: str, sep: str | None = None, skip_rejects: bool = False) -> DataFrame:
    """S4 + P3. Columns in order of first appearance over the files in path order, then ``_extra``.

    A record with surplus cells, broken characters or a quote that is never closed is kept
    as far as it can be read, or left out with ``skip_rejects``; ``csv_rejects`` names it.
    """
    rows, columns, further = read_records(spark, path, sep)
    if skip_rejects:
        rows = rows.where(F.col(f"`{further['reason']}`").isNull())
    return rows.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{further['_extra']}`"))


def csv_rejects(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """``file, record, reason, cells``: records that a strict load would skip, with their number in the file."""
    rows, _, further = read_records(spark, path, sep)
    return rows.where(F.col(f"`{further['reason']}`").isNotNull()).select(*[F.col(f"`{further[n]}`").alias(n) for n in ("file", "record", "reason", "cells")])


def read_tabular(spark: SparkSession, path: str) -> DataFrame:
    """Route by lowercase suffix; anything else is an error."""
    suffix = posixpath.splitext(path.rstrip("/"))[1].lower()
    if suffix == ".csv":
        return read_lenient_csv(spark, path)
    if suffix == ".dbf":
        from refloom.sources.dbf import read_dbf

        return read_dbf(spark, path)
    if suffix == ".geojson":
        from refloom.sources.geojson import read_geojson

        return read_geojson(spark, path)
    if suffix in TABULAR_SUFFIXES:
        raise UnsupportedFormat(f"{suffix} files need a spreadsheet/geometry reader that is not built: {path}")
    raise UnsupportedFormat(f"unsupported file format: {posixpath.basename(path)}")
