"""Zip-archive ingestion.

Plan: ``binaryFile`` lists the archives (path and length only; contents are not
read by the JVM), the listing is spread one archive per task, and a ``mapInArrow``
task opens its archive by path and streams members. Two kinds of output:

* ``list_members`` - one row per member (any depth of nesting, for the
  tabular-file choice S3/O6) with its header when it is delimited text;
* ``read_member_rows`` - one row per data line of the CSV members of one logical
  table, already projected onto that table's union-by-name columns; large members are
  inflated once into the shared folder and read by many tasks.

Only per-member metadata (distinct headers per table) ever reaches the driver.
"""

from __future__ import annotations

import contextlib
import hashlib
import io
import itertools
import posixpath
import re
import shutil
import tempfile
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.functions.text import identifier
from refloom.operators.schema import free_name, normalize_headers
from refloom.session import cut_lineage, ship_package
from refloom.sources import dialect
from refloom.sources.staging import WholeFile, scratch_dir

# Suffixes the builder treats as tabular and the archive nesting limit.
# Cells and lines have no length limit: a long one is read whole.
TABULAR_SUFFIXES = (".csv", ".xls", ".xlsx", ".dbf", ".shp", ".gpkg", ".geojson")
MAX_NESTING = 5
SNIFF_BYTES = 4096
SPOOL_BYTES = 32 << 20

MEMBER_SCHEMA = (
    "archive string, archive_path string, chain array<string>, member string, depth int, suffix string, "
    "size long, looks_html boolean, header array<string>, error string"
)


class ArchiveError(RuntimeError):
    pass


# ------------------------------------------------------------------ helpers (run in tasks)
def open_path(path: str):
    """Open a file by URI for random access (zip needs seeks): local paths directly,
    anything else through Arrow's filesystem layer (HDFS, S3, GCS, ABFS)."""
    if path.startswith("file:"):
        from urllib.parse import unquote, urlparse

        return open(unquote(urlparse(path).path), "rb")
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(path)
    return filesystem.open_input_file(inner)


def _looks_html(head: bytes) -> bool:
    """K5 on bytes: a doctype or an html tag among the first characters, in any case."""
    return re.search(rb"<(?:!doctype )?html", head[:SNIFF_BYTES], re.IGNORECASE) is not None


class _Headed(io.RawIOBase):
    """A stream that cannot seek, with what was read of it put back in front."""

    def __init__(self, head: bytes, raw):
        super().__init__()
        self.head, self.raw = head, raw

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        data = self.head[: len(into)] if self.head else self.raw.read(len(into))
        self.head = self.head[len(data) :]
        into[: len(data)] = data
        return len(data)


def text_records(raw, sep: str | None = None) -> Iterator[list[str]]:
    """The records of a delimited text that are not blank, the header first.

    Dialect and encoding are found from its first bytes. A stream is read once: it is
    Latin-1 from the first bytes on that are no UTF-8, unless it held multi-byte UTF-8
    before them; then they are replaced.
    """
    head = raw.read(dialect.SAMPLE_BYTES)
    found = dialect.detect(head, len(head) < dialect.SAMPLE_BYTES, sep)
    stream = io.BufferedReader(_Headed(head[found.mark :], raw), 1 << 16)

    def texts() -> Iterator[str]:
        codec, wide = found.codec, False
        for line in iter(stream.readline, b"") if codec == "utf-8" else ():
            text, bad = dialect.decoded(line, codec)
            if bad and not wide and codec == "utf-8":
                codec = "latin-1"
                text, _ = dialect.decoded(line, codec)
            wide |= codec == "utf-8" and not bad and not line.isascii()
            yield from dialect.pieces(text)
        for _, text, _ in dialect.lines(stream, codec) if codec.startswith("utf-16") else ():
            yield from dialect.pieces(text)

    return (r for r in dialect.reader(texts(), found.sep, found.quote) if r)


def _dbf_names(raw) -> list[str]:
    from refloom.sources.dbf import parse_header

    return [name for name, _, _ in parse_header(raw)[3]]


def _geojson_names(raw) -> list[str]:
    from refloom.sources.geojson import property_names

    return property_names(raw)


#: How the column names of a member are read, by suffix.
_HEADERS = {".csv": lambda raw: next(text_records(raw), []), ".dbf": _dbf_names, ".geojson": _geojson_names}


def _header_of(zf: zipfile.ZipFile, name: str) -> tuple[list[str] | None, bool]:
    with zf.open(name) as raw:
        html = _looks_html(raw.read(SNIFF_BYTES))
    kind = posixpath.splitext(name)[1].lower()
    if html or kind not in _HEADERS:
        return None, html
    with zf.open(name) as raw:
        return _HEADERS[kind](raw), html


@contextlib.contextmanager
def nested_zip(zf: zipfile.ZipFile, name: str) -> Iterator[zipfile.ZipFile]:
    """An archive inside an archive, opened without holding it in memory: beyond
    ``SPOOL_BYTES`` it is spooled to a file that is gone when it is closed."""
    with tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES) as spool:
        with zf.open(name) as raw:
            shutil.copyfileobj(raw, spool, 1 << 20)
        spool.seek(0)
        with zipfile.ZipFile(spool) as inner:
            yield inner


def _walk(zf: zipfile.ZipFile, chain: list[str], depth: int, descend: bool) -> Iterator[tuple]:
    for info in sorted(zf.infolist(), key=lambda i: i.filename):
        if info.is_dir():
            continue
        name = info.filename
        suffix = posixpath.splitext(posixpath.basename(name))[1].lower()
        error = None
        try:
            header, html = _header_of(zf, name)
        except Exception as e:  # noqa: BLE001 - a broken member is reported, not fatal
            header, html, error = None, False, f"{type(e).__name__}: {e}"
        if html and suffix in TABULAR_SUFFIXES + (".zip",):
            error = "the member is an HTML page"
        yield (list(chain), name, depth, suffix, int(info.file_size), html, header, error)
        if descend and suffix == ".zip" and not html:
            if depth + 1 > MAX_NESTING:
                yield (list(chain) + [name], "", depth + 1, "", 0, False, None, "nesting too deep")
                continue
            try:
                with nested_zip(zf, name) as inner:
                    yield from _walk(inner, chain + [name], depth + 1, descend)
            except zipfile.BadZipFile as e:
                yield (list(chain) + [name], "", depth + 1, "", 0, False, None, f"BadZipFile: {e}")


def _members_batches(batches: Iterator[pa.RecordBatch], descend: bool) -> Iterator[pa.RecordBatch]:
    cols = ("archive", "archive_path", "chain", "member", "depth", "suffix", "size", "looks_html", "header", "error")
    for batch in batches:
        for path in batch.column("path").to_pylist():
            archive = posixpath.basename(path)
            out = {c: [] for c in cols}
            try:
                with open_path(path) as fh:
                    head = fh.read(SNIFF_BYTES)
                    fh.seek(0)
                    if _looks_html(head):
                        rows = [([], "", 0, "", 0, True, None, "the archive is an HTML page")]
                    else:
                        with zipfile.ZipFile(fh) as zf:
                            rows = list(_walk(zf, [], 0, descend))
            except Exception as e:  # noqa: BLE001
                rows = [([], "", 0, "", 0, False, None, f"{type(e).__name__}: {e}")]
            for r in rows:
                out["archive"].append(archive)
                out["archive_path"].append(path)
                for c, v in zip(cols[2:], r):
                    out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_member_arrow_schema())


def _member_arrow_schema() -> pa.Schema:
    return pa.schema(
        [
            ("archive", pa.string()), ("archive_path", pa.string()), ("chain", pa.list_(pa.string())),
            ("member", pa.string()), ("depth", pa.int32()), ("suffix", pa.string()), ("size", pa.int64()),
            ("looks_html", pa.bool_()), ("header", pa.list_(pa.string())), ("error", pa.string()),
        ]
    )


# ------------------------------------------------------------------ S1
def archive_index(spark: SparkSession, source_dir: str, pattern: str = "*.zip") -> DataFrame:
    """The archives of a directory (non-recursive, case-sensitive glob), range
    partitioned by path (contents are not read here). Error when there is none."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "false")
        .load(source_dir)
        .select("path", "length")
    )
    n = listing.count()
    if n == 0:
        raise ArchiveError(f"no zip archive found in {source_dir!r}")
    # Listing members is cheap per archive; rows are spread per member later, so a
    # few archives per task is fine and keeps the task count bounded.
    parts = max(1, min(n, spark.sparkContext.defaultParallelism * 4))
    return listing.repartitionByRange(parts, "path")


# ------------------------------------------------------------------ S2, S3
def list_members(index: DataFrame, descend: bool = False) -> DataFrame:
    """S2 (+S3 with ``descend=True``): one row per archive member, nested archives
    walked to depth 5. ``chain`` lists the nested archives leading to the member."""
    ship_package(index.sparkSession)
    return index.select("path").mapInArrow(lambda it: _members_batches(it, descend), MEMBER_SCHEMA)


def table_name(member) -> "F.Column":
    """member path without its last suffix, parts joined with ``_``, then F8."""
    stem = F.regexp_replace(member, r"([^/])\.[^./]+$", "$1")
    return identifier(F.regexp_replace(stem, "/", "_"))


def csv_members(members: DataFrame) -> DataFrame:
    """Readable CSV members (any case) at the top level of their archive, with their table."""
    readable = F.col("error").isNull()
    return members.filter(readable & (F.col("depth") == 0) & (F.col("suffix") == ".csv")).withColumn(
        "table_name", table_name(F.col("member"))
    )


def archive_rejects(members: DataFrame) -> DataFrame:
    """Archives and members that could not be read, with the reason: HTML pages saved as
    archives or tables, broken zips, broken members, nesting beyond the limit."""
    return members.filter(F.col("error").isNotNull()).select(
        "archive", F.array_join(F.concat("chain", F.array("member")), "!/").alias("member_path"), F.col("error").alias("reason")
    )


def extracted_files(members: DataFrame) -> DataFrame:
    """The files a load reads: ``archive, member, table_name, size``, one row a CSV member that is readable."""
    return csv_members(members).select("archive", "member", "table_name", "size")


def files_per_table(csv_rows: DataFrame) -> DataFrame:
    """A7 + K3: number of files per logical table (not rows), and their archives."""
    return csv_rows.groupBy("table_name").agg(
        F.countDistinct("archive", "member").alias("n_files"),
        F.countDistinct("archive").alias("n_archives"),
    )


def choice_key(chain, member, suffix):
    """S3/O6 order: inside one archive level, tabular files (CSV first, then other
    tabular, each by path parts) come before descending into nested archives (by
    name); a member's key is its list of such steps."""
    steps = F.transform(chain, lambda z: F.struct(F.lit(2).alias("k"), F.split(z, "/").alias("parts")))
    last = F.struct(
        F.when(suffix == ".csv", F.lit(0)).otherwise(F.lit(1)).alias("k"), F.split(member, "/").alias("parts")
    )
    return F.concat(steps, F.array(last))


def first_tabular_member(members: DataFrame) -> DataFrame:
    """S3 + O6: per archive, the tabular file the builder would open (CSV preferred,
    then nested archives in order). An aggregate; archives without one are absent."""
    tab = members.filter(F.col("suffix").isin(*TABULAR_SUFFIXES) & F.col("error").isNull())
    key = choice_key(F.col("chain"), F.col("member"), F.col("suffix"))
    header = F.col("header") if "header" in members.columns else F.lit(None).cast("array<string>").alias("header")
    best = F.min_by(F.struct("chain", "member", "depth", "suffix", header), key)
    return tab.groupBy("archive", "archive_path").agg(best.alias("b")).select(
        "archive", "archive_path", F.col("b.chain").alias("chain"), F.col("b.member").alias("member"),
        F.col("b.depth").alias("depth"), F.col("b.suffix").alias("suffix"), F.col("b.header").alias("header"),
        F.array_join(F.concat(F.col("b.chain"), F.array(F.col("b.member"))), "!/").alias("member_path"),
    )


# ------------------------------------------------------------------ S5 rows
def columns_of(rows: list[list[str]], places: Sequence[int], n_columns: int, width: int) -> list[pa.Array]:
    """Arrow columns of some records: cell ``i`` goes to column ``places[i]``; an empty or
    missing cell is NULL, as in SQL CSV readers; the last column holds surplus cells."""
    nothing = pa.nulls(len(rows), pa.string())
    out = [nothing] * n_columns
    # a row of the header's width is the rule; others are padded or cut to it
    cells = zip(*(r if len(r) == width else (r + [None] * (width - len(r)))[:width] for r in rows))
    for place, values in zip(places, cells):
        column = pa.array(values, pa.string())
        out[place] = pc.if_else(pc.equal(column, ""), None, column)
    return [*out, pa.array([r[width:] or None for r in rows], pa.list_(pa.string()))]


def further_names(columns: Sequence[str]) -> list[str]:
    """Names of the provenance columns and the surplus cells; one that a table has taken is lengthened."""
    return [free_name(n, columns) for n in ("archive", "member", "_extra")]


def _rows_batches(batches, columns: Sequence[str], batch_rows: int = 8192):
    """Data records of the (archive_path, member) rows of each input batch; each archive
    is opened once per batch and only the listed members are decompressed."""
    names = [*columns, *further_names(columns)]
    place = {c: i for i, c in enumerate(columns)}
    for batch in batches:
        wanted: dict[str, list[str]] = {}
        for path, member in zip(batch.column("archive_path").to_pylist(), batch.column("member").to_pylist()):
            wanted.setdefault(path, []).append(member)
        for path in sorted(wanted):
            with open_path(path) as fh, zipfile.ZipFile(fh) as zf:
                for member in sorted(wanted[path]):
                    with zf.open(member) as raw:
                        records = text_records(raw)
                        header = normalize_headers(next(records, []))
                        places = [place[h] for h in header]
                        while rows := list(itertools.islice(records, batch_rows)):
                            *cells, extra = columns_of(rows, places, len(columns), len(header))
                            source = [pa.array([v] * len(rows), pa.string()) for v in (posixpath.basename(path), member)]
                            yield pa.RecordBatch.from_arrays([*cells, *source, extra], names=names)


#: A member of more bytes is inflated once into a file of its own and read in ranges by many tasks.
LARGE_MEMBER = 64 << 20


def _stage_batches(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, member in zip(*(batch.column(c).to_pylist() for c in ("archive_path", "member")), strict=True):
            out = f"{folder}/{hashlib.sha256(f'{path}!/{member}'.encode()).hexdigest()}.csv"
            with open_path(path) as fh, zipfile.ZipFile(fh) as zf, zf.open(member) as raw, WholeFile(out) as whole:
                while block := raw.read(1 << 20):
                    whole.write(block)
                length = whole.tell()
            names = [pa.array([v], pa.string()) for v in (posixpath.basename(path), member, out)]
            yield pa.RecordBatch.from_arrays([*names, pa.array([length], pa.int64())], names=["archive", "member", "path", "length"])


def _large_rows(members: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The records of large members: each is inflated once, by one task, into the shared folder (the only way
    through a deflate stream), and then read by byte ranges like any file."""
    from refloom.sources import delimited

    spark = members.sparkSession
    folder = scratch_dir(spark, "members")
    tasks = max(1, spark.sparkContext.defaultParallelism * 2)
    spread = members.select("archive_path", "member").repartition(tasks, "archive_path", "member")
    staged = cut_lineage(spread.mapInArrow(lambda it: _stage_batches(it, folder), "archive string, member string, path string, length long"))
    rows, further = delimited.records_of(delimited.ranges_of(staged.select("path", "length")), columns)
    archive, member, extra = further_names(columns)
    of = staged.select(F.col("path").alias("_staged"), F.col("archive").alias("_of_archive"), F.col("member").alias("_of_member"))
    joined = rows.join(of, F.col(f"`{further['file']}`") == F.col("_staged"))
    return joined.select(
        *[F.col(f"`{c}`") for c in columns], F.col("_of_archive").alias(archive), F.col("_of_member").alias(member),
        F.col(f"`{further['_extra']}`").alias(extra),
    )


def read_member_rows(members: DataFrame, columns: Sequence[str], n_tasks: int | None = None) -> DataFrame:
    """S5 for one logical table: all data lines of the given ``(archive_path, member, size)``
    rows, as text columns in union-by-name order (missing columns NULL, short rows
    padded, surplus cells in ``_extra``), plus provenance ``archive`` and ``member``. Of
    these three names, one that is a column's is lengthened by underscores.

    Members are spread over tasks (an archive with many members is read by many tasks, each
    decompressing only its own members). A member of more than ``LARGE_MEMBER`` bytes is
    staged and read by many tasks (``_large_rows``); without a ``size`` none is.
    """
    kinds = ["string"] * (len(columns) + 2) + ["array<string>"]
    schema = ", ".join(f"`{c}` {k}" for c, k in zip([*columns, *further_names(columns)], kinds, strict=True))
    spark = members.sparkSession
    ship_package(spark)
    tasks = n_tasks or max(1, spark.sparkContext.defaultParallelism * 2)
    is_large = F.coalesce(F.col("size") > LARGE_MEMBER, F.lit(False)) if "size" in members.columns else F.lit(False)
    spread = members.where(~is_large).select("archive_path", "member").repartition(tasks, "archive_path", "member")
    # the rebalance hint lets AQE split what one task makes of a member for whatever comes next
    rows = spread.mapInArrow(lambda it: _rows_batches(it, list(columns)), schema).hint("rebalance")
    large = members.where(is_large)
    return rows if not columns or large.isEmpty() else rows.unionByName(_large_rows(large, columns))


# ------------------------------------------------------------------ the chosen member, opened
def _chosen_batches(batches: Iterator[pa.RecordBatch], columns: Sequence[str], batch_rows: int = 8192):
    """Records of the chosen member of each archive, at any nesting, as text columns."""
    from refloom.sources import dbf, geojson

    names = [*columns, free_name("archive", columns)]
    place = {c: i for i, c in enumerate(columns)}
    for batch in batches:
        for path, chain, member, suffix, raw_header in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with contextlib.ExitStack() as stack:
                zf = stack.enter_context(zipfile.ZipFile(stack.enter_context(open_path(path))))
                for name in chain:
                    zf = stack.enter_context(nested_zip(zf, name))
                raw = stack.enter_context(zf.open(member))
                if suffix == ".csv":
                    records = text_records(raw)
                    header = normalize_headers(next(records, []))
                    blocks = iter(lambda: list(itertools.islice(records, batch_rows)), [])
                    made = (columns_of(rows, [place[h] for h in header], len(columns), len(header))[:-1] for rows in blocks)
                elif suffix == ".geojson":
                    order = dict(zip(raw_header, normalize_headers(raw_header), strict=True))
                    rows = ({order[k]: v for k, v in f.items()} for f in geojson.features(raw))
                    blocks = iter(lambda: list(itertools.islice(rows, batch_rows)), [])  # noqa: B023
                    made = ([pa.array([r.get(c) for r in block], pa.string()) for c in columns] for block in blocks)
                else:
                    n, length, width, fields = dbf.parse_header(raw)
                    raw.read(length - raw.tell())
                    header = normalize_headers([f for f, _, _ in fields])
                    made = ([b.column(header.index(c)) if c in header else pa.nulls(b.num_rows, pa.string()) for c in columns]
                            for b in dbf.record_batches(raw, width, fields, n, "utf-8"))
                for cells in made:
                    source = pa.array([posixpath.basename(path)] * len(cells[0]), pa.string())
                    yield pa.RecordBatch.from_arrays([*cells, source], names=names)


def read_chosen(chosen: DataFrame) -> DataFrame:
    """S3 -> S10: the rows of the members that ``first_tabular_member`` chose, CSV, dBASE or GeoJSON,
    at any nesting, as text columns united by name, plus ``archive``. Other formats are errors.

    Distinct headers reach the driver (metadata); each member is read by one task.
    """
    spark = chosen.sparkSession
    ship_package(spark)
    found = chosen.groupBy("suffix", "header").agg(F.min("archive_path").alias("first")).orderBy("first").collect()
    other = sorted({r["suffix"] for r in found} - set(_HEADERS))
    if other:
        raise ArchiveError(f"no reader for members of the kind {', '.join(other)}")
    columns = union_columns([r["header"] or [] for r in found])
    schema = ", ".join(f"`{c}` string" for c in [*columns, free_name("archive", columns)])
    files = chosen.where(F.size("header") > 0).select("archive_path", "chain", "member", "suffix", "header").repartition(
        max(1, spark.sparkContext.defaultParallelism * 2), "archive_path"
    )
    return files.mapInArrow(lambda it: _chosen_batches(it, columns), schema).hint("rebalance")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame | None:
    """Quirk 7's addition: rows per loaded table (the manifest counts files), as one
    lazy plan: a global count per table, unioned."""
    from functools import reduce

    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, parts) if parts else None


def union_columns(headers_in_order: Sequence[Sequence[str]]) -> list[str]:
    """Union of normalized headers, in order of first appearance."""
    cols: list[str] = []
    for h in headers_in_order:
        for c in normalize_headers(list(h)):
            if c not in cols:
                cols.append(c)
    return cols


# ------------------------------------------------------------------ X2
def load_archives(spark: SparkSession, source_dir: str, strict: bool = True) -> tuple[dict[str, DataFrame], DataFrame]:
    """Archives -> {table_name: DataFrame of text columns}, plus the load
    manifest ``(table_name, n_files, n_archives)`` (K3).

    An archive or member that cannot be read is an error; with ``strict=False`` the rest
    is loaded and ``archive_rejects`` of the listing names what is missing.

    The member listing (one row per file) is checkpointed once and reused by every
    table; the driver collects one row per distinct (table, header) - metadata only.
    """
    index = archive_index(spark, source_dir)
    listed = cut_lineage(list_members(index))
    rejects = archive_rejects(listed)
    if strict and (some := rejects.orderBy("archive", "member_path").take(3)):
        shown = "; ".join(f"{r.archive} {r.member_path}: {r.reason}" for r in some)
        raise ArchiveError(f"{rejects.count()} archives or members cannot be read: {shown}")
    members = csv_members(listed)
    if members.isEmpty():
        raise ArchiveError("no CSV file found in the archives")
    manifest = files_per_table(members)
    meta = (
        members.groupBy("table_name", "header")
        .agg(F.min(F.struct("archive_path", "member")).alias("first"))
        .collect()
    )
    tables: dict[str, DataFrame] = {}
    for name in sorted({r["table_name"] for r in meta}):
        ordered = sorted(
            (r for r in meta if r["table_name"] == name), key=lambda r: (r["first"]["archive_path"], r["first"]["member"])
        )
        cols = union_columns([r["header"] or [] for r in ordered])
        tables[name] = read_member_rows(members.filter(F.col("table_name") == name), cols)
    return tables, manifest


def store_archives(spark: SparkSession, source_dir: str, schema: str = "anfr", path: str | None = None) -> DataFrame:
    """X2 + K1: load the archives and store every logical table as ``schema.table``
    (or under ``path``); returns the manifest ``(table_name, n_files, n_archives,
    n_rows)`` with qualified names. Rows are counted from the stored tables."""
    from refloom.operators.sinks import write_table

    tables, manifest = load_archives(spark, source_dir)
    stored = {}
    for name, df in sorted(tables.items()):
        where = write_table(df, name, schema=None if path else schema, path=path)
        stored[name] = spark.read.parquet(where) if path else spark.table(where)
    counts = row_counts(stored)
    qualified = F.concat(F.lit(f"{schema}."), F.col("table_name"))
    return manifest.join(counts, "table_name").select(
        qualified.alias("table_name"), "n_files", "n_archives", "n_rows"
    )


def _sniff_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("looks_html", pa.bool_()), ("error", pa.string())])
    for batch in batches:
        paths, flags, errors = [], [], []
        for path in batch.column("path").to_pylist():
            try:
                with open_path(path) as fh:
                    flags.append(_looks_html(fh.read(SNIFF_BYTES)))
                errors.append(None)
            except Exception as e:  # noqa: BLE001 - an unreadable file is reported
                flags.append(None)
                errors.append(f"{type(e).__name__}: {e}")
            paths.append(path)
        yield pa.RecordBatch.from_pydict({"path": paths, "looks_html": flags, "error": errors}, schema=schema)


def html_gate_files(spark: SparkSession, source: str, pattern: str = "*") -> DataFrame:
    """K5 for downloaded files: ``(path, looks_html, error)`` per file. Only the first
    4096 bytes of each file are read (in tasks, by path); contents never reach the JVM."""
    ship_package(spark)
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(source).select("path")
    )
    return listing.mapInArrow(_sniff_batches, "path string, looks_html boolean, error string")
