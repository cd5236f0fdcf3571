"""Input files derived from the driver tables, for the ingestion queries.

Each writer is a Spark job over a whole table: rows are grouped by their target
file (a key derived from the row), and each task writes its files into a fresh
folder under the session's checkpoint directory (the shared folder on a
cluster). The readers of ``refloom.sources`` then load those files back.
"""

from __future__ import annotations

import csv
import io
import json
import os
import shutil
import tempfile
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.session import ship_package
from refloom.sources.staging import WholeFile, scratch_dir


def _open_out(path: str) -> WholeFile:
    return WholeFile(path)


def _write_bytes(path: str, data: bytes) -> None:
    with _open_out(path) as out:
        out.write(data)


def _run(df: DataFrame) -> None:
    """Force the writer job; nothing of it reaches the driver."""
    ship_package(df.sparkSession)
    df.write.format("noop").mode("overwrite").save()


def _runs(batches, key: str):
    """(key value, rows) runs in order. Rows arrive sorted by ``key`` within the
    partition, possibly split over several Arrow batches: a file's rows may span
    batches, so writers stay open across them and close when the key changes."""
    for pdf in batches:
        if pdf.empty:
            continue
        keys = pdf[key].tolist()
        start = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                yield keys[start], pdf.iloc[start:i]
                start = i


def _stream_files(df: DataFrame, key: str, order: list[str], open_file, schema: str = "file string, n long") -> None:
    """Write one file per ``key`` value with bounded memory: ``open_file(key, first rows) -> writer``
    with ``add(rows)`` and ``close() -> n``."""

    def write(it):
        current, writer = None, None
        for k, rows in _runs(it, key):
            if k != current:
                if writer is not None:
                    yield pd.DataFrame({"file": [str(current)], "n": [writer.close()]})
                current, writer = k, open_file(k, rows)
            writer.add(rows)
        if writer is not None:
            yield pd.DataFrame({"file": [str(current)], "n": [writer.close()]})

    _run(df.repartition(key).sortWithinPartitions(key, *order).mapInPandas(write, schema))


# ------------------------------------------------------------------ zip archives of CSV members
class _ArchiveWriter:
    def __init__(self, path: str):
        self.out = _open_out(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_DEFLATED)
        self.member, self.stream, self.n = None, None, 0

    def add(self, rows) -> None:
        for member, part in rows.groupby("member", sort=False):
            if member != self.member:
                if self.stream is not None:
                    self.stream.close()
                self.member, self.stream = member, self.zip.open(member, "w")
                text = io.StringIO()
                csv.writer(text, delimiter=part["sep"].iloc[0], lineterminator="\n").writerow(list(part["header"].iloc[0]))
                self.stream.write(text.getvalue().encode("utf-8"))
            text = io.StringIO()
            w = csv.writer(text, delimiter=part["sep"].iloc[0], lineterminator="\n")
            for fields in part["fields"]:
                w.writerow(list(fields))
            self.stream.write(text.getvalue().encode("utf-8"))
            self.n += len(part)

    def close(self) -> int:
        if self.stream is not None:
            self.stream.close()
        self.zip.close()
        self.out.close()
        return self.n


class _SpoiltWriter:
    """A file named like an archive that is an HTML page, or bytes that are no archive."""

    def __init__(self, path: str, page: bool):
        self.path, self.page, self.n = path, page, 0

    def add(self, rows) -> None:
        self.n += len(rows)

    def close(self) -> int:
        _write_bytes(self.path, b"<html><body>try again</body></html>" if self.page else b"torn off")
        return self.n


def write_archives(lines: DataFrame, out: str, spoil: bool = False) -> None:
    """``lines(archive, member, header, sep, ord, fields array<string>)`` -> one zip per
    archive holding one CSV member per (archive, member), rows in ``ord`` order. With
    ``spoil``, archives ``<n>-…`` are pages where n % 3 is 1 and torn where it is 2."""

    def open_file(k, _rows):
        kind = int(k.split("-")[0]) % 3 if spoil else 0
        path = os.path.join(out, k)
        return _SpoiltWriter(path, kind == 1) if kind else _ArchiveWriter(path)

    _stream_files(lines, "archive", ["member", "ord"], open_file)


class _BoxedWriter:
    """A zip that holds, inside another zip, one table: ``<name>`` with the suffix of its kind."""

    def __init__(self, path: str, name: str, names: list[str], kind: str, widths: list[int] | None):
        self.path, self.name, self.names, self.kind, self.widths = path, name, names, kind, widths
        self.rows, self.n = tempfile.SpooledTemporaryFile(max_size=32 << 20), 0

    def add(self, rows) -> None:
        cells = [[None if v is None else str(v) for v in r] for r in rows[self.names].itertuples(index=False)]
        if self.kind == "dbf":
            self.rows.write(_dbf_records(list(zip(self.names, self.widths)), cells))
        elif self.kind == "geojson":
            feats = [{"type": "Feature", "geometry": None, "properties": dict(zip(self.names, c))} for c in cells]
            self.rows.write((("," if self.n else "") + ",".join(json.dumps(f, ensure_ascii=False) for f in feats)).encode("utf-8"))
        else:
            text = io.StringIO()
            csv.writer(text, delimiter=";", lineterminator="\n").writerows(cells)
            self.rows.write(text.getvalue().encode("utf-8"))
        self.n += len(cells)

    def close(self) -> int:
        head, tail = {
            "csv": lambda: ((";".join(self.names) + "\n").encode(), b""),
            "dbf": lambda: (_dbf_header(list(zip(self.names, self.widths)), self.n), b"\x1a"),
            "geojson": lambda: (b'{"type": "FeatureCollection", "features": [', b"]}"),
        }[self.kind]()
        member = f"{self.name}.{self.kind}"
        self.rows.seek(0)
        with tempfile.SpooledTemporaryFile(max_size=32 << 20) as inner:
            with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z, z.open(member, "w") as out:
                out.write(head)
                shutil.copyfileobj(self.rows, out, 1 << 20)
                out.write(tail)
            inner.seek(0)
            with _open_out(self.path) as whole, zipfile.ZipFile(whole, "w") as z:
                z.writestr("LISEZMOI.txt", "table")
                with z.open(f"sub/{self.name}.zip", "w") as out:
                    shutil.copyfileobj(inner, out, 1 << 20)
        return self.n


def write_boxed(rows: DataFrame, name: str, names: list[str], out: str, kind: str = "csv") -> None:
    """One ``<name>-<file>.zip`` per value of ``file``, its table (``csv``, ``dbf`` or ``geojson``) in a zip
    inside; rows in ``ord`` order."""
    widths = None
    if kind == "dbf":
        widest = rows.agg(*[F.max(F.octet_length(n)).alias(n) for n in names]).first()
        widths = [max(1, widest[n] or 0) for n in names]
    _stream_files(rows, "file", ["ord"], lambda k, _: _BoxedWriter(os.path.join(out, f"{name}-{k}.zip"), name, names, kind, widths))


#: Stands in a line for a byte that is part of no UTF-8 text.
BROKEN = "\uffff"


class _TextWriter:
    def __init__(self, path: str, head: str, codec: str):
        self.out, self.codec, self.n = _open_out(path), codec, 0
        self.out.write({"utf-16-le": b"\xff\xfe", "utf-8-sig": b"\xef\xbb\xbf"}.get(codec, b""))
        self._put(head)

    def _put(self, text: str) -> None:
        raw = text.encode("utf-8" if self.codec == "utf-8-sig" else self.codec)
        self.out.write(raw.replace(BROKEN.encode(), b"\xff") if self.codec == "utf-8" else raw)

    def add(self, rows) -> None:
        self._put("".join(f"{line}\n" for line in rows["line"]))
        self.n += len(rows)

    def close(self) -> int:
        self.out.close()
        return self.n


def write_text_files(rows: DataFrame, key: str, head: str | None, out: str, suffix: str) -> None:
    """One text file per key value: ``head`` (or the rows' column ``head``), then ``line`` in ``ord`` order, in
    the rows' ``codec`` where they have one, else in UTF-8."""

    def open_file(k, first):
        of = first.iloc[0]
        return _TextWriter(os.path.join(out, f"{k}{suffix}"), of["head"] if head is None else head, of.get("codec", "utf-8"))

    _stream_files(rows, key, ["ord"], open_file)


# ------------------------------------------------------------------ dBASE
def _dbf_header(fields: list[tuple[str, int]], n_records: int) -> bytes:
    import struct

    rec_len = 1 + sum(w for _, w in fields)
    header_len = 32 + 32 * len(fields) + 1
    head = io.BytesIO()
    head.write(struct.pack("<B3BIHH20x", 3, 125, 1, 1, n_records, header_len, rec_len))
    for name, w in fields:
        head.write(struct.pack("<11sc4xBB14x", name.encode("ascii"), b"C", w, 0))
    head.write(b"\x0d")
    return head.getvalue()


def _dbf_records(fields: list[tuple[str, int]], records) -> bytes:
    out = io.BytesIO()
    for vals in records:
        out.write(b" ")
        for (name, w), v in zip(fields, vals):
            cell = (v or "").encode("utf-8")
            if len(cell) > w:
                raise ValueError(f"{name}: {v!r} is wider than {w} bytes")
            out.write(cell.ljust(w, b" "))
    return out.getvalue()


def dbf_bytes(fields: list[tuple[str, int]], records: list[list[str]]) -> bytes:
    """A whole dBASE III table of character fields (name, width)."""
    return _dbf_header(fields, len(records)) + _dbf_records(fields, records) + b"\x1a"


class _DbfWriter:
    def __init__(self, path: str, fields, n_records: int):
        self.fields, self.names = fields, [n for n, _ in fields]
        self.out = _open_out(path)
        self.out.write(_dbf_header(fields, n_records))
        self.n = 0
        _write_bytes(path[:-4] + ".cpg", b"UTF-8")

    def add(self, rows) -> None:
        recs = [[None if v is None else str(v) for v in r] for r in rows[self.names].itertuples(index=False)]
        self.out.write(_dbf_records(self.fields, recs))
        self.n += len(recs)

    def close(self) -> int:
        self.out.write(b"\x1a")
        self.out.close()
        return self.n


def write_dbf_files(rows: DataFrame, key: str, names: list[str], out: str) -> None:
    """One ``<key>.dbf`` (+ ``.cpg``) per key value; field values are the text columns
    ``names``, in ``ord`` order, as wide as their longest value. The record count goes in
    the header, so each row carries the count of its file."""
    widest = rows.agg(*[F.max(F.octet_length(n)).alias(n) for n in names]).first()
    fields = [(n, max(1, widest[n] or 0)) for n in names]
    counted = rows.join(rows.groupBy(key).agg(F.count("*").alias("records")), key)
    _stream_files(counted, key, ["ord"], lambda k, first: _DbfWriter(os.path.join(out, f"{k}.dbf"), fields, int(first["records"].iloc[0])))


# ------------------------------------------------------------------ JSON documents
class _JsonListWriter:
    """A JSON document whose one list is streamed: ``prefix`` + items + ``suffix``."""

    def __init__(self, path: str, prefix: str, suffix: str, item):
        self.out, self.suffix, self.item, self.n = _open_out(path), suffix, item, 0
        self.out.write(prefix.encode("utf-8"))

    def add(self, rows) -> None:
        parts = []
        for r in rows.to_dict("records"):
            made = self.item(r)  # JSON text as it is to stand, or what becomes it
            parts.append(("," if self.n else "") + (made if isinstance(made, str) else json.dumps(made, ensure_ascii=False)))
            self.n += 1
        self.out.write("".join(parts).encode("utf-8"))

    def close(self) -> int:
        self.out.write(self.suffix.encode("utf-8"))
        self.out.close()
        return self.n


def write_json_lists(rows: DataFrame, key: str, out: str, suffix: str, envelope, item) -> None:
    """One JSON document per key value: ``envelope(key) -> (prefix, suffix)`` around
    the streamed list of ``item(row)`` in ``ord`` order."""

    def open_file(k, _rows):
        prefix, tail = envelope(k)
        return _JsonListWriter(os.path.join(out, f"{k}{suffix}"), prefix, tail, item)

    _stream_files(rows, key, ["ord"], open_file)


def text_fields(*cols) -> "F.Column":
    return F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
