"""Encoding and dialect of delimited text, found from its bytes.

A file is UTF-8, UTF-16 or Latin-1. UTF-16 tells by its mark or by its zero bytes.
Bytes that are no UTF-8 mean Latin-1 where nothing in the file is multi-byte UTF-8, and
broken characters otherwise. Delimiter and quote are the pair that splits sampled records
most evenly, by the state machine that the reader itself uses: a quote opens a cell only
at the cell's start, a doubled quote inside is a quote, and line breaks inside are text.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa

# Delimiters and quotes that are tried, in order of preference.
DELIMITERS = (";", ",", "\t", "|")
QUOTES = ('"', "'")
#: Bytes that the dialect is judged by (its complete records), and records of them.
SAMPLE_BYTES = 256 << 10
SAMPLE_RECORDS = 1000

_LINE = re.compile(r"[^\r]*\r\n?|[^\r]+")


class Dialect(NamedTuple):
    codec: str
    mark: int  # bytes of the byte order mark
    sep: str
    quote: str


def buffered(raw):
    """A binary file that has ``readline``."""
    return io.BufferedReader(raw, 1 << 20) if isinstance(raw, pa.NativeFile) else raw


def encoding(head: bytes) -> tuple[str, int]:
    """Codec and length of the byte order mark; UTF-8 stands for Latin-1 too until the file is read."""
    for mark, codec in ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")):
        if head.startswith(mark):
            return codec, len(mark)
    even, odd = head[0::2], head[1::2]
    if len(odd) >= 2:
        zeros = even.count(0) / len(even), odd.count(0) / len(odd)
        if zeros[1] > 0.3 and zeros[0] < 0.05:
            return "utf-16-le", 0
        if zeros[0] > 0.3 and zeros[1] < 0.05:
            return "utf-16-be", 0
    return "utf-8", 0


def characters(data: bytes) -> tuple[int, int]:
    """(multi-byte characters, broken ones) of UTF-8 bytes."""
    if data.isascii():
        return 0, 0
    text = data.decode("utf-8", "replace")
    broken = text.count("�") - data.count(b"\xef\xbf\xbd")
    return sum(not c.isascii() for c in text) - broken if broken else 1, broken


def lines(raw, codec: str) -> Iterator[tuple[int, str, bool]]:
    """(bytes taken, line with its end, whether characters were broken) from where ``raw`` stands."""
    if codec.startswith("utf-16"):
        held = b""
        end = "\n".encode(codec)
        while block := raw.read(1 << 16):
            held += block
            start, at = 0, held.find(end)
            while at >= 0:
                if at % 2 == 0:
                    yield at + 2 - start, *decoded(held[start : at + 2], codec)
                    start = at + 2
                at = held.find(end, at + 1 + (at % 2 == 0))
            held = held[start:]
        if held:
            yield len(held), *decoded(held, codec)
        return
    for line in iter(raw.readline, b""):
        yield len(line), *decoded(line, codec)


def decoded(line: bytes, codec: str) -> tuple[str, bool]:
    """The text of a line, and whether characters of it were broken and replaced."""
    try:
        return line.decode(codec), False
    except UnicodeDecodeError:
        return line.decode(codec, "replace"), True


def pieces(line: str) -> list[str]:
    """A line cut behind each lone carriage return, as the csv module wants it."""
    return [line] if "\r" not in line[:-2] and not line.endswith("\r") else _LINE.findall(line)


def reader(texts: Iterator[str], sep: str, quote: str) -> Iterator[list[str]]:
    csv.field_size_limit(sys.maxsize)
    if quote:
        return csv.reader(texts, delimiter=sep, quotechar=quote, doublequote=True)
    return csv.reader(texts, delimiter=sep, quoting=csv.QUOTE_NONE)


# --- the state machine over bytes -----------------------------------------------------------------


@lru_cache(maxsize=64)
def _cells(sep: str, quote: str) -> tuple[re.Pattern, re.Pattern]:
    s, q = re.escape(sep.encode()), re.escape(quote.encode())
    rest = rb"[^" + q + rb"]*+(?:" + q + q + rb"[^" + q + rb"]*+)*+(?:" + q + rb"|(?P<open>\Z))"
    return re.compile(rb"(?<![^" + s + rb"\r\n])" + q + rest), re.compile(rest)


def _ends(data: bytes, a: int, b: int) -> int:
    """Line ends in a stretch outside quotes (a pair counts once)."""
    n = data.count(b"\n", a, b)
    return n + data.count(b"\r", a, b) - data.count(b"\r\n", a, b) if data.find(b"\r", a, b) >= 0 else n


def scan(data: bytes, sep: str, quote: str, inside: bool) -> tuple[int, bool]:
    """(records that end in ``data``, whether it ends inside a quoted cell), if it starts inside one or not."""
    if not quote or quote.encode() not in data:
        return (0, True) if inside and quote else (_ends(data, 0, len(data)), False)
    opening, rest = _cells(sep, quote)
    n = at = 0
    if inside:
        m = rest.match(data)
        if m["open"] is not None:
            return 0, True
        at = m.end()
    for m in opening.finditer(data, at):
        n += _ends(data, at, m.start())
        if m["open"] is not None:
            return n, True
        at = m.end()
    return n + _ends(data, at, len(data)), False


# --- the dialect ----------------------------------------------------------------------------------


def _sampled(text: str, sep: str, quote: str, whole: bool) -> list[list[str]]:
    rows = reader((p for line in io.StringIO(text, newline="") for p in pieces(line)), sep, quote)
    found = []
    for row in rows:
        if row:
            found.append(row)
        if len(found) > SAMPLE_RECORDS:
            break
    else:
        if not whole and len(found) > 1:
            found.pop()  # the sample may end within its last record
    return found


def _quoted(text: str, sep: str, quote: str) -> tuple[int, int]:
    """(cells that are quoted from end to end, cells that open with a quote and go on otherwise)."""
    q, s = re.escape(quote), re.escape(sep)
    good = len(re.findall(rf"(?:(?<=[{s}\r\n])|\A){q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}(?=[{s}\r\n]|\Z)", text))
    opened = len(re.findall(rf"(?:(?<=[{s}\r\n])|\A){q}", text))
    return good, opened - good


def dialect(text: str, sep: str | None = None, whole: bool = True) -> tuple[str, str]:
    """Delimiter and quote of a sample: the pair whose records agree best on more than one cell.

    A pair counts by the share of records that are as wide as most are, times the cells that
    gives beyond the first; the header must be split by it. A single quote is taken only where
    it encloses cells and no double quote does. Without a pair that splits, commas do.
    """
    best = None
    for rank, s in enumerate([sep] if sep else DELIMITERS):
        quote = '"'
        if "'" in text and _quoted(text, s, "'")[0] > 0 == _quoted(text, s, "'")[1] and _quoted(text, s, '"')[0] == 0:
            quote = "'"
        rows = _sampled(text, s, quote, whole)
        if not rows:
            continue
        widths = Counter(map(len, rows))
        width, n = max(widths.items(), key=lambda wn: (wn[1], wn[0]))
        if len(rows[0]) < 2:
            width = 1
        key = (n / len(rows) * (width - 1), -rank)
        if best is None or key > best[0]:
            best = (key, s, quote)
    if best is None or (best[0][0] <= 0 and not sep):
        return sep or ",", '"' if best is None else best[2]
    return best[1], best[2]


def detect(head: bytes, whole: bool, sep: str | None = None) -> Dialect:
    """The dialect of a file from its first bytes (``whole``: they are all it has)."""
    codec, mark = encoding(head)
    body = head[mark:]
    if codec == "utf-8" and characters(body if whole else body[: body.rfind(b"\n") + 1])[1]:
        text = body.decode("latin-1")  # delimiters and quotes are the same bytes in any case
    else:
        text = body.decode(codec, "replace")
    return Dialect(codec, mark, *dialect(text, sep, whole))
