"""Lists of large JSON documents, cut element by element from a stream.

A task holds one element and one block of the document, whatever its size. Values are
not parsed: an element is its JSON text as it stands.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Collection, Iterator

BLOCK = 1 << 20

STRING = re.compile(r'"(?:[^"\\]++|\\.)*+"', re.DOTALL)
_MARK = re.compile(r'["{}\[\]]')
#: Inside an object lists need not be followed: long lists of numbers are passed over at once.
_OBJECT_MARK = re.compile(r'["{}]')
_SPACE = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"[^\s,}\]]+")


class JsonError(ValueError):
    pass


class Text:
    """A stream of text that forgets what lies before ``drop``."""

    def __init__(self, raw):
        self.raw, self.decode = raw, codecs.getincrementaldecoder("utf-8-sig")("replace").decode
        self.held, self.ended = "", False

    def more(self) -> bool:
        if self.ended:
            return False
        block = self.raw.read(BLOCK)
        self.ended = not block
        self.held += self.decode(block, final=self.ended)
        return True

    def mark(self, at: int, marks: re.Pattern = _MARK) -> tuple[str, int, int]:
        """The next bracket or string from ``at``: (what, start, end); ``""`` at the end."""
        while True:
            m = marks.search(self.held, at)
            if m and m[0] != '"':
                return m[0], m.start(), m.end()
            at = m.start() if m else len(self.held)
            if m and (s := STRING.match(self.held, at)):
                return '"', at, s.end()
            if not self.more():
                return "", at, at

    def drop(self, at: int) -> None:
        self.held = self.held[at:]


def list_objects(raw, names: Collection[str]) -> Iterator[tuple[str | None, str]]:
    """(list, JSON text) of the objects in the root object's lists of these names; (None, root) where it has none of them."""
    text = Text(raw)
    wanted = {json.dumps(n): n for n in names}
    what, start, at = text.mark(0)
    if what != "{":
        raise JsonError("the document is no object")
    depth, key, root = 1, None, True
    while depth:
        what, a, at = text.mark(at)
        if what == "":
            raise JsonError("the document ends within its root object")
        if what == '"':
            if depth == 1:
                key = text.held[a:at]
        elif what in "{[":
            if what == "[" and depth == 1 and key in wanted:
                root = False  # what the root holds beside its lists is not kept
                text.drop(at)
                at = yield from _listed(text, wanted[key])
                key = None
                continue
            depth += 1
        else:
            depth -= 1
    if root:
        yield None, text.held[start:at]


def _listed(text: Text, name: str) -> Iterator[tuple[str, str]]:
    """The objects of a list whose opening bracket was dropped; returns the place behind its end."""
    at, depth, start = 0, 0, 0
    while True:
        what, a, at = text.mark(at, _OBJECT_MARK if depth else _MARK)
        if what == "":
            raise JsonError(f"the document ends within its {name}")
        if what == "{":
            if depth == 0:
                start = a
            depth += 1
        elif what == "}":
            depth -= 1
            if depth == 0:
                yield name, text.held[start:at]
                if at > BLOCK:
                    text.drop(at)
                    at = 0
        elif what == "]" and depth == 0:
            return at


def _end(text: str, at: int) -> int:
    """Where the value that starts at ``at`` ends."""
    if text[at] == '"':
        m = STRING.match(text, at)
        if not m:
            raise JsonError("a string is not closed")
        return m.end()
    if text[at] not in "{[":
        return _SCALAR.match(text, at).end()
    depth = 0
    while m := _MARK.search(text, at):
        at = m.end()
        if m[0] == '"':
            at = _end(text, m.start())
        elif m[0] in "{[":
            depth += 1
        else:
            depth -= 1
            if depth == 0:
                return at
    raise JsonError("a value is not closed")


def members(text: str) -> Iterator[tuple[str, str]]:
    """(key, JSON text of the value) of an object's text."""
    at = _SPACE.match(text, 1).end()
    while at < len(text) and text[at] == '"':
        end = _end(text, at)
        key = json.loads(text[at:end], strict=False)
        at = _SPACE.match(text, _SPACE.match(text, end).end() + 1).end()  # behind the colon
        end = _end(text, at)
        yield key, text[at:end]
        at = _SPACE.match(text, end).end()
        if text[at : at + 1] == ",":
            at = _SPACE.match(text, at + 1).end()


def as_text(value: str) -> str | None:
    """A value as text: strings unescaped, ``null`` as None, anything else as it stands."""
    if value == "null":
        return None
    return json.loads(value, strict=False) if value[0] == '"' else value
