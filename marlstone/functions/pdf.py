"""What a PDF says about itself, by the file format's own syntax.

The end of the file tells where its table of objects is: a plain one, or (since version 1.5)
a compressed stream, which may name further objects that lie together in compressed streams.
Of a file only its end, these tables and the objects on the way to the information dictionary
are read, so a ``Source`` may be a file of any size in any store.  Files whose tables are
damaged are searched for the dictionary's entries as they stand.
"""

from __future__ import annotations

import re
import zlib
from typing import Any, NamedTuple

#: The entries of an information dictionary.
NAMES = ("Title", "Author", "Subject", "Keywords", "Creator", "Producer", "CreationDate", "ModDate")
_ENTRY = re.compile(rb"/(" + "|".join(NAMES).encode() + rb")\s*(?=[(<])")
_ESCAPE = re.compile(rb"\\(\r\n|[0-7]{1,3}|.)", re.S)
#: The escapes of PDF strings.
_NAMED = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"\n": b"", b"\r": b"", b"\r\n": b""}
_TOKEN = re.compile(rb"(?:[\x00\t\n\x0c\r ]|%[^\r\n]*)*(<<|>>|\[|\]|\(|<|/[^\x00\t\n\x0c\r ()<>\[\]{}/%]*|[^\x00\t\n\x0c\r ()<>\[\]{}/%]+)")
#: Bytes at the end in which the table's place is looked for, around an object, and of any one stream.
_TAIL, _AROUND, _MOST = 2048, 4096, 64 << 20
#: Says of a file that its strings can't be read.
ENCRYPTED = "Encrypted"


class Reference(NamedTuple):
    number: int


class Source:
    """A PDF's bytes; a subclass may fetch them piece by piece."""

    def __init__(self, data: bytes):
        self.data, self.size = data, len(data)

    def read(self, at: int, n: int) -> bytes:
        return self.data[max(at, 0) : max(at, 0) + n]


class FileSource(Source):
    """The bytes of an open file."""

    def __init__(self, file):
        self.file, self.size = file, file.size()

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(max(at, 0))
        return self.file.read(n)


def _string_end(data: bytes, at: int) -> int:
    """Behind the bracket that closes the string that begins at ``at``; inner brackets come in
    pairs.  -1 if there is none."""
    depth, i = 0, at
    while i < len(data):
        c = data[i]
        if c == 0x5C:
            i += 1
        elif c == 0x28:
            depth += 1
        elif c == 0x29:
            depth -= 1
            if not depth:
                return i + 1
        i += 1
    return -1


def _literal(data: bytes, at: int) -> bytes | None:
    end = _string_end(data, at)
    if end < 0:
        return None
    return _ESCAPE.sub(lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() and m[1][:1] < b"8" else _NAMED.get(m[1], m[1]), data[at + 1 : end - 1])


def _hexadecimal(data: bytes) -> bytes:
    digits = re.sub(rb"[^0-9A-Fa-f]", b"", data)
    return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())


def _text(raw: bytes) -> str:
    return (raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw[3:].decode("utf-8", "replace") if raw[:3] == b"\xef\xbb\xbf" else raw.decode("latin-1")).strip()


class Reader:
    """Objects from a stretch of a PDF, one after the other."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def token(self) -> bytes:
        found = _TOKEN.match(self.data, self.at)
        if not found:
            raise ValueError("no object")
        self.at = found.end()
        return found[1]

    def value(self) -> Any:
        """Numbers, names (with ``/``), strings (as bytearrays), references, lists and
        dictionaries; other words as bytes."""
        token = self.token()
        if token == b"<<":
            made = {}
            while (key := self.token()) != b">>":
                made[key[1:].decode("latin-1")] = self.value()
            return made
        if token == b"[":
            items = []
            while True:
                here = self.at
                if self.token() == b"]":
                    return items
                self.at = here
                items.append(self.value())
        if token == b"(":
            start, self.at = self.at - 1, _string_end(self.data, self.at - 1)
            if self.at < 0:
                raise ValueError("a string without end")
            return bytearray(_literal(self.data, start) or b"")
        if token == b"<":
            end = self.data.index(b">", self.at)
            raw, self.at = self.data[self.at : end], end + 1
            return bytearray(_hexadecimal(raw))
        if re.fullmatch(rb"[+-]?\d+", token):
            after = re.compile(rb"[\s\x00]+\d+[\s\x00]+R(?![A-Za-z])").match(self.data, self.at)
            if after:
                self.at = after.end()
                return Reference(int(token))
            return int(token)
        return token.decode("latin-1") if token[:1] == b"/" else token


def _unpredicted(data: bytes, parameters: dict) -> bytes:
    """Undoes the row predictors of compressed streams (those of PNG)."""
    if not isinstance(parameters, dict) or parameters.get("Predictor", 1) < 10:
        return data
    width = max(1, parameters.get("Colors", 1) * parameters.get("BitsPerComponent", 8) // 8)
    length = (parameters.get("Columns", 1) * parameters.get("Colors", 1) * parameters.get("BitsPerComponent", 8) + 7) // 8
    out, above = bytearray(), bytearray(length)
    for start in range(0, len(data), length + 1):
        kind, row = data[start], bytearray(data[start + 1 : start + 1 + length].ljust(length, b"\x00"))
        for i in range(length):
            left, corner = (row[i - width], above[i - width]) if i >= width else (0, 0)
            if kind == 1:
                guess = left
            elif kind == 2:
                guess = above[i]
            elif kind == 3:
                guess = (left + above[i]) // 2
            elif kind == 4:
                guess = min((left, above[i], corner), key=lambda x, p=left + above[i] - corner: abs(p - x))
            else:
                guess = 0
            row[i] = (row[i] + guess) & 255
        out += row
        above = row
    return bytes(out)


class Document:
    """The objects of a PDF, found by its tables."""

    def __init__(self, source: Source):
        self.source = source
        #: of each object, where it is: its offset, or the stream that has it and its place there
        self.places: dict[int, tuple[int, ...]] = {}
        self.trailer: dict = {}
        tail = source.read(max(0, source.size - _TAIL), _TAIL)
        found = re.findall(rb"startxref\s+(\d+)", tail)
        if not found:
            raise ValueError("no table")
        todo, done = [int(found[-1])], set()
        while todo:
            at = todo.pop(0)
            if at in done or not 0 <= at < source.size:
                continue
            done.add(at)
            more = self._table(at) if source.read(at, 16).lstrip()[:4] == b"xref" else self._stream_table(at)
            for k, v in more.items():
                self.trailer.setdefault(k, v)  # the newest counts
            todo += [more[k] for k in ("XRefStm", "Prev") if isinstance(more.get(k), int)]

    def _table(self, at: int) -> dict:
        n = _AROUND
        while True:  # until the trailer's end is in sight
            data = self.source.read(at, n)
            try:
                reader = Reader(data, data.index(b"xref") + 4)
                own: dict[int, tuple[int, ...]] = {}
                while (first := reader.token()) != b"trailer":
                    count = int(reader.token())
                    for i in range(count):
                        offset, _, kind = reader.token(), reader.token(), reader.token()
                        if kind == b"n":
                            own[int(first) + i] = (int(offset),)
                trailer = reader.value()
                break
            except (ValueError, IndexError):
                if n >= min(self.source.size - at, _MOST):
                    raise
                n *= 8
        for k, v in own.items():
            self.places.setdefault(k, v)
        return trailer

    def _stream_table(self, at: int) -> dict:
        head, data = self._stream(at)
        widths, index = head["W"], head.get("Index") or [0, head["Size"]]
        row, at = sum(widths), 0
        for first, count in zip(index[::2], index[1::2], strict=False):
            for number in range(first, first + count):
                fields, i = [], at
                for w in widths:
                    fields.append(int.from_bytes(data[i : i + w], "big"))
                    i += w
                at += row
                kind = fields[0] if widths[0] else 1
                if at <= len(data) and kind:
                    self.places.setdefault(number, (fields[1],) if kind == 1 else (fields[1], fields[2]))
        return head

    def _stream(self, at: int) -> tuple[dict, bytes]:
        """The dictionary and the contents of the stream at an offset."""
        n = _AROUND
        while True:
            data = self.source.read(at, n)
            reader = Reader(data)
            try:
                reader.token(), reader.token(), reader.token()  # number, generation, obj
                head = reader.value()
                begin = re.compile(rb"[\s\x00]*stream\r?\n").match(data, reader.at)
                if not begin:
                    raise ValueError("no stream")
                break
            except (ValueError, IndexError):
                if n >= min(self.source.size - at, _MOST):
                    raise
                n *= 8
        length = self.resolved(head.get("Length"))
        raw = self.source.read(at + begin.end(), min(int(length), _MOST))
        kinds = head.get("Filter") or []
        kinds = kinds if isinstance(kinds, list) else [kinds]
        if kinds not in ([], ["/FlateDecode"], ["/Fl"]):
            raise ValueError(f"no filter {kinds}")
        if kinds:
            raw = zlib.decompressobj().decompress(raw, _MOST)
        parameters = head.get("DecodeParms") or {}
        return head, _unpredicted(raw, parameters[0] if isinstance(parameters, list) and parameters else parameters)

    def resolved(self, value: Any, depth: int = 8) -> Any:
        """What a reference stands for, at last."""
        while isinstance(value, Reference) and depth:
            place, depth = self.places.get(value.number), depth - 1
            if place is None:
                return None
            value = self._at(place[0]) if len(place) == 1 else self._within(*place)
        return value

    def _at(self, offset: int) -> Any:
        n = _AROUND
        while True:
            reader = Reader(self.source.read(offset, n))
            try:
                reader.token(), reader.token(), reader.token()
                return reader.value()
            except (ValueError, IndexError):
                if n >= min(self.source.size - offset, _MOST):
                    raise
                n *= 8

    def _within(self, stream: int, index: int) -> Any:
        place = self.places[stream]
        if len(place) != 1:
            raise ValueError("a stream within a stream")
        head, data = self._stream(place[0])
        reader = Reader(data)
        offsets = [(reader.value(), reader.value())[1] for _ in range(head["N"])]
        return Reader(data, head["First"] + offsets[index]).value()

    def information(self) -> dict[str, str]:
        if self.trailer.get("Encrypt") is not None:
            return {ENCRYPTED: "true"}
        own = self.resolved(self.trailer.get("Info"))
        entries = {k: self.resolved(own.get(k)) for k in NAMES} if isinstance(own, dict) else {}
        return {k: _text(bytes(v)) for k, v in entries.items() if isinstance(v, bytearray)}


def _searched(data: bytes) -> dict[str, str]:
    """Entries as they stand in the file, the last of a name."""
    found: dict[str, str] = {}
    for m in _ENTRY.finditer(data):
        raw = _literal(data, m.end()) if data[m.end() : m.end() + 1] == b"(" else _hexadecimal(data[m.end() : max(data.find(b">", m.end()), 0)])
        if raw is not None:
            found[m[1].decode()] = _text(raw)
    return found


def information(data: bytes | Source | None) -> dict[str, str]:
    """Name -> text of the entries of the information dictionary, or ``{ENCRYPTED: "true"}``;
    empty for what isn't a PDF."""
    source = data if isinstance(data, Source) else Source(data or b"")
    if source.read(0, _AROUND).lstrip()[:5] != b"%PDF-":
        return {}
    try:
        found = Document(source).information()
    except (ValueError, IndexError, KeyError, TypeError, AttributeError, RecursionError, zlib.error):
        found = {}
    return found or _searched(source.read(0, min(source.size, _MOST)))
