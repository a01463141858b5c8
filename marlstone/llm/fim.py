"""Fill-in-middle transformation (operator 11).

A text is cut into prefix, middle and suffix at two units chosen by hashes of its id, and
written in the order that a model learns to fill: prefix, suffix, middle (``psm``) or
suffix, prefix, middle (``spm``), each part behind its mark.  Some texts stay ``plain``.

The cuts are numbers of units (code points, words or lines), the text is bytes.  One pass
counts the units and records, for every ``every``-th of them, its byte and its code-point
offset.  A cut is then found by binary search in these checkpoints and a scan of at most
``every`` units from there, so no list of all units is ever made: of a text of n units the
index takes n / every entries, and the text itself is never decoded.

Units: ``chars`` are code points; a ``words`` unit is a word (``[^\\x20\\x09-\\x0D]+``) and the
space after it, a ``lines`` unit a line and its end; what stands before the first word is a
unit of its own.  The units tile the text.

Defined results: a null text is taken as empty; an empty text, one that holds a mark, and
the share that isn't chosen stay as they are (``plain``, no lengths); a null id is hashed as
the empty text; rows stand alone, so repeated rows get equal results and ties can't occur;
an empty table gives no rows.  Columns are made by expressions over the two that they are
given, so other columns can't clash with anything.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chosen, table

#: Units between checkpoints, and bytes that are looked at together.
EVERY, BLOCK = 256, 1 << 18
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Of a hundred texts, how many are transformed, and how many of those with the suffix first.
RATE, SUFFIX_FIRST = 90, 20


def _leads(block: np.ndarray) -> np.ndarray:
    return (block & 0xC0) != 0x80


def _starts(block: np.ndarray, before: int, unit: str) -> np.ndarray:
    """Where units start, given the byte before the block."""
    if unit == "chars":
        return _leads(block)
    last = np.empty_like(block)
    last[:1], last[1:] = before, block[:-1]
    if unit == "lines":
        return last == 10
    space = lambda x: (x == 32) | ((x >= 9) & (x <= 13))
    return space(last) & ~space(block)


class Checkpoints:
    """The sparse index of one text: unit numbers with their byte and code-point offsets."""

    def __init__(self, data, unit: str = "chars", every: int = EVERY, block: int = BLOCK):
        if unit not in ("chars", "words", "lines") or every < 1:
            raise ValueError(f"no unit {unit!r}, or {every} units between checkpoints")
        self.data, self.unit, self.every = np.frombuffer(data, np.uint8), unit, every
        self.units: list[int] = []
        self.bytes: list[int] = []
        self.chars: list[int] = []
        self.n = self.n_chars = 0
        for base in range(0, len(self.data), block):
            at, leads = self._scan(base, base + block)
            picked = at[-self.n % every :: every]
            self.units += range(self.n + -self.n % every, self.n + len(at), every)
            self.bytes += (picked + base).tolist()
            self.chars += (np.searchsorted(leads, picked) + self.n_chars).tolist()
            self.n += len(at)
            self.n_chars += len(leads)

    def _scan(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of units and of code points in a stretch of bytes, from its beginning."""
        part = self.data[low:high]
        leads = _leads(part)
        starts = leads if self.unit == "chars" else _starts(part, int(self.data[low - 1]) if low else 0, self.unit)
        if not low and len(part):
            starts[0] = True
        return np.flatnonzero(starts), np.flatnonzero(leads)

    def find(self, unit: int) -> tuple[int, int]:
        """The byte and the code point at which a unit starts; the text's end for the
        number after the last."""
        if unit >= self.n:
            return len(self.data), self.n_chars
        i = bisect_right(self.units, unit) - 1
        low, chars, ahead = self.bytes[i], self.chars[i], unit - self.units[i]
        while True:
            high = low + 4 * self.every
            at, leads = self._scan(low, high)
            if ahead < len(at):
                return low + int(at[ahead]), chars + int(np.searchsorted(leads, at[ahead]))
            low, chars, ahead = high, chars + len(leads), ahead - len(at)


def rewritten(data: bytes, hashes: tuple[int, int, int, int], unit: str = "chars", rate: int = RATE, suffix_first: int = SUFFIX_FIRST, marks=MARKS, every: int = EVERY) -> tuple[int, str, int | None, int | None, bytes]:
    """The units, form, code points of prefix and middle, and the output of one text."""
    index = Checkpoints(data, unit, every)
    p, s, m = (x.encode() for x in marks)
    if not data or p in data or s in data or m in data or hashes[2] % 100 >= rate:
        return index.n, "plain", None, None, data
    low, high = sorted(h % (index.n + 1) for h in hashes[:2])
    (a, prefix), (b, both) = index.find(low), index.find(high)
    if hashes[3] % 100 < suffix_first:
        return index.n, "spm", prefix, both - prefix, b"".join((s, data[b:], p, data[:a], m, data[a:b]))
    return index.n, "psm", prefix, both - prefix, b"".join((p, data[:a], s, data[b:], m, data[a:b]))


def original(output: bytes, form: str, marks=MARKS) -> bytes:
    """The text that ``rewritten`` was given.  No part holds a mark, and a mark begins with a
    character that it doesn't hold again, so each is found where it was put."""
    if form == "plain":
        return output
    p, s, m = (x.encode() for x in marks)
    first, second = (p, s) if form == "psm" else (s, p)
    one, rest = output[len(first) :].split(second, 1)
    two, middle = rest.split(m, 1)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


def _checked(marks) -> None:
    if len(marks) != 3 or not all(marks) or any(y[0] in x[1:] or (i != j and x.startswith(y)) for i, x in enumerate(marks) for j, y in enumerate(marks)):
        raise ValueError("no mark may begin with another one, or hold another's first character but at its start")


def _texts(column: pa.Array):
    """Each text's bytes (null: none), without decoding."""
    return (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in column.cast(pa.binary()))


def hashes(doc_id: Column, seed: str = "1") -> list[Column]:
    """Four 32-bit numbers from an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(text: Column, doc_id: Column, unit: str = "chars", rate: int = RATE, suffix_first: int = SUFFIX_FIRST, marks=MARKS, every: int = EVERY, seed: str = "1") -> Column:
    """``struct<n, form, prefix_chars, middle_chars, output>`` of each text."""
    _checked(marks)

    @F.arrow_udf("struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>")
    def run(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        drawn = zip(h1.to_pylist(), h2.to_pylist(), h3.to_pylist(), h4.to_pylist(), strict=True)
        made = [rewritten(t, h, unit, rate, suffix_first, marks, every) for t, h in zip(_texts(texts), drawn, strict=True)]
        kinds = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}
        return pa.StructArray.from_arrays([pa.array((m[i] for m in made), kind) for i, kind in enumerate(kinds.values())], list(kinds))

    return run(text, *hashes(doc_id, seed))


def restored(output: Column, form: Column, marks=MARKS) -> Column:
    """The text from which ``fill_in_middle`` made an output of that form (null: null)."""
    _checked(marks)

    @F.arrow_udf("string")
    def run(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return pa.array((original(x.as_buffer().to_pybytes(), f, marks) if x.is_valid and f else None for x, f in zip(outputs.cast(pa.binary()), forms.to_pylist(), strict=True)), pa.string())

    return run(output, form)


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = chosen(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    made = docs.select("doc_id", fill_in_middle(F.col("text"), F.col("doc_id")).alias("made")).select("doc_id", "made.*")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST('0x' || substring(h, 1, 8) AS BIGINT) AS h1,
    CAST('0x' || substring(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substring(h, 17, 8) AS BIGINT) AS h3,
    CAST('0x' || substring(h, 25, 8) AS BIGINT) AS h4
  FROM d
), cut AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
