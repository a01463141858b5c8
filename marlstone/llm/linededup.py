"""Line dedup by content-defined chunks (operator 8).

A text falls into lines (split at ``\\n``).  A rolling hash goes over the hashes of its lines
that have a word, ``ROLL`` at a time, and puts each place into one of ``CLASSES`` classes.  Each
class cuts the text into chunks of its own: where the rolling hash falls into the class, the
``ROLL`` lines under it (and blank ones between them) become a chunk, with a border on either
side; where two such places overlap, the smaller hash counts.  Borders thus depend on the lines
of the chunk alone but for these rare overlaps: a block that is put in, left out or moved
elsewhere shifts none, and all classes together hold nearly every pair of neighbouring lines
as a chunk, whatever surrounds it.  (What lies between the chunks of one class is cut up by
the others.)

A chunk that occurs more than once in the corpus stays where it occurs first (smallest doc_id,
null last, then by a hash of the row, then by its place) and its lines are removed elsewhere.
Rolling hashes only find candidates: their contents are then grouped by the bytes themselves.
A line's own first occurrence always stays, since no chunk around it can have occurred before.

What belongs to a document comes to its text by a merge join at every size: it grows with
the corpus, so a plan that broadcasts it on small inputs would tell nothing of large ones.

Defined results: a null text has no lines and stays null; an empty text is one empty line;
lines without a word are in no chunk but between its lines, and a single repeated line is
none; rows equal in doc_id and text count as one document, and each is returned; an empty
table gives no rows; other columns are passed through by ``without_repeats`` and never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, stored, table
from .repeats import halves

#: Lines under the rolling hash, and classes that it falls into.
ROLL, CLASSES = 2, 64
_M = 0x9E3779B97F4A7C15


def chunks(lines: list[bytes], roll: int = ROLL, classes: int = CLASSES) -> list[tuple[int, int, int]]:
    """First line, end and rolling hash of the chunks of all classes, by their place."""
    worded = [i for i, line in enumerate(lines) if line and not line.isspace()]
    n = len(worded) - roll + 1
    if n < 1:
        return []
    own = np.fromiter((xxhash.xxh64_intdigest(lines[i]) for i in worded), np.uint64, len(worded))
    rolled = np.zeros(n, np.uint64)
    for j in range(roll):
        rolled = rolled * np.uint64(_M) + own[j : j + n]
    kind = (rolled ^ (rolled >> np.uint64(32))) % np.uint64(classes)
    lost = np.zeros(n, bool)
    near = np.zeros(n, bool)  # overlaps another one of its class
    for j in range(1, min(roll, n)):
        same = kind[j:] == kind[:-j]
        near[j:] |= same
        near[:-j] |= same
    if near.any():
        places = np.flatnonzero(near)
        taken: set[int] = set()
        for i in places[np.lexsort((places, rolled[places]))].tolist():
            if any(k in taken and kind[k] == kind[i] for k in range(i - roll + 1, i + roll)):
                lost[i] = True
            else:
                taken.add(i)
    values = rolled.view(np.int64).tolist()
    return [(worded[i], worded[i + roll - 1] + 1, values[i]) for i in np.flatnonzero(~lost).tolist()]


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text, and h1, h2 which stand for both."""
    h1, h2 = halves(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit("\x00"), F.coalesce(docs["text"], F.lit(""))))
    return docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), h1.alias("h1"), h2.alias("h2"))


def repeats(rows: DataFrame) -> DataFrame:
    """h1, h2 and ``drop``, the first lines of chunks to remove, of rows that have any."""

    def hashed(batches):
        for batch in batches:
            take, at, c = [], [], []
            for i, x in enumerate(batch.column(batch.schema.get_field_index("text"))):
                found = chunks((x.as_py() or "").encode().split(b"\n"))
                take += [i] * len(found)
                at += [first for first, _, _ in found]
                c += [value for _, _, value in found]
            own = {x: batch.column(batch.schema.get_field_index(x)).take(pa.array(take, pa.int64())) for x in ("h1", "h2")}
            yield pa.record_batch(own | {"at": pa.array(at, pa.int32()), "c": pa.array(c, pa.int64())})

    def contents(batches):
        for batch in batches:
            take, at, found = [], [], []
            wanted = batch.column(batch.schema.get_field_index("places"))
            for i, x in enumerate(batch.column(batch.schema.get_field_index("text"))):
                lines, own = (x.as_py() or "").encode().split(b"\n"), set(wanted[i].as_py())
                for first, end, _ in chunks(lines):
                    if first in own:
                        take.append(i)
                        at.append(first)
                        found.append(b"\n".join(lines[first:end]))
            own = {x: batch.column(batch.schema.get_field_index(x)).take(pa.array(take, pa.int64())) for x in ("doc_id", "h1", "h2")}
            yield pa.record_batch(own | {"at": pa.array(at, pa.int32()), "content": pa.array(found, pa.binary())})

    kind = rows.schema["doc_id"].dataType.simpleString()
    keys = stored(rows.mapInArrow(hashed, "h1 bigint, h2 bigint, at int, c bigint"), "chunks")
    # an aggregate's result is written before a join with it: only plain shuffles can be split where a key is hot
    shared = stored(keys.groupBy("c").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("c"), "shared")
    places = keys.join(shared, "c").groupBy("h1", "h2").agg(F.collect_list("at").alias("places"))  # of one document
    found = rows.join(places.hint("merge"), ["h1", "h2"]).mapInArrow(contents, f"doc_id {kind}, h1 bigint, h2 bigint, at int, content binary")
    found = stored(found, "contents")
    dropped(keys, shared)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2", "at")
    first = stored(found.groupBy("content").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("content", "first"), "first")
    later = found.select("content", "h1", "h2", "at", place.alias("place")).join(first, "content").filter("place > first")
    drops = stored(later.groupBy("h1", "h2").agg(F.collect_set("at").alias("drop")), "drops")
    dropped(found, first)
    return drops


def _kept(text: str | None, drop: list[int] | None) -> tuple[int, int, str | None]:
    if text is None:
        return 0, 0, None
    if not drop:
        return text.count("\n") + 1, 0, text
    lines, gone = text.encode().split(b"\n"), set(drop)
    out = [False] * len(lines)
    for first, end, _ in chunks(lines):
        if first in gone:
            out[first:end] = [True] * (end - first)
    kept = [line for line, x in zip(lines, out, strict=True) if not x]
    return len(lines), len(lines) - len(kept), b"\n".join(kept).decode()


def _finished(text, drop):
    """A struct of n_lines, n_removed, kept_sha256 and kept_text."""

    @F.arrow_udf("struct<n_lines:bigint,n_removed:bigint,kept_sha256:string,kept_text:string>")
    def run(texts: pa.Array, drops: pa.Array) -> pa.Array:
        made = [_kept(t.as_py(), d.as_py()) for t, d in zip(texts, drops, strict=True)]
        columns = [pa.array((m[0] for m in made), pa.int64()), pa.array((m[1] for m in made), pa.int64()), pa.array((hashlib.sha256((m[2] or "").encode()).hexdigest() for m in made), pa.string()), pa.array((m[2] for m in made), pa.string())]
        return pa.StructArray.from_arrays(columns, ["n_lines", "n_removed", "kept_sha256", "kept_text"])

    return run(text, drop)


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 and kept_text of each row of ``docs`` (doc_id, text)."""
    rows = _rows(docs)
    joined = rows.join(repeats(rows).hint("merge"), ["h1", "h2"], "left")
    return joined.select("doc_id", _finished(F.col("text"), F.col("drop")).alias("made")).select("doc_id", "made.*")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated chunks cut from ``text``; the other columns as they were."""
    own = _rows(docs)
    drops = repeats(own)
    key = halves(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit("\x00"), F.coalesce(docs["text"], F.lit(""))))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("marl_row"), key[0].alias("h1"), key[1].alias("h2"))
    made = rows.join(drops.hint("merge"), ["h1", "h2"], "left").select("marl_row", _finished(F.col("marl_row.text"), F.col("drop")).alias("marl_made"))
    return made.select(*[F.col("marl_made.kept_text").alias(c) if c == "text" else F.col("marl_row")[c].alias(c) for c in docs.columns])


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents")).drop("kept_text")
