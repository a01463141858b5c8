"""Substring dedup over bytes by threshold-bounded interval expansion (operator 3).

``repeats`` brings windows that can be equal into one group.  The contents of a portion of
groups are joined by a byte that UTF-8 never has, their suffixes sorted, and the
Burrows-Wheeler transform taken.  Intervals of suffixes that share a prefix are extended
backward, breadth first: the interval of w, all of one length, gives the interval of cw
for every byte c before it.  Where an interval of length l first ends, the common prefix
of the two suffixes there is l - 1, so common prefixes come in increasing value, and the
expansion stops at the window's length: boundaries that no interval has reached by then
lie inside a repeat that is long enough.

Defined results: a null text is empty; texts shorter than a window are kept whole; equal
rows are copies of each other, so with a window's length they are removed wholly; a cut
may fall inside a character, of which ``without_repeats`` then drops the other bytes too; a null id is carried through; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .repeats import Units, by_document, covered, halves, own_columns, removed

#: Bytes in a window, and in the grams whose least hash keys it.
WINDOW, GRAM = 200, 40
#: Never in UTF-8, so it can stand between texts.
BETWEEN = 0xFF
#: Common prefixes below this many bytes are read off the packed first bytes.
PACKED = 8


def suffix_order(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes sorted by their first bytes (at least ``window``), and the eight bytes at
    each position as a number."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(PACKED, np.uint8)))
    packed = np.zeros(n, np.uint64)
    for j in range(PACKED):
        packed = (packed << np.uint64(8)) | padded[j : j + n]
    rank = np.unique(packed, return_inverse=True)[1]
    length = PACKED
    while length < window:
        after = np.concatenate((rank[length:] + 1, np.zeros(min(length, n), rank.dtype)))
        both = rank * (n + 1) + after
        rank = np.unique(both, return_inverse=True)[1]
        length *= 2
        if int(rank.max(initial=0)) == n - 1:
            break
    return np.argsort(rank, kind="stable"), packed


def deep_boundaries(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted suffixes, and for each (and one past the last) whether its common prefix
    with the one before is ``window`` or longer."""
    if window < PACKED:
        raise ValueError(f"a window has {PACKED} bytes at least")
    n = len(data)
    order, packed = suffix_order(data, window)
    before = data[order - 1]  # the transform; cyclic at the first suffix
    target = np.empty(n, np.int64)
    target[np.argsort(before, kind="stable")] = np.arange(n)  # where each suffix's extension by one byte lies
    first = packed[order]
    unset = np.ones(n + 1, bool)
    unset[[0, n]] = False
    differ = first[1:] ^ first[:-1]
    at = np.flatnonzero(differ) + 1
    unset[at] = False
    # the intervals of eight bytes, of which only those whose right boundary is 7 were just found
    low = np.concatenate(([0], at))
    high = np.concatenate((at, [n]))
    just = np.concatenate((differ[at - 1] < 256, [True]))
    low, high = low[just], high[just]
    for _ in range(PACKED, window):
        if not len(low):
            break
        sizes = high - low
        interval = np.repeat(np.arange(len(low)), sizes)
        rows = np.arange(len(interval)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[interval]
        rows, interval = rows[before[rows] != BETWEEN], interval[before[rows] != BETWEEN]  # no window holds it
        if not len(rows):
            break
        to = target[rows]
        by = np.argsort(to, kind="stable")
        to, interval, byte = to[by], interval[by], before[rows][by]
        new = np.concatenate(([True], (interval[1:] != interval[:-1]) | (byte[1:] != byte[:-1])))
        low = to[new]
        high = to[np.concatenate((new[1:], [True]))] + 1
        fresh = unset[high]
        low, high = low[fresh], high[fresh]
        unset[high] = False
    return order, unset


def solve(contents: list[bytes], counts: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each window of each record the interval of suffixes that begin with it, as a
    number, or -1 if these records have it once."""
    between = bytes([BETWEEN])
    data = np.frombuffer(between.join(contents) + between, np.uint8)
    order, deep = deep_boundaries(data, window)
    node = np.full(len(data), -1, np.int64)
    inside = deep[:-1] | deep[1:]
    node[order[inside]] = np.cumsum(~deep[:-1])[inside]
    sizes = np.array([len(c) + 1 for c in contents])
    offsets = np.cumsum(sizes) - sizes
    return [node[o : o + n] for o, n in zip(offsets.tolist(), counts.tolist(), strict=True)]


def _per_text(docs: DataFrame, window: int, gram: int, text: bool, keep_first: bool = False, **limits) -> DataFrame:
    units = Units(window, min(gram, window), words=False)

    def finish(batches):
        for batch in batches:
            out = {"h1": [], "h2": [], "low": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept_text": []}
            for r in batch.to_pylist():
                data = r["text"].encode()
                low, high = covered(r["found"], 1 if keep_first else r["n"], len(data), window)
                kept, at = [], 0
                for a, b in zip(low.tolist(), high.tolist(), strict=True):
                    kept.append(data[at:a])
                    at = b
                kept = b"".join([*kept, data[at:]])
                for c, v in zip(out, (r["h1"], r["h2"], r["low"], len(data), int((high - low).sum()), len(low), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore") if text else None), strict=True):
                    out[c].append(v)
            yield pa.record_batch({c: pa.array(v, pa.string() if c[0] == "k" else pa.int64()) for c, v in out.items()})

    found = removed(docs, units, lambda *x: solve(*x, window=window), keep_first=keep_first, **limits)
    return found.mapInArrow(finish, "h1 bigint, h2 bigint, low bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string")


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, **limits) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of ``docs`` (doc_id, text)."""
    docs = own_columns(docs)
    return by_document(docs, _per_text(docs, window, gram, False, **limits)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, keep_first: bool = False, **limits) -> DataFrame:
    """``docs`` with ``text`` cut; the other columns as they were.  A null text stays null.
    With ``keep_first`` a passage stays where it occurs first: in the row with the smallest
    doc_id (an integer; others come last, in the order of a hash of the text), and there
    at its first place; rows equal in doc_id and text count as one and stay alike."""
    h1, h2 = halves(F.coalesce(docs["text"], F.lit("")))
    low = F.coalesce(docs["doc_id"].try_cast("bigint"), F.lit(2**63 - 1)) if keep_first else F.lit(0)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("marl_row"), docs["text"].isNull().alias("marl_null"), h1.alias("h1"), h2.alias("h2"), low.alias("marl_low"))
    own = docs.select("doc_id", "text") if keep_first else docs.select("text")
    kept = _per_text(own, window, gram, True, keep_first=keep_first, **limits).select("h1", "h2", "low", "n_bytes", "kept_text")
    if keep_first:  # of equal texts those after the first go, if they have a window
        gone = (F.col("marl_low") != F.col("low")) & (F.col("n_bytes") >= window)
        kept_text = F.when(gone, "").otherwise(F.col("kept_text"))
    else:
        kept_text = F.col("kept_text")
    joined = rows.join(kept, ["h1", "h2"]).select("marl_row", F.when(~F.col("marl_null"), kept_text).alias("marl_text"))
    return joined.select(*[F.col("marl_text").alias(c) if c == "text" else F.col("marl_row")[c].alias(c) for c in docs.columns])


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))
