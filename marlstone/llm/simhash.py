"""SimHash near-duplicates by deletion-variant signatures (operator 5).

A fingerprint has 64 bits, each the majority of that bit over the XXH64 of the document's
word shingles.  Two fingerprints link if they differ in at most ``DISTANCE`` = 4 bits.  The
64 bits are cut into three segments, so of four differing bits one segment has at most one.
Every fingerprint is indexed under each segment with each of its bits deleted in turn (64
keys); two that agree in a segment up to one bit share the key with that bit deleted.  The
keys are joined by equality and each meeting is verified on all 64 bits.

Only distinct fingerprints are indexed.  A task emits no pairs of a group but a spanning
forest of the links it found, which has the same components.  A group larger than
``GROUP`` is passed on, as it streams by, under longer keys: its other bits are cut into five
pieces, of which four differing bits leave at least one equal.  What is too large even then,
a dense cluster, is dealt into blocks of ``GROUP``, and each two blocks make a group of their
own: so no task holds more than two blocks, however many fingerprints share a key.  Components come from alternating large-star
and small-star steps on the written links.

Defined results: a null, empty or blank text has fingerprint zero, which links like any
other; documents with a null id take part in components, and a component of which every
id is null has a null component_id; repeated rows share a fingerprint; an empty table
gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chosen, stored, table

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Offset and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints in a group that one task compares, or in each of the two blocks that it does.
GROUP = 8192
#: Groups up to this size are compared all at once, larger ones row by row.
SMALL = 24
#: Fingerprints that a task's forest remembers before it starts anew.
FOREST = 1_000_000


def fingerprint_of(text: str | None, width: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()  # bytes: only A-Z change
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n, hashed = max(1, len(words) - width + 1), xxhash.xxh64_intdigest
    last = (ends[width - 1 :] if len(words) >= width else ends[-1:]) - 1
    hashes = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        counts += np.unpackbits(hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def fingerprints(text: Column, width: int = SHINGLE) -> Column:
    """The fingerprint of each text as a signed long."""

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint_of(x.as_py(), width) for x in texts], np.uint64).view(np.int64))

    return run(text)


def signatures(fp: Column) -> Column:
    """The 64 deletion variants: the deleted bit's number above the segment without it."""
    keys = []
    for offset, width in SEGMENTS:
        segment = F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1))
        keys += [segment.bitwiseAND(F.lit(~(1 << i))).bitwiseOR(F.lit((offset + i) << 22)) for i in range(width)]
    return F.array(*keys)


def others(key: int) -> int:
    """A mask of the bits outside the segment of a signature."""
    offset, width = next(s for s in SEGMENTS if s[0] <= key >> 22 < s[0] + s[1])
    return (2**64 - 1) ^ ((1 << width) - 1 << offset)


def longer(key: int, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the second level for a large group: each fingerprint under the group's key
    with one piece of its other bits."""
    bits = np.array([i for i in range(64) if others(key) >> i & 1])
    keys = []
    for piece, part in enumerate(np.array_split(bits, distance + 1)):
        mask = np.uint64(sum(1 << int(i) for i in part))
        mixed = ((fps & mask) ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(piece)
        mixed ^= mixed >> np.uint64(29)
        keys.append((mixed * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(key)).view(np.int64))  # a clash only adds a comparison
    return np.concatenate(keys), np.tile(fps, distance + 1)


class Forest:
    """Union-find that tells which links are new."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def joins(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if len(self.up) > FOREST:
            self.up.clear()
        self.up[max(a, b)] = min(a, b)
        return True


def _links(keys: np.ndarray, fps: np.ndarray, distance: int):
    """Verified links inside groups of equal keys; ``keys`` is sorted.  Small groups all
    at once, by the distance of two rows; large ones row by row."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    small = np.repeat(sizes <= SMALL, sizes)
    ks, fs = keys[small], fps[small]
    for d in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
        near = np.flatnonzero((ks[d:] == ks[:-d]) & (np.bitwise_count(fs[d:] ^ fs[:-d]) <= distance))
        if len(near):
            yield fs[near], fs[near + d]
    for at, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        group, tree = fps[at : at + size], np.arange(size)
        for i in range(size - 1):
            near = i + 1 + np.flatnonzero((np.bitwise_count(group[i + 1 :] ^ group[i]) <= distance) & (tree[i + 1 :] != tree[i]))
            if len(near):
                merged, one = np.unique(tree[near], return_index=True)  # one link to each tree
                tree[np.isin(tree, merged)] = tree[i]
                yield np.full(len(one), group[i]), group[near[one]]


def _met(batches, level: int, distance: int, limit: int):
    """Rows (key, fp) sorted by key -> forest links (a, b).  A group beyond the limit is
    passed on in rows with b null: on the first level under longer keys (key, a = fp), on
    the second in blocks (key, block, a = fp).  On the third every group is solved."""
    forest = Forest()

    def on(key: int, fps: np.ndarray, before: int = 0):
        """before: how many of the group were passed on already"""
        keys, of = longer(key, fps, distance) if level == 1 else (np.full(len(fps), key), fps)
        blocks = (before + np.arange(len(of))) // limit
        return pa.record_batch({"key": pa.array(keys), "block": pa.array(blocks.astype(np.int32)), "a": pa.array(of.view(np.int64)), "b": pa.nulls(len(of), pa.int64())})

    def whole(keys, fps):
        """Complete groups."""
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(keys)])))
        large = (sizes > limit) & (level < 3)
        for at, n in zip(starts[large].tolist(), sizes[large].tolist(), strict=True):
            yield on(int(keys[at]), fps[at : at + n])
        rest = ~np.repeat(large, sizes)
        a, b = [], []
        for x, y in _links(keys[rest], fps[rest], distance) if rest.any() else ():
            for p, q in zip(x.view(np.int64).tolist(), y.view(np.int64).tolist(), strict=True):
                if forest.joins(p, q):
                    a.append(max(p, q))
                    b.append(min(p, q))
        if a:
            yield pa.record_batch({"key": pa.nulls(len(a), pa.int64()), "block": pa.nulls(len(a), pa.int32()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    held = np.zeros(0, np.int64), np.zeros(0, np.uint64)  # of one group, which may go on
    passing, passed = None, 0  # the group that is passed on as it comes, and how far
    for batch in batches:
        keys = np.concatenate((held[0], batch.column(0).to_numpy()))
        fps = np.concatenate((held[1], batch.column(1).to_numpy().view(np.uint64)))
        if passing is not None and (n := int((keys == passing).sum())):
            yield on(passing, fps[:n], passed)
            passed += n
            keys, fps = keys[n:], fps[n:]
        held = keys[:0], fps[:0]
        if not len(keys):
            continue
        passing = None
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield from whole(keys[:cut], fps[:cut])
        if level < 3 and len(keys) - cut > limit:
            passing, passed = int(keys[-1]), len(keys) - cut
            yield on(passing, fps[cut:])
        else:
            held = keys[cut:], fps[cut:]
    if len(held[0]):
        yield from whole(*held)


def links(distinct: DataFrame, distance: int = DISTANCE, limit: int = GROUP) -> DataFrame:
    """Links (a > b) between the distinct fingerprints ``fp``, enough for the components."""
    rows, found = distinct.select(F.explode(signatures(F.col("fp"))).alias("key"), "fp"), []
    for level in (1, 2, 3):
        dealt = rows.repartition("key").sortWithinPartitions("key")
        made = stored(dealt.mapInArrow(lambda batches, level=level: _met(batches, level, distance, limit), "key bigint, block int, a bigint, b bigint"), "links")
        found.append(made.filter(F.col("b").isNotNull()).select("a", "b"))
        rows = made.filter(F.col("b").isNull()).select("key", "block", F.col("a").alias("fp"))
        if not rows.head(1):
            break
        if level == 2:  # each two blocks of a group meet
            blocks = stored(rows.groupBy("key").agg(F.max("block").alias("last")), "blocks")
            pairs = rows.join(blocks, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
            rows = pairs.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "fp")
        else:
            rows = rows.select("key", "fp")
    return reduce(DataFrame.unionByName, found).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each linked node but the smallest of its component, with that smallest one."""
    edges, before = stored(edges, "edges"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
        if now == before or not now[0]:
            return edges
        before = now
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        # written before the join, so that a node with very many links is a plain shuffle, which can be split
        least = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = stored(small.filter("a <> b").distinct(), "edges")


def classes(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``rows`` (doc_id, fp and others) with root (a fingerprint that names the component)
    and component_id."""
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    roots = components(links(distinct, distance)).toDF("fp", "root")
    of = distinct.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows.join(stored(of.join(least, "root").select("fp", "root", "component_id"), "classes"), "fp")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint and component_id of each row of ``docs`` (doc_id, text)."""
    rows = stored(chosen(docs, doc_id="doc_id", text="text").select("doc_id", fingerprints(F.col("text"), width).alias("fp")), "fingerprints")
    return classes(rows, distance).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component of ``docs``, the one with the smallest id (null last; ties
    by a hash of the text; of rows equal in both, one)."""
    h = F.xxhash64("text")
    rows = stored(chosen(docs, doc_id="doc_id", text="text").select("doc_id", h.alias("h"), fingerprints(F.col("text"), width).alias("fp")), "fingerprints")
    found = classes(rows, distance)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("best"), F.count(F.lit(1)).alias("n"))
    best = best.select(F.col("best.doc_id").alias("marl_id"), F.col("best.h").alias("marl_h"), (F.col("n") > 1).alias("marl_many"))
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("marl_row"), docs["doc_id"].alias("marl_id0"), F.xxhash64(docs["text"]).alias("marl_h0"))
    kept = packed.join(stored(best, "best"), F.col("marl_id0").eqNullSafe(F.col("marl_id")) & (F.col("marl_h0") == F.col("marl_h")))
    alone = kept.filter(~F.col("marl_many"))
    repeated = kept.filter("marl_many").dropDuplicates(["marl_id0", "marl_h0"])
    return alone.unionByName(repeated).select("marl_row.*")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
