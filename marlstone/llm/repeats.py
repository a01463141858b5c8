"""What the two substring-dedup operators share: which windows can repeat at all, how
they meet, and what becomes of the texts.

Text is a sequence of units (words, or bytes); a window is a stretch of ``window`` units.
A window is removed if its content starts anywhere else.  Neither operator can send every
suffix of the corpus to every other, so windows are first put into groups such that equal
windows always share a group:

1. Equal texts are merged into one class with a count (a text that occurs twice is
   removed wholly, if it has a window).  The classes are stored in buckets, so that their
   texts go through one shuffle, however often they are read.
2. The anchor of a window is its gram of ``gram`` units with the least hash, and its key
   that hash: the prefix of the suffix that starts at the anchor.  The anchor depends on
   the window's content alone, so equal windows share a key.  Neighbouring windows mostly
   share their anchor; such a run of windows is one record.
3. Keys of a single record in the whole corpus can't hold a repeat and go no further.
4. The remaining records are merged with their count if they are equal, in each task before
   the shuffle and after it.
5. A group of ``GROUP`` different records or fewer is solved in memory by the operator's own
   engine (suffix tree, or Burrows-Wheeler transform).  In a larger one the prefix grows to
   the whole window: windows whose 128-bit BLAKE2 digest occurs twice are sent on with their
   contents and grouped by these bytes, so each group is one node, however many it counts.
6. What holds for a record goes back to all texts that have it.

Step 3 drops nothing that repeats, and clashes of its 64-bit hashes only make candidates
that an engine, which compares contents, rejects.  Digests (SHA-256, BLAKE2) of 128 bits
stand for whole texts and for equal records.

With ``keep_first`` one occurrence of each repeated window stays, the first by doc_id and
then by place in the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, chosen, dropped, stored

_M = 0x9E3779B97F4A7C15
_M_INVERSE = pow(_M, -1, 2**64)
#: Units of text hashed at a time.
CHUNK = 1 << 20
#: Distinct records in a group that one task solves as a whole.
GROUP = 4096
#: Bytes of records that an engine gets at once.
ENGINE_BYTES = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 2**64))
        have += more
    return out


_tables: list[np.ndarray] = []


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        size = max(n, CHUNK + 4096)
        _tables[:] = [_powers(_M, size), _powers(_M_INVERSE, size)]
    return _tables[0][:n], _tables[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits; one to one."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def sums(units: np.ndarray) -> np.ndarray:
    """Running polynomial sums modulo 2^64, from 0."""
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units.astype(np.uint64) * _table(len(units))[0], out=out[1:])
    return out


def stretch_hashes(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch, the same wherever it lies."""
    return mix((running[ends] - running[starts]) * _table(len(running))[1][starts])


def gram_hashes(units: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each stretch of ``gram`` units."""
    running = sums(units)
    return mix((running[gram:] - running[:-gram]) * _table(len(running))[1][: len(running) - gram])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbours, by running minima inside blocks."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    if w == 1:
        return x
    blocks = -(-len(x) // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


class Units:
    """How a text falls into units: ``split`` gives a hash for each unit and the byte
    offsets where units start and end."""

    def __init__(self, window: int, gram: int, words: bool):
        self.window, self.gram, self.words = window, gram, words

    def split(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = np.frombuffer(data, np.uint8)
        if not self.words:
            at = np.arange(len(raw))
            return raw, at, at + 1
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        hashes = np.empty(len(starts), np.uint64)
        for a in range(0, len(starts), CHUNK // 64):
            b = min(len(starts), a + CHUNK // 64)
            low = starts[a]
            part = raw[low : ends[b - 1]]
            if len(part) > CHUNK:  # very long words: one by one
                hashes[a:b] = [stretch_hashes(sums(raw[i:j] + np.uint8(1)), np.array([0]), np.array([j - i]))[0] for i, j in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
            else:
                hashes[a:b] = stretch_hashes(sums(part + np.uint8(1)), starts[a:b] - low, ends[a:b] - low)
        return hashes, starts, ends

    def runs(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """key, first window and end of each run of windows with one key."""
        return self._runs(units)[:3]

    def keys(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys, and whether the gram of each is there more than once: only
        then can a text repeat a window of that key by itself."""
        k, _, _, grams = self._runs(units)
        own = np.unique(k)
        many = np.zeros(len(own), np.int64)
        for g in grams:
            at = np.minimum(np.searchsorted(own, g), len(own) - 1)
            many += np.bincount(at[own[at] == g], minlength=len(own))
        return own, many > 1

    def _runs(self, units: np.ndarray):
        w = self.window - self.gram + 1
        keys, grams = [], []
        n = len(units) - self.window + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), grams
        for at in range(0, n, CHUNK):
            part = units[at : at + CHUNK + self.window - 1]
            grams.append(gram_hashes(part, self.gram))
            keys.append(sliding_min(grams[-1], w))
        keys = np.concatenate(keys) if len(keys) > 1 else keys[0]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], first, np.concatenate((first[1:], [n])), grams

    def windows(self, content: bytes, count: int) -> list[bytes]:
        """The first ``count`` windows of a record's content."""
        if not self.words:
            return [content[i : i + self.window] for i in range(count)]
        _, starts, ends = self.split(content)
        return [content[starts[i] : ends[i + self.window - 1]] for i in range(count)]


def _text(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    column = batch.column(batch.schema.get_field_index(name))
    for x in column.cast(pa.binary()):
        yield x.as_py() or b""


def _halves_of(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:16], "little", signed=True)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def removed(docs: DataFrame, units: Units, solve: Callable, group: int = GROUP, keep_first: bool = False) -> DataFrame:
    """h1, h2, n (copies), low (the smallest doc_id), text and ``found`` (records with ranges
    of windows to remove) for each distinct text of ``docs`` (doc_id, text); null counts as
    empty.  With ``keep_first`` the ranges leave out each window's first occurrence."""
    text = F.coalesce(docs["text"], F.lit(""))
    h1, h2 = halves(text)
    low = F.coalesce(docs["doc_id"].try_cast("bigint"), F.lit(2**63 - 1)) if "doc_id" in docs.columns else F.lit(0).cast("bigint")
    rows = docs.select(h1.alias("h1"), h2.alias("h2"), low.alias("low"), text.alias("text"))
    classes = bucketed(rows.groupBy("h1", "h2").agg(F.min("low").alias("low"), F.first("text").alias("text"), F.count(F.lit(1)).alias("n")), ["h1", "h2"], "classes")
    window = units.window

    def keys(batches):
        for batch in batches:
            a, b, sizes, found = _column(batch, "h1"), _column(batch, "h2"), [], []
            weights = []
            for data in _text(batch, "text"):
                own, many = units.keys(units.split(data)[0])
                sizes.append(len(own))
                found.append(own.view(np.int64))
                weights.append(1 + many.astype(np.int8))
            take = np.repeat(np.arange(len(sizes)), sizes)
            yield pa.record_batch({"h1": a.take(pa.array(take)), "h2": b.take(pa.array(take)), "key": pa.array(np.concatenate(found)), "many": pa.array(np.concatenate(weights))})

    held = stored(classes.select("h1", "h2", "text").mapInArrow(keys, "h1 bigint, h2 bigint, key bigint, many tinyint"), "keys")
    # an aggregate's result is written before a join with it: only plain shuffles can be split where a key is hot
    shared = stored(held.groupBy("key").agg(F.sum("many").alias("many")).filter("many > 1").select("key"), "shared")
    candidates = held.join(shared, "key").groupBy("h1", "h2").agg(F.collect_list("key").alias("keys"))

    def records(batches):
        for batch in batches:
            h1, h2, low = (_column(batch, c).to_numpy() for c in ("h1", "h2", "low"))
            wanted = _column(batch, "keys")
            out = {c: [] for c in RECORD}
            size = 0
            for i, data in enumerate(_text(batch, "text")):
                hashes, starts, ends = units.split(data)
                k, first, end = units.runs(hashes)
                use = np.flatnonzero(np.isin(k.view(np.int64), wanted[i].values.to_numpy()))
                for j in use.tolist():
                    for f in range(int(first[j]), int(end[j]), 4 * window):  # periodic text makes long runs
                        e = min(f + 4 * window, int(end[j]))
                        content = data[starts[f] : ends[e + window - 2]]
                        content = b" ".join(content.split()) if units.words else content
                        c1, c2 = _halves_of(hashlib.blake2b(content, digest_size=16).digest())
                        for c, v in zip(RECORD, (h1[i], h2[i], low[i], k.view(np.int64)[j], c1, c2, f, e - f, content), strict=True):
                            out[c].append(v)
                        size += len(content)
                if size > 8 << 20:
                    yield _records(out)
                    out = {c: [] for c in out}
                    size = 0
            yield _records(out)

    with_keys = classes.join(candidates, ["h1", "h2"]).select("h1", "h2", "low", "text", "keys")
    found = stored(with_keys.mapInArrow(records, "h1 bigint, h2 bigint, low bigint, key bigint, c1 bigint, c2 bigint, first int, n int, content binary"), "records")
    dropped(held, shared)
    own = F.struct("low", "h1", "h2", "first")
    merged = found.groupBy("key", "c1", "c2").agg(F.first("content").alias("content"), F.first("n").alias("n"), F.count(F.lit(1)).alias("weight"), F.min(own).alias("owner"))
    merged = stored(merged.select("key", "c1", "c2", "content", "n", "weight", *[F.col(f"owner.{c}").alias(f"own_{c}") for c in ("low", "h1", "h2", "first")]), "merged")
    large = stored(merged.groupBy("key").agg(F.count(F.lit(1)).alias("different")).filter(F.col("different") > group).select("key"), "large")
    some_large = bool(large.head(1))
    small = merged.join(large, "key", "left_anti") if some_large else merged
    solved = small.repartition("key").sortWithinPartitions("key").mapInArrow(lambda batches: _solved(batches, solve, keep_first), "c1 bigint, c2 bigint, low int, high int, first boolean")
    steps = []
    if some_large:
        solved = solved.unionByName(_by_whole_windows(merged.join(large, "key"), units, steps))
    solved = stored(solved.groupBy("c1", "c2").agg(F.collect_list(F.struct("low", "high", "first")).alias("ranges")), "solved")  # of one record, so few
    spans = found.join(solved, ["c1", "c2"])
    if keep_first:
        owners = merged.select("c1", "c2", "own_h1", "own_h2", "own_first")
        is_owner = (F.col("h1") == F.col("own_h1")) & (F.col("h2") == F.col("own_h2")) & (F.col("first") == F.col("own_first"))
        spans = spans.join(owners, ["c1", "c2"]).withColumn("ranges", F.when(is_owner, F.filter("ranges", lambda r: ~r["first"])).otherwise(F.col("ranges")))
    spans = stored(spans.groupBy("h1", "h2").agg(F.collect_list(F.struct("first", "ranges")).alias("found")), "spans")
    dropped(found, merged, large, solved, *steps)
    return classes.join(spans, ["h1", "h2"], "left").select("h1", "h2", "n", "low", "text", "found")


def _by_whole_windows(large: DataFrame, units: Units, steps: list[DataFrame]) -> DataFrame:
    """Merged records of large groups -> repeated windows (c1, c2, low, high, first): the
    prefix is the whole window, so equal prefixes are one node.  Tables go to ``steps``."""

    def digests(batches):
        for batch in batches:
            counts = _column(batch, "n").to_numpy()
            w = [_halves_of(hashlib.blake2b(x, digest_size=16).digest()) for content, n in zip(_text(batch, "content"), counts.tolist(), strict=True) for x in units.windows(content, n)]
            take = pa.array(np.repeat(np.arange(len(counts)), counts))
            at = np.arange(len(w)) - np.repeat(np.cumsum(counts) - counts, counts)
            halves = np.array(w, np.int64).reshape(-1, 2)
            yield pa.record_batch({"w1": pa.array(halves[:, 0]), "w2": pa.array(halves[:, 1]), "at": pa.array(at.astype(np.int32))} | {c: _column(batch, c).take(take) for c in ("c1", "c2", "weight")})

    def contents(batches):
        for batch in batches:
            places = _column(batch, "places").to_pylist()
            found = []
            for content, own in zip(_text(batch, "content"), places, strict=True):
                whole = units.windows(content, max(own) + 1)
                found += [whole[i] for i in own]
            take = pa.array(np.repeat(np.arange(len(places)), list(map(len, places))))
            yield pa.record_batch({"window": pa.array(found, pa.binary()), "at": pa.array([i for own in places for i in own], pa.int32())} | {c: _column(batch, c).take(take) for c in ("c1", "c2", "weight", *OWNER)})

    each = stored(large.mapInArrow(digests, "w1 bigint, w2 bigint, at int, c1 bigint, c2 bigint, weight bigint"), "digests")
    twice = stored(each.groupBy("w1", "w2").agg(F.sum("weight").alias("c")).filter("c > 1").select("w1", "w2"), "twice")
    places = stored(each.join(twice, ["w1", "w2"]).groupBy("c1", "c2").agg(F.collect_list("at").alias("places")), "places")
    rows = large.join(places, ["c1", "c2"])
    rows = stored(rows.mapInArrow(contents, "window binary, at int, c1 bigint, c2 bigint, weight bigint, " + ", ".join(f"{c} {'int' if c == 'own_first' else 'bigint'}" for c in OWNER)), "windows")
    place = F.struct(*OWNER[:3], (F.col("own_first") + F.col("at")).alias("at"))
    same = stored(rows.groupBy("window").agg(F.sum("weight").alias("c"), F.min(place).alias("best")).filter("c > 1").select("window", "best"), "same")
    steps += [each, twice, places, rows, same]
    return rows.join(same, "window").select("c1", "c2", F.col("at").alias("low"), (F.col("at") + 1).alias("high"), (place == F.col("best")).alias("first"))


def halves(text):
    """Two longs of a text's SHA-256, which stand for the text."""
    digest = F.sha2(text.cast("binary"), 256)
    return tuple(F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint") for at in (1, 17))


OWNER = ("own_low", "own_h1", "own_h2", "own_first")
RECORD = {"h1": pa.int64(), "h2": pa.int64(), "low": pa.int64(), "key": pa.int64(), "c1": pa.int64(), "c2": pa.int64(), "first": pa.int32(), "n": pa.int32(), "content": pa.binary()}


def _records(out: dict) -> pa.RecordBatch:
    return pa.record_batch({c: pa.array(out[c], t) for c, t in RECORD.items()})


def _solved(batches, solve: Callable, keep_first: bool):
    """Merged records sorted by key, in portions of whole groups -> ranges of repeated
    windows, cut where ``first`` changes: whether the record's owner has the first of all
    occurrences (told only with ``keep_first``).  ``solve(contents, counts)`` gives for each
    of the ``counts`` windows of each record the number of its node, or -1 if these records
    have it once."""

    def out(tables):
        t = pa.Table.from_batches(tables)
        key, counts, weights, low, h1, h2, first = (t[c].to_numpy() for c in ("key", "n", "weight", *OWNER))
        contents = t["content"].to_pylist()
        made, at = [], 0
        while at < len(key):
            size, end = 0, at
            while end < len(key) and (size < ENGINE_BYTES or key[end] == key[end - 1]):
                size += len(contents[end])
                end += 1
            n = counts[at:end]
            node = np.concatenate(solve(contents[at:end], n))
            record = np.repeat(np.arange(at, end), n)
            offset = np.arange(len(record)) - np.repeat(np.cumsum(n) - n, n)
            state = ((node >= 0) | (weights[record] > 1)).astype(np.int8)
            if keep_first:
                rank = np.unique(np.stack((low[at:end], h1[at:end], h2[at:end]), 1), axis=0, return_inverse=True)[1].ravel()
                order = np.lexsort((first[record] + offset, rank[record - at], node))
                leads = np.zeros(len(node), bool)
                leads[order[np.concatenate(([True], node[order[1:]] != node[order[:-1]]))]] = True
                state[(state > 0) & (leads | (node < 0))] = 2
            edge = np.flatnonzero(np.concatenate(([True], (state[1:] != state[:-1]) | (record[1:] != record[:-1]))))
            length = np.diff(np.concatenate((edge, [len(node)])))
            used = state[edge] > 0
            made.append((record[edge][used], offset[edge][used], (offset[edge] + length)[used], state[edge][used] == 2))
            at = end
        which, begin, stop, lead = (np.concatenate(x) for x in zip(*made, strict=True))
        take = pa.array(which)
        return pa.record_batch({"c1": t["c1"].combine_chunks().take(take), "c2": t["c2"].combine_chunks().take(take), "low": pa.array(begin.astype(np.int32)), "high": pa.array(stop.astype(np.int32)), "first": pa.array(lead)})

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index("key")).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if held and size > ENGINE_BYTES and cut:
            yield out([*held, batch.slice(0, cut)])
            held, size = [], 0
            batch = batch.slice(cut)
        held.append(batch)
        size += batch.nbytes
    if held:
        yield out(held)


def covered(found: list[dict] | None, copies: int, n_units: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of removed units.  found: records of the
    text with their ranges of repeated windows, in any order."""
    if copies > 1 and n_units >= window:
        return np.array([0]), np.array([n_units])
    pairs = [(r["first"] + x["low"], r["first"] + x["high"]) for r in found or () for x in r["ranges"]]
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.zeros(n_units + 1, np.int64)
    low, high = np.array(pairs, np.int64).T
    np.add.at(edges, low, 1)
    np.add.at(edges, high + window - 1, -1)
    edge = np.diff(np.concatenate(([0], (np.cumsum(edges)[:-1] > 0).astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def by_document(docs: DataFrame, per_text: DataFrame) -> DataFrame:
    """Deals what holds for a text to the documents (doc_id, text) that have it."""
    h1, h2 = halves(F.coalesce(docs["text"], F.lit("")))
    return docs.select("doc_id", h1.alias("h1"), h2.alias("h2")).join(per_text, ["h1", "h2"])


def own_columns(docs: DataFrame) -> DataFrame:
    return chosen(docs, doc_id="doc_id", text="text")
