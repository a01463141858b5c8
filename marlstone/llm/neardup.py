"""Near copies of a given similarity: SimHash links and min-hash bands, then shared rare
shingles for whatever these leave out; each link is verified.

SimHash links (operator 5) find texts that differ in few bits of 64.  Texts whose sets of
five-word shingles have a Jaccard similarity of 0.8 mostly differ in more, at which no segment
of a fingerprint is long enough to be a key and yet short enough to be equal up to one bit.  So
candidates also come from min-hash bands, another method: each shingle's hash falls into one of
``BINS`` bins, a bin's least value is one min-hash, and ``ROWS`` of them make a band.  A pair at
0.8 shares one of the ``BANDS`` bands with a probability of 0.998.

Texts are first merged if their words are equal.  Of the texts that share a band, leaders are
picked as the rows stream by: a text is compared with the leaders before it by a byte of each
min-hash, meets the one that is most like it, if that looks like ``MEET`` or more, and leads
itself unless it looks like ``SAME``; so n near copies give n meetings for each band at most.
A band that many texts share is dealt into parts of some ``PART`` texts, whose leaders then
meet.  (Of leaders of one band that are all unlike each other each is compared with each, but
by 128 bytes in memory.)  Each meeting is
verified on the texts: only pairs of similarity ``SIMILAR`` or more link, and components of
links are groups.

So far that is likely to find a pair, not sure to.  What two groups may still have in common is
found exactly (``between``).  All shingles have one order, by hash, with the commonest ones last.
Two sets of a similarity of 0.8 share a shingle among the first fifth of the larger one and the
first ninth of the smaller one (prefix filter), so texts meet by those.  Only keys that texts of
two groups share go on.  If both prefixes are longer by a twentieth of their texts, similar texts
share as much more in them: a text with fewer keys that another group has too is like none of it
(``needed``), so texts that have no more than some passages in common never meet, however many do.
Of the pairs of the others those go that differ in too many bits of a parity bitmap,
as each differing bit is a differing shingle.  The rest is verified: first one pair of each two
groups, then all pairs whose groups are still apart.  A key of more than ``BLOCK`` texts is
worked through in pairs of blocks.  Which shingles count as common changes the cost alone.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; a text of fewer than five is one shingle.

Defined results: null, empty and blank texts have no words and are copies of each other; the
row with the smallest id of a group stays, null last, ties by a hash of the text; of rows
equal in id and text one stays; an empty table gives no rows; other columns are passed
through and never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chosen, dropped, stored
from .simhash import DISTANCE, SEED, components, links

#: Words of a shingle, and the least similarity of a link as a fraction.
WIDTH, SIMILAR = 5, (4, 5)
BINS, ROWS, BANDS = 128, 4, 12
#: Bins of 128 in which two texts must agree to meet, and to count as the same without a leader of their own.
MEET, SAME = 83, 115
#: Texts of a band that one part has, about.
PART = 4096
#: Bits of a parity bitmap; texts of a key in one block, about.
BITS, BLOCK = 1024, 2048
#: A text is counted by one in so many of its shingles beyond its prefix.
SLACK = 20
#: Texts of an Arrow batch in which a shingle is common, and how many such are told by a batch and kept in all.
OFTEN, TOLD, COMMON = 8, 4096, 65_536
#: Shingles that a task holds at once, about.
CHUNK = 1 << 20
_EMPTY = np.uint64(2**64 - 1)


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The hashes of a text's shingles, repeats included: each word's XXH64 times an odd number
    for its place, added up and mixed."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    made = np.zeros(n, np.uint64)
    for i in range(min(width, len(words))):
        made += hashed[i : i + n] * np.uint64(xxhash.xxh64_intdigest(b"%d" % i, SEED) | 1)
    made ^= made >> np.uint64(32)
    made *= np.uint64(0xBF58476D1CE4E5B9)
    return made ^ made >> np.uint64(29)


def min_hashes(hashes: np.ndarray) -> np.ndarray:
    """The least value in each bin; an empty bin takes that of the next one that isn't,
    changed by how far that is."""
    least = np.full(BINS, _EMPTY)
    kind = (hashes % np.uint64(BINS)).astype(np.int64)
    np.minimum.at(least, kind, hashes // np.uint64(BINS))
    full = np.flatnonzero(least != _EMPTY)
    empty = np.flatnonzero(least == _EMPTY)
    if len(empty):
        donor = full[np.searchsorted(full, empty) % len(full)]
        least[empty] = least[donor] + ((donor - empty) % BINS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return least


def fingerprint(hashes: np.ndarray) -> int:
    """The fingerprint of these shingles, as operator 5 makes it."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        counts += np.unpackbits(hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist()))


def similar(a: bytes, b: bytes, width: int = WIDTH, least: tuple[int, int] = SIMILAR) -> bool:
    """Whether two texts' sets of shingles are as similar as that."""
    return matching(np.unique(shingles(a, width)), np.unique(shingles(b, width)), least)


def matching(x: np.ndarray, y: np.ndarray, least: tuple[int, int] = SIMILAR) -> bool:
    """Whether two sets are as similar as that."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both * least[1] >= (len(x) + len(y) - both) * least[0]


def parity(own: np.ndarray) -> bytes:
    """For each bit whether an odd number of these distinct shingles fall on it."""
    at = (own >> np.uint64(17)) % np.uint64(BITS)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=BITS).astype(np.uint8) & 1).tobytes()


def ordered(own: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Distinct sorted shingles in the order that all texts share: the common ones (sorted, with
    their ranks) last."""
    if not len(common):
        return own
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    late = common[at] == own
    return np.concatenate((own[~late], own[late][np.argsort(rank[at[late]])]))


def prefixes(n: int, least: tuple[int, int] = SIMILAR) -> tuple[int, int]:
    """How many of the first of n shingles a text shares one with any similar text that is no
    larger, and with any that is no smaller."""
    part, of = least
    return n + 1 + -n * part // of, n + 1 + -2 * n * part // (part + of)


def slack(n: int) -> int:
    """By how many shingles more than its prefix a text is counted."""
    return n // SLACK


def needed(n: int, least: tuple[int, int] = SIMILAR) -> int:
    """How many of its counted shingles a text of n shares at least with any similar one.  Let
    that be of m <= n, so that they share 4/9 (n + m) in all, which is no less than 4/5 n and
    8/9 m.  Whichever counted part ends first, all that both have up to there is in both
    parts, and after it come no more than 4/5 of its text less 1 and the slack.  So the parts
    share 1 + slack(m) or more, and m is 4/5 n at least."""
    part, of = least
    return 1 + slack(-(-n * part // of))


def frequent(sets: dict[bytes, np.ndarray]) -> list[dict]:
    """The shingles that many of these sets have, with the number of those."""
    if not sets:
        return []
    keys, counts = np.unique(np.concatenate(list(sets.values())), return_counts=True)
    often = np.flatnonzero(counts >= OFTEN)
    often = often[np.argsort(-counts[often], kind="stable")[:TOLD]]
    return [{"key": k, "n": n} for k, n in zip(keys[often].view(np.int64).tolist(), counts[often].tolist(), strict=True)]


_SIGNED = lambda x: int(x) - (1 << 64) if x >= 1 << 63 else int(x)


def signs(text: Column, width: int = WIDTH) -> Column:
    """``struct<d1, d2, fp, sketch, bands>``: a digest of the words, operator 5's fingerprint, a
    byte of each min-hash, the bands' keys, and a parity bitmap; of a text without words the
    digest only.  The first row of an Arrow batch also tells which shingles are common among its texts."""

    @F.arrow_udf("struct<d1:bigint,d2:bigint,fp:bigint,sketch:binary,bands:array<bigint>,bits:binary,common:array<struct<key:bigint,n:int>>>")
    def run(texts: pa.Array) -> pa.Array:
        made: dict[str, list] = {"d1": [], "d2": [], "fp": [], "sketch": [], "bands": [], "bits": []}
        sets: dict[bytes, np.ndarray] = {}
        common: list[dict] = []
        held = 0
        for x in texts.cast(pa.binary()):
            data = x.as_buffer().to_pybytes() if x.is_valid else b""
            digest = hashlib.blake2b(b" ".join(data.lower().split()), digest_size=16).digest()
            hashes = shingles(data, width)
            least = min_hashes(hashes) if len(hashes) else None
            own = np.unique(hashes)
            made["bits"].append(None if least is None else parity(own))
            if digest not in sets:
                sets[digest] = own
                held += len(own)
                if held >= CHUNK:
                    common += frequent(sets)
                    sets, held = {}, 0
            made["d1"].append(int.from_bytes(digest[:8], "little", signed=True))
            made["d2"].append(int.from_bytes(digest[8:], "little", signed=True))
            made["fp"].append(None if least is None else _SIGNED(fingerprint(hashes)))
            made["sketch"].append(None if least is None else (least & np.uint64(255)).astype(np.uint8).tobytes())
            made["bands"].append([] if least is None else [_SIGNED(xxhash.xxh64_intdigest(least[i * ROWS : (i + 1) * ROWS].tobytes(), i)) for i in range(BANDS)])
        common += frequent(sets)
        made["common"] = [common if i == 0 else [] for i in range(len(texts))]
        kinds = {"d1": pa.int64(), "d2": pa.int64(), "fp": pa.int64(), "sketch": pa.binary(), "bands": pa.list_(pa.int64()), "bits": pa.binary(), "common": pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int32())]))}
        return pa.StructArray.from_arrays([pa.array(made[k], kind) for k, kind in kinds.items()], list(kinds))

    return run(text)


def _led(batches):
    """Of rows (key, part, id, sketch) sorted by key and part: meetings (a, b), and the leaders of
    each group (key, a, sketch)."""
    group, ids, leaders, n = None, [], np.zeros((16, BINS), np.uint8), 0
    for batch in batches:
        out: dict[str, list] = {"key": [], "a": [], "b": [], "sketch": []}

        def emit(key, a, b, sketch, out=out):
            for k, v in zip(out, (key, a, b, sketch), strict=True):
                out[k].append(v)

        for key, part, own, sketch in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (key, part) != group:
                group, ids, n = (key, part), [], 0
            row = np.frombuffer(sketch, np.uint8)
            agree = np.count_nonzero(leaders[:n] == row, axis=1)
            best = int(agree.argmax()) if n else -1
            if n and agree[best] >= MEET and ids[best] != own:
                emit(None, own, ids[best], None)
            if not n or agree[best] < SAME:
                if n == len(leaders):
                    leaders = np.concatenate((leaders, np.zeros_like(leaders)))
                leaders[n] = row
                ids.append(own)
                n += 1
                emit(key, own, None, sketch)
        yield pa.record_batch({"key": pa.array(out["key"], pa.int64()), "a": pa.array(out["a"], pa.string()), "b": pa.array(out["b"], pa.string()), "sketch": pa.array(out["sketch"], pa.binary())})


_LED = "key bigint, a string, b string, sketch binary"


def meetings(distinct: DataFrame) -> DataFrame:
    """Pairs (a > b) of distinct texts (id, fp, sketch, bands) that may be similar."""
    keys = distinct.select("id", F.explode("bands").alias("key"))
    shared = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "bands")
    held = stored(keys.join(shared, "key"), "held")
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / PART)).alias("part")
    rows = held.select("id", "key", part).join(distinct.select("id", "sketch").hint("merge"), "id").select("key", "part", "id", "sketch")
    first = stored(rows.repartition("key", "part").sortWithinPartitions("key", "part", "id").mapInArrow(_led, _LED), "led")
    many = shared.filter(F.col("n") > PART).select("key")
    again = first.filter("b is null").join(many, "key", "left_semi").select("key", F.lit(0).alias("part"), F.col("a").alias("id"), "sketch")
    second = again.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_led, _LED)
    fps = distinct.filter("fp is not null").groupBy("fp").agg(F.min("id").alias("low"))
    alike = distinct.join(fps, "fp").filter("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b"))
    near = links(fps.select("fp"), DISTANCE).join(fps.select(F.col("fp").alias("a"), F.col("low").alias("x")), "a").join(fps.select(F.col("fp").alias("b"), F.col("low").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    met = [x.filter("b is not null").select("a", "b") for x in (first, second)]
    whole = met[0].unionByName(met[1]).unionByName(alike).unionByName(near)
    pairs = stored(whole.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "meetings")
    dropped(shared, held, first)
    return pairs


def verified(pairs: DataFrame, texts: DataFrame, width: int = WIDTH, least: tuple[int, int] = SIMILAR) -> DataFrame:
    """The pairs (a, b) whose texts (id, text) are similar."""

    def run(batches):
        name, own = None, None  # rows come by b, whose shingles are worked out once
        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            keep = []
            for p, q, now in zip(x, y, b.to_pylist(), strict=True):
                if now != name:
                    name, own = now, np.unique(shingles((q.as_py() or "").encode(), width))
                keep.append(matching(np.unique(shingles((p.as_py() or "").encode(), width)), own, least))
            yield pa.record_batch({"a": a.filter(pa.array(keep, pa.bool_())), "b": b.filter(pa.array(keep, pa.bool_()))})

    one = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")).hint("merge"), "a")
    both = one.join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")).hint("merge"), "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a string, b string")


def _fronts(common: np.ndarray, rank: np.ndarray, width: int, least: tuple[int, int]):
    """Texts -> their first shingles (key, d1, d2, n, level): n is the text's number of shingles;
    keys of level 0 are looked for by all texts, of level 1 by no larger ones, of level 2 by none
    (they are counted)."""

    def run(batches):
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            rows = 0
            for x in batch.column(0).cast(pa.binary()):
                data = x.as_buffer().to_pybytes() if x.is_valid else b""
                own = ordered(np.unique(shingles(data, width)), common, rank)
                if not len(own):
                    continue
                digest = np.frombuffer(hashlib.blake2b(b" ".join(data.lower().split()), digest_size=16).digest(), "<i8")
                larger, smaller = prefixes(len(own), least)
                n = larger + slack(len(own))
                level = np.full(n, 2, np.int8)
                level[:larger] = 1
                level[:smaller] = 0
                for kind, values in zip(out, (own[:n].view(np.int64), np.full(n, digest[0]), np.full(n, digest[1]), np.full(n, len(own)), level), strict=True):
                    kind.append(values)
                rows += n
                if rows >= CHUNK:
                    yield _numbers(out)
                    out, rows = [[], [], [], [], []], 0
            yield _numbers(out)

    return run


def _numbers(out: list[list[np.ndarray]]) -> pa.RecordBatch:
    kinds = {"key": np.int64, "d1": np.int64, "d2": np.int64, "n": np.int64, "level": np.int8}
    return pa.record_batch({k: pa.array(np.concatenate(v) if v else np.zeros(0, kinds[k])) for k, v in zip(kinds, out, strict=True)})


def _shared(batches):
    """Of rows sorted by their first column those that share it with another."""
    held, shares = None, False
    for batch in batches:
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not rows.num_rows:
            continue
        keys = rows.column(0).to_numpy()
        same = keys[1:] == keys[:-1]
        keep = np.concatenate((same, [False])) | np.concatenate(([shares], same))
        held, shares = rows.slice(len(keys) - 1), bool(keep[-1])
        yield rows.slice(0, len(keys) - 1).filter(pa.array(keep[:-1], pa.bool_()))
    if shares:
        yield held


def _crossed(least: tuple[int, int]):
    """Rows (key, i, j, part, id, n, level, root, bits) sorted by key, i and j -> pairs of texts of
    different roots that may be similar (a, b, ra, rb, apart), apart being their differing bits."""
    share, of = least

    def met(rows: pa.RecordBatch) -> pa.RecordBatch:
        """Whole groups; each row with the one that comes d later, for all d at once."""
        key, i, j, part, size, level = (rows.column(c).to_numpy() for c in ("key", "i", "j", "part", "n", "level"))
        group = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
        root = rows.column("root").dictionary_encode().indices.to_numpy()
        bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint64).reshape(len(key), -1)
        found, d, x = [], 1, np.flatnonzero(group[1:] == group[:-1])
        while len(x):
            y = x + d
            low, high = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
            fits = (root[x] != root[y]) & (of * low >= share * high) & (np.where(size[y] < size[x], level[y], level[x]) == 0) & ((i[x] == j[x]) | (part[x] != part[y]))
            p, q = x[fits], y[fits]
            apart = np.bitwise_count(bits[p] ^ bits[q]).sum(1, dtype=np.int64)
            fine = apart * (of + share) <= (size[p] + size[q]) * (of - share)
            found.append((p[fine], q[fine], apart[fine]))
            d += 1
            x = x[x + d < len(key)]
            x = x[group[x + d] == group[x]]
        p, q, apart = (np.concatenate(v) for v in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        ids, names = rows.column("id").to_pylist(), rows.column("root").to_pylist()
        out: dict[str, list] = {"a": [], "b": [], "ra": [], "rb": [], "apart": apart.tolist()}
        for x, y in zip(p.tolist(), q.tolist(), strict=True):
            one, other = (x, y) if ids[x] > ids[y] else (y, x)
            for k, v in zip(out, (ids[one], ids[other], names[one], names[other]), strict=False):
                out[k].append(v)
        return _pairs(out)

    def run(batches):
        held = None  # the last group, which may go on
        for batch in batches:
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not rows.num_rows:
                continue
            same = np.ones(rows.num_rows, bool)
            for c in ("key", "i", "j"):
                values = rows.column(c).to_numpy()
                same &= values == values[-1]
            cut = int(same.argmax())
            held = rows.slice(cut)
            if cut:
                yield met(rows.slice(0, cut))
        if held is not None:
            yield met(held)

    return run


def _pairs(out: dict[str, list]) -> pa.RecordBatch:
    return pa.record_batch({k: pa.array(v, pa.int64() if k == "apart" else pa.string()) for k, v in out.items()})


def _needed(n: Column, least: tuple[int, int]) -> Column:
    """``needed`` as a column."""
    return 1 + F.floor(F.ceil(n * least[0] / least[1]) / SLACK)


def between(of: DataFrame, docs: DataFrame, skipped: DataFrame, common: DataFrame, width: int = WIDTH, least: tuple[int, int] = SIMILAR) -> DataFrame:
    """All pairs (a, b, ra, rb, apart) of distinct texts (id, root, bits) of different roots that
    may be similar; none that is gets lost.  ``docs`` (doc_id, h, text) without the rows
    ``skipped`` (doc_id, h) has each text once or more; common (key, n): shingles that come last."""
    last = common.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(COMMON).toPandas()
    keys, sums = last["key"].to_numpy(np.int64).view(np.uint64), last["n"].to_numpy(np.int64)
    rank = np.argsort(np.lexsort((keys, sums)))
    by_key = np.argsort(keys)
    skip = skipped.toDF("no_id", "no_h")
    texts = docs.join(skip, docs["doc_id"].eqNullSafe(skip["no_id"]) & (docs["h"] == skip["no_h"]), "left_anti").select("text")
    rows = "key bigint, d1 bigint, d2 bigint, n bigint, level tinyint"
    fronts = texts.mapInArrow(_fronts(keys[by_key], rank[by_key], width, least), rows)
    shared = fronts.repartition("key").sortWithinPartitions("key").mapInArrow(_shared, rows)
    shared = stored(shared.select("key", F.concat(*[F.lpad(F.hex(d), 16, "0") for d in ("d1", "d2")]).alias("id"), "n", "level"), "fronts")
    tagged = stored(shared.join(of.select("id", "root"), "id"), "tagged")
    across = tagged.join(tagged.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("other")).filter("one <> other").select("key"), "key")
    enough = across.groupBy("id").agg(F.count(F.lit(1)).alias("keys"), F.any_value("n").alias("n")).filter(F.col("keys") >= _needed(F.col("n"), least)).select("id")
    looked = stored(tagged.filter("level < 2").join(enough, "id"), "looked")
    mixed = looked.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("root").alias("one"), F.max("root").alias("other"), F.min("level").alias("level"))
    mixed = mixed.filter("one <> other and level = 0").select("key", F.ceil(F.col("rows") / BLOCK).alias("parts"))
    held = looked.join(mixed, "key").join(of.select("id", "bits"), "id").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    held = held.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    held = held.select("key", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"), "part", "id", "n", "level", "root", "bits")
    met = held.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_crossed(least), "a string, b string, ra string, rb string, apart bigint")
    made = stored(met.distinct(), "between")
    dropped(shared, tagged, looked)
    return made


def _texts(pairs: DataFrame, distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """id and text of what the pairs name."""
    need = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    owners = distinct.join(need, "id", "left_semi").select("id", F.col("best.doc_id").alias("own"), F.col("best.h").alias("own_h"))
    found = docs.join(owners, (docs["h"] == F.col("own_h")) & docs["doc_id"].eqNullSafe(F.col("own"))).select("id", "text")
    return stored(found.dropDuplicates(["id"]), "texts")


def _joined(of: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Texts (id, root and others) with the roots that links between roots (a, b) leave."""
    roots = components(links).toDF("root", "least")
    return stored(of.join(roots, "root", "left").withColumn("root", F.coalesce("least", "root")).drop("least"), name)


def grouped(rows: DataFrame, docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """id and root of every distinct text of ``rows`` (doc_id, h and what ``signs`` says) with
    best (the first row: none, doc_id, h) and n, its rows.  ``docs``: doc_id, h, text."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("best")
    distinct = stored(rows.groupBy("id").agg(first, F.count(F.lit(1)).alias("n"), *[F.any_value(k).alias(k) for k in ("fp", "sketch", "bands", "bits")]), "distinct")
    pairs = meetings(distinct)
    texts = _texts(pairs, distinct, docs)
    own = distinct.select("id", "best", "n", "bits", F.col("id").alias("root"))
    of = _joined(own, verified(pairs, texts, width), "groups")
    dropped(pairs, texts)
    copies = rows.join(distinct.filter("n > 1").select("id", F.col("best.doc_id").alias("own"), F.col("best.h").alias("own_h")), "id")
    skipped = copies.filter(~(F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("h") == F.col("own_h")))).select("doc_id", "h").distinct()
    more = between(of, docs, skipped, rows.select(F.explode("common").alias("c")).select("c.*"), width)
    if more.head(1):
        texts = _texts(more, distinct, docs)
        # one pair of each two groups, and then all whose groups are still apart
        likely = more.groupBy("ra", "rb").agg(F.min_by(F.struct("a", "b"), F.struct("apart", "a", "b")).alias("p")).select("ra", "rb", "p.a", "p.b")
        likely = stored(likely, "likely")
        of = _joined(of, verified(likely, texts, width).join(likely, ["a", "b"]).select(F.col("ra").alias("a"), F.col("rb").alias("b")), "groups")
        now = lambda side: of.select(F.col("id").alias(side), F.col("root").alias(f"now_{side}"))
        rest = stored(more.join(likely, ["a", "b"], "left_anti").join(now("a"), "a").join(now("b"), "b").filter("now_a <> now_b").select("a", "b", "now_a", "now_b"), "rest")
        if rest.head(1):
            of = _joined(of, verified(rest.select("a", "b"), texts, width).join(rest, ["a", "b"]).select(F.col("now_a").alias("a"), F.col("now_b").alias("b")), "groups")
        dropped(texts, likely, rest)
    dropped(more, distinct)
    return of


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row of each group of near copies among ``docs`` (doc_id, text and others)."""
    own = chosen(docs, doc_id="doc_id", text="text").select("doc_id", F.xxhash64("text").alias("h"), "text")
    rows = stored(own.select("doc_id", "h", signs(F.col("text"), width).alias("s")).select("doc_id", "h", F.concat(*[F.lpad(F.hex(f"s.{d}"), 16, "0") for d in ("d1", "d2")]).alias("id"), "s.fp", "s.sketch", "s.bands", "s.bits", "s.common"), "signs")
    best = grouped(rows, own, width).groupBy("root").agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    best = stored(best.select(F.col("best.doc_id").alias("marl_id"), F.col("best.h").alias("marl_h"), (F.col("n") > 1).alias("marl_many")), "best")
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("marl_row"), docs["doc_id"].alias("marl_id0"), F.xxhash64(docs["text"]).alias("marl_h0"))
    kept = packed.join(best, F.col("marl_id0").eqNullSafe(F.col("marl_id")) & (F.col("marl_h0") == F.col("marl_h")))
    alone = kept.filter(~F.col("marl_many"))
    repeated = kept.filter("marl_many").dropDuplicates(["marl_id0", "marl_h0"])
    return alone.unionByName(repeated).select("marl_row.*")
