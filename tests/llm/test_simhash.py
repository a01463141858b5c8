from collections import defaultdict

import numpy as np
import pytest
import xxhash

from marlstone.llm import simhash

from .helpers import corpus, frame


def slow_fingerprint(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return [min(least[root(i)], default=None) for i in range(len(rows))]


def test_against_brute_force(spark):
    rows = corpus()
    made = simhash.near_duplicates(frame(spark, rows, extra=True)).collect()
    fps = [(r[0], slow_fingerprint(r[1])) for r in rows]
    expected = sorted(map(str, ((i, f"{fp:016x}", c) for (i, fp), c in zip(fps, slow_components(fps), strict=True))))
    assert sorted(str(tuple(r)) for r in made) == expected


@pytest.mark.parametrize(("limit", "rows"), [(8192, 10_000), (3, 10_000), (3, 7), (1, 5)])
def test_links_keep_components(spark, limit, rows):
    """However small the groups that are compared, and however few rows come at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    rng = np.random.default_rng(5)
    fps = [0, 2**63, 2**64 - 1]
    for _ in range(6):
        x = int(rng.integers(0, 2**63))
        for _ in range(12):
            fps.append(x)
            for b in rng.integers(0, 64, rng.integers(1, 6)):
                x ^= 1 << int(b)
    fps = sorted(set(fps))
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    try:
        forest = simhash.links(df, limit=limit)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    roots = dict(map(tuple, simhash.components(forest).collect()))
    mine = [roots.get(x, x) for x in signed]
    theirs = slow_components(list(enumerate(fps)))
    assert len(set(zip(mine, theirs, strict=True))) == len(set(mine)) == len(set(theirs))


def test_more_shingles_than_are_counted_at_a_time():
    text = " ".join(f"w{i % 977}x{i % 89}" for i in range(140_000))
    assert simhash.fingerprint_of(text) == slow_fingerprint(text)


def test_a_forest_that_forgets_loses_nothing(monkeypatch):
    """Links over again are harmless; none is missing."""
    monkeypatch.setattr(simhash, "FOREST", 3)
    forest, up = simhash.Forest(), list(range(40))
    pairs = [(i, j) for i in range(40) for j in range(i) if (i * j) % 7 == 0]
    root = lambda i: i if up[i] == i else root(up[i])
    for a, b in pairs:
        if forest.joins(a, b):
            up[max(root(a), root(b))] = min(root(a), root(b))
    assert all(root(a) == root(b) for a, b in pairs)


def test_keep_one_and_empty(spark):
    rows = corpus()
    df = frame(spark, rows, extra=True)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    fps = [(r[0], slow_fingerprint(r[1])) for r in rows]
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted({c for c in slow_components(fps) if c is not None})
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0
