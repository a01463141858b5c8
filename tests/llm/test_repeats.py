import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from marlstone.llm import repeats, suffixarray, suffixtree

from .helpers import corpus, frame


def marks(units, seen, window):
    out = [False] * len(units)
    for i in range(len(units) - window + 1):
        if seen[tuple(units[i : i + window])] > 1:
            out[i : i + window] = [True] * window
    return out


def brute(rows, split, join, window):
    texts = [split((r[1] or "").encode()) for r in rows]
    seen = Counter(tuple(t[i : i + window]) for t in texts for i in range(len(t) - window + 1))
    for r, t in zip(rows, texts, strict=True):
        m = marks(t, seen, window)
        spans = sum(b and not a for a, b in zip([False, *m], m, strict=False))
        yield r[0], len(t), sum(m), spans, hashlib.sha256(join([x for x, y in zip(t, m, strict=True) if not y])).hexdigest()


@pytest.mark.parametrize(("window", "gram", "group"), [(6, 2, 4096), (5, 3, 2), (35, 10, 4096)])
def test_words(spark, window, gram, group):
    rows = corpus(window, n=60)
    made = suffixtree.deduplicated(frame(spark, rows, extra=True), window, gram, group=group).collect()
    want = [(str(i), n, m, h) for i, n, m, _, h in brute(rows, bytes.split, b" ".join, window)]
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in made) == sorted(want)
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in made)
    assert any(0 < r[2] < r[1] for r in made)


@pytest.mark.parametrize(("window", "gram", "group"), [(20, 6, 4096), (25, 10, 2), (200, 40, 4096)])
def test_bytes(spark, window, gram, group):
    rows = corpus(window, n=60)
    df = frame(spark, rows, extra=True)
    made = suffixarray.deduplicated(df, window, gram, group=group).collect()
    want = [tuple(map(str, r)) for r in brute(rows, list, bytes, window)]
    assert sorted(tuple(map(str, r)) for r in made) == sorted(want)
    kept = suffixarray.without_repeats(df, window, gram, group=group)
    assert kept.columns == df.columns and kept.count() == len(rows)
    assert kept.filter("text is null").count() == sum(r[1] is None for r in rows)


def test_repeats_inside_one_text(spark):
    """A text that alone repeats a window, nearer than the gram positions of a window."""
    rng = random.Random(4)
    rows = []
    for i in range(12):
        part = "".join(rng.choice("abcdefgh") for _ in range(30 + i))
        rows.append((i, part + part + "".join(rng.choice("abcdefgh") for _ in range(40)), "en", "s", 1))
    rows += [(100 + i, " ".join([f"u{i}x{j}" for j in range(8 + i)] * 2), "en", "s", 1) for i in range(5)]
    df = frame(spark, rows)
    got = sorted(tuple(map(str, r)) for r in suffixarray.deduplicated(df, 25, 5).collect())
    assert got == sorted(tuple(map(str, r)) for r in brute(rows, list, bytes, 25))
    words = sorted((r[0], r[1], r[2], r[3]) for r in suffixtree.deduplicated(df, 7, 2).collect())
    assert words == sorted((i, n, m, h) for i, n, m, _, h in brute(rows, bytes.split, b" ".join, 7))
    assert any(r[2] for r in words)


def test_engines_on_random_strings():
    rng = random.Random(3)
    for _ in range(40):
        window, letters = rng.choice([(8, "ab"), (9, "abc"), (13, "ab")])
        contents = ["".join(rng.choice(letters) for _ in range(rng.randrange(window, 60))).encode() for _ in range(rng.randrange(1, 8))]
        counts = np.array([len(c) - window + 1 for c in contents])
        seen = Counter(c[i : i + window] for c in contents for i in range(len(c) - window + 1))
        want = [[seen[c[i : i + window]] > 1 for i in range(n)] for c, n in zip(contents, counts.tolist(), strict=True)]
        many = lambda nodes: [(x >= 0).tolist() for x in nodes]
        spaced = [b" ".join(bytes([x]) for x in c) for c in contents]
        for nodes in (suffixarray.solve(contents, counts, window), suffixtree.solve(spaced, counts, window, limit=rng.choice([2, 5, 1000]))):
            assert many(nodes) == want
            flat = [(n, c[i : i + window]) for x, c in zip(nodes, contents, strict=True) for i, n in enumerate(x.tolist()) if n >= 0]
            assert len(set(flat)) == len({n for n, _ in flat}) == len({w for _, w in flat})  # a node for each repeated window


def test_subtrees_against_brute_force():
    """Internal nodes of every depth, and maximal repeats, worked out from all substrings."""
    rng = random.Random(6)
    depths = set()
    for _ in range(60):
        texts = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(rng.randrange(1, 5))]
        ids = np.array([x for t in texts for x in t], np.int64)
        offsets = np.cumsum([0, *map(len, texts)])
        ends = np.repeat(offsets[1:], np.diff(offsets))
        trees = suffixtree.Subtrees(ids, np.arange(len(ids)), ends)
        found = trees.nodes()
        places, after, front = {}, {}, {}  # of each substring: where it starts, what follows it, and what it follows
        for t, o in zip(texts, offsets.tolist(), strict=False):
            for i in range(len(t)):
                for j in range(i + 1, len(t) + 1):
                    sub = tuple(t[i:j])
                    places.setdefault(sub, set()).add(o + i)
                    after.setdefault(sub, set()).add(t[j] if j < len(t) else ("end", o))
                    front.setdefault(sub, set()).add(t[i - 1] if i else ("start", o))
        want = {(len(x), tuple(sorted(p))) for x, p in places.items() if len(p) > 1 and len(after[x]) > 1}
        leaves = lambda n: tuple(sorted(trees.leaves[n[1] : n[2] + 1].tolist()))
        assert {(int(n[0]), leaves(n)) for n in found} == want and len(found) == len(want)
        depths |= {d for d, _ in want}
        before = np.concatenate(([0], ids[:-1]))
        before[offsets[:-1]] = -1 - np.arange(len(texts))
        maximal = trees.maximal(found, before[trees.leaves])
        assert {(int(n[0]), leaves(n)) for n in maximal} == {(len(x), tuple(sorted(p))) for x, p in places.items() if len(p) > 1 and len(after[x]) > 1 and len(front[x]) > 1}
        for least in (2, 4):
            deep = trees.nodes(least)
            assert {tuple(n) for n in deep.tolist()} == {tuple(n) for n in found.tolist() if n[0] >= least}
            top = suffixtree.topmost(deep)
            assert sorted(x for n in top for x in leaves(n)) == sorted({x for n in deep for x in leaves(n)})
    assert len(depths) > 5


def test_prefixes_split_ordinary_text():
    """Prefixes are as long as they must be, and no longer."""
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 6000) % 500
    parts = list(suffixtree.prefix_groups(ids, np.arange(5900), 10, limit=40))
    assert sorted(np.concatenate([p for _, p in parts]).tolist()) == list(range(5900))
    assert len([1 for _, p in parts if len(p)]) > 2
    size = lambda s, k: Counter(tuple(ids[i : i + k]) for i in range(5900))[tuple(ids[s : s + k])]
    for length, part in parts:
        for s in part[::37].tolist():
            assert (size(s, length) <= 40 or length == 10) and (length == 1 or size(s, length - 1) > 40)


def thue_morse(n, flip):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


@pytest.mark.parametrize("group", [4096, 1])
def test_words_that_hash_alike(spark, group):
    """Two words whose polynomial hashes clash modulo 2^64, in otherwise equal windows."""
    rest = [f"w{i}" for i in range(34)]
    rows = [(i, " ".join([*rest[:17], thue_morse(4096, i), *rest[17:]]), "en", "s", 1) for i in range(2)]
    assert len({int(repeats.sums(np.frombuffer(thue_morse(4096, i).encode(), np.uint8) + np.uint8(1))[-1]) for i in range(2)}) == 1
    assert [r["n_removed"] for r in suffixtree.deduplicated(frame(spark, rows), group=group).collect()] == [0, 0]
    rows += [(2, rows[0][1] + " more", "en", "s", 1)]
    assert sorted((r[0], r["n_removed"]) for r in suffixtree.deduplicated(frame(spark, rows), group=group).collect()) == [(0, 35), (1, 0), (2, 35)]


def test_longer_than_a_chunk(spark, monkeypatch):
    """Texts, and words, longer than what is hashed at a time."""
    monkeypatch.setattr(repeats, "CHUNK", 256)
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["a", "b", "c" * 600, "d" * 299]) for _ in range(90)), "en", "s", 1) for i in range(6)]
    assert sorted((r[0], r[1], r[2], r[3]) for r in suffixtree.deduplicated(frame(spark, rows), 5, 2).collect()) == sorted((i, n, m, h) for i, n, m, _, h in brute(rows, bytes.split, b" ".join, 5))
    units = repeats.Units(5, 2, words=True)
    assert len(units.split(rows[0][1].encode())[0]) == 90


@pytest.mark.parametrize("group", [4096, 2])
def test_first_occurrence_stays(spark, group):
    rows = [r for r in corpus(25, n=60) if r[0] is not None]
    rows = [*dict.fromkeys(rows)]
    rng = random.Random(3)
    rng.shuffle(rows)
    seen, want = set(), {}
    texts = sorted((i, (t or "").encode()) for i, t, *_ in rows)
    for i, t in texts:
        m = [False] * len(t)
        for k in range(len(t) - 24):
            w = t[k : k + 25]
            if w in seen:
                m[k : k + 25] = [True] * 25
            seen.add(w)
        want[i] = bytes(x for x, y in zip(t, m, strict=True) if not y).decode(errors="ignore")
    got = suffixarray.without_repeats(frame(spark, rows, extra=True), 25, 10, group=group, keep_first=True).collect()
    assert {r["doc_id"]: r["text"] or "" for r in got} == want
    assert sum(map(len, want.values())) < sum(len(t) for _, t in texts)


def test_keys_depend_on_windows_alone():
    rng = np.random.default_rng(0)
    units = repeats.Units(50, 12, words=False)
    a = rng.integers(97, 100, 400).astype(np.uint8)
    b = np.concatenate((rng.integers(97, 100, 77).astype(np.uint8), a))
    per_window = lambda x: np.concatenate([np.full(e - f, k) for k, f, e in zip(*units.runs(x), strict=True)])
    assert (per_window(a) == per_window(b)[77:]).all()
    x = rng.integers(0, 2**63, 100).astype(np.uint64)
    for w in (1, 3, 50, 100):
        assert (repeats.sliding_min(x, w) == [x[i : i + w].min() for i in range(101 - w)]).all()


def test_empty_table(spark):
    df = frame(spark, corpus()).limit(0)
    assert suffixtree.deduplicated(df).count() == 0
    assert suffixarray.deduplicated(df).count() == 0
    assert suffixarray.without_repeats(df).count() == 0
