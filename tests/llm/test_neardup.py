"""Groups of near copies against all pairs."""

import random

from marlstone.llm import neardup

from .helpers import corpus, frame


def grams(text, width=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def slow_groups(rows):
    """The smallest id of each row's group, by comparing all pairs; ids are in rising order."""
    sets = [grams(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [rows[root(i)][0] for i in range(len(rows))]


def edited(rng, words, share):
    return [f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def test_groups_against_all_pairs(spark):
    rng, rows, pairs = random.Random(1), [], 0
    for k in range(60):  # copies whose words differ by up to 3 in 100: similarities around 0.8
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 300))]
        rows.append(" ".join(words))
        for _ in range(rng.randrange(4)):
            rows.append(" ".join(edited(rng, words, rng.choice([0.005, 0.015, 0.02, 0.03]))))
    rows += [rows[0].upper().replace("W", "w"), rows[1] + " ", "x" * 3000, None, "", " \n"]
    docs = [(i, t, "en", "s", 1) for i, t in enumerate(rows)]
    want = slow_groups([(i, t) for i, t, *_ in docs])
    sets = [grams(t) for t in rows]
    jaccard = lambda a, b: len(a & b) / max(1, len(a | b))
    pairs = sum(0.8 <= jaccard(sets[i], sets[j]) < 0.9 for i in range(len(rows)) for j in range(i))
    kept = sorted(r["doc_id"] for r in neardup.keep_one(frame(spark, docs)).collect())
    gone, due = set(range(len(rows))) - set(kept), {i for i, w in enumerate(want) if w != i}
    assert pairs > 20 and len(due) > 40
    assert gone <= due  # nothing goes that isn't similar
    assert len(gone) >= 0.9 * len(due)


def test_awkward_rows(spark):
    rows = corpus(3, vocabulary=500)
    df = frame(spark, rows, extra=True)
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    named = list({(r[0], r[1]): r for r in rows if r[0] is not None}.values())
    assert sorted(i for i in ids if i is not None) == sorted(set(slow_groups([(r[0], r[1]) for r in sorted(named, key=lambda r: r[0])])))
    assert ids.count(None) == 1  # the other is a copy of an empty text
    assert neardup.keep_one(df.limit(0)).count() == 0


def test_large_groups_meet_through_their_leaders(spark, monkeypatch):
    """Parts of a few texts each: near copies in different parts still find each other."""
    monkeypatch.setattr(neardup, "PART", 8)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(edited(rng, words, 0.004)), "en", "s", 1) for i in range(150)] + [(1000 + i, " ".join(f"o{rng.randrange(999)}" for _ in range(100)), "en", "s", 1) for i in range(30)]
    kept = sorted(r["doc_id"] for r in neardup.keep_one(frame(spark, rows)).collect())
    assert kept == sorted(set(slow_groups([(r[0], r[1]) for r in rows])))


def near_limit(rng, groups):
    """Short and long texts with copies whose similarities lie just around 0.8."""
    rows = []
    for k in range(groups):
        words = [f"g{k}w{i}" for i in range(rng.choice([9, 13, 20, 40, 80, 160]))]
        rows.append(" ".join(words))
        for _ in range(rng.randrange(1, 4)):
            n = len(words) - 4  # shingles; one that goes at an end takes one with it
            rows.append(" ".join(words[: len(words) - rng.randrange(1, max(2, n // 4))] if rng.random() < 0.5 else edited(rng, words, rng.choice([0.01, 0.02, 0.03]))))
    return rows


def test_no_group_is_split(spark):
    """Pairs just above 0.8 that no band or leader brings together are links too."""
    rng = random.Random(5)
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(near_limit(rng, 1200))]
    want = sorted({w for w in slow_by_key(rows)})
    assert sorted(r["doc_id"] for r in neardup.keep_one(frame(spark, rows)).collect()) == want


def slow_by_key(rows):
    """As ``slow_groups``; rows are compared with those that share a shingle."""
    near: dict = {}
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    sets = [grams(r[1]) for r in rows]
    for i, own in enumerate(sets):
        for j in {j for g in own for j in near.get(g, ())}:
            both = len(own & sets[j])
            if 5 * both >= 4 * (len(own) + len(sets[j]) - both):
                up[max(root(i), root(j))] = min(root(i), root(j))
        for g in own:
            near.setdefault(g, []).append(i)
    return [rows[root(i)][0] for i in range(len(rows))]


def test_shared_shingles_alone_find_all(spark, monkeypatch):
    """Without bands, with blocks of a few texts, and with a passage that all texts have."""
    monkeypatch.setattr(neardup, "MEET", neardup.BINS + 1)
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = random.Random(6)
    common = " ".join(f"c{i}" for i in range(30))
    texts = near_limit(rng, 60) + [f"{common} {t}" for t in near_limit(rng, 40)]
    words = [f"x{i}" for i in range(120)]
    texts += [" ".join(edited(rng, words, 0.02)) for _ in range(40)] + [texts[0]] * 3 + ["", None]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    want = sorted(set(slow_groups([(r[0], r[1]) for r in rows])))
    assert sorted(r["doc_id"] for r in neardup.keep_one(frame(spark, rows)).collect()) == want


def test_prefixes_and_bitmaps():
    rng = random.Random(7)
    for n in range(1, 200):
        larger, smaller = neardup.prefixes(n)
        assert 1 <= smaller <= larger <= n
    import numpy as np

    a = np.array(sorted(rng.randrange(1 << 63) for _ in range(300)), np.uint64)
    b = np.concatenate((a[:280], np.array([rng.randrange(1 << 63) for _ in range(15)], np.uint64)))
    x, y = (int.from_bytes(neardup.parity(v), "big") for v in (a, b))
    assert 0 < (x ^ y).bit_count() <= 35


def test_counted_shingles():
    """Sets that are just similar enough share as many counted shingles as each needs, in any order."""
    rng, tight = random.Random(8), 0
    counted = lambda n: neardup.prefixes(n)[0] + neardup.slack(n)
    for _ in range(3000):
        both = rng.randrange(1, 300)
        x = list(range(both))
        y = list(range(both))
        for k in range(both // 4):  # 4/5 of the union is in both
            (x, y)[rng.random() < rng.choice([0, 0.5, 1])].append(1000 + k)
        order = rng.choice([lambda v: rng.random(), lambda v: v, lambda v: -v])
        place = {v: order(v) for v in x + y}
        x, y = (sorted(v, key=place.get) for v in (x, y))
        shared = len(set(x[: counted(len(x))]) & set(y[: counted(len(y))]))
        assert shared >= max(neardup.needed(len(x)), neardup.needed(len(y)))
        tight += shared <= 2 + max(neardup.needed(len(x)), neardup.needed(len(y)))
    assert tight > 100 and neardup.needed(1000) == 41


def test_texts_that_share_passages_never_meet(spark, monkeypatch):
    """Long texts with a passage in common aren't verified, two that are near copies are."""
    pairs, real = [], neardup.verified
    monkeypatch.setattr(neardup, "verified", lambda some, *more: pairs.append(some.count()) or real(some, *more))
    passages = [" ".join(f"p{k}w{i}" for i in range(80)) for k in range(6)]
    texts = [" ".join(f"t{k}w{i}" for i in range(3000)) + " " + passages[k // 6] for k in range(36)]
    monkeypatch.setattr(neardup, "MEET", neardup.BINS + 1)  # so that bands find nothing
    words = texts[0].split()
    words[::100] = [f"new{i}" for i in range(len(words[::100]))]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([*texts, " ".join(words)])]
    assert sorted(r["doc_id"] for r in neardup.keep_one(frame(spark, rows)).collect()) == list(range(36))
    assert sum(pairs) == 1


def test_bins():
    hashes = neardup.shingles(b"a b c d e f g h")
    least = neardup.min_hashes(hashes)
    assert len(least) == neardup.BINS and len(hashes) == 4 and (least == neardup.min_hashes(hashes[::-1])).all()
    assert len(neardup.shingles(b"a b")) == 1 and not len(neardup.shingles(b" \n"))
    assert neardup.similar(b"a b c d e f g h i j", b"A b c d e f g h i j") and not neardup.similar(b"a b c d e f", b"x b c d e f")
