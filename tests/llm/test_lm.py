import math
import zlib
from collections import Counter

import numpy as np
import pytest

from marlstone.llm import lm

from .helpers import corpus, frame


def test_forward_is_exact():
    rng = np.random.default_rng(1)
    model = lm.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T)
    sequences = [rng.integers(0, 5, n) for n in (4, 1, 6, 4)]

    def brute(s):  # over all state paths
        total = 0.0
        for path in np.ndindex(*[3] * len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= model.move[path[t - 1], path[t]] * model.emit[s[t], path[t]]
            total += p
        return math.log10(total)

    assert lm.log10_likelihoods(model, sequences) == pytest.approx([brute(s) for s in sequences])
    long = [rng.integers(0, 5, 3000), rng.integers(0, 5, 1024)]
    a, want = model.start * model.emit[long[0][0]], 0.0
    for t, x in enumerate(long[0]):
        a = a if t == 0 else (a @ model.move) * model.emit[x]
        want += math.log10(a.sum())
        a = a / a.sum()
    assert lm.log10_likelihoods(model, long)[0] == pytest.approx(want)


def test_expected_counts_by_brute_force():
    rng = np.random.default_rng(2)
    model = lm.Model(rng.dirichlet(np.ones(2)), rng.dirichlet(np.ones(2), 2), rng.dirichlet(np.ones(4), 2).T)
    sequences = [rng.integers(0, 4, n) for n in (3, 5, 1)]
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for s in sequences:
        paths = list(np.ndindex(*[2] * len(s)))
        ps = []
        for path in paths:
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= model.move[path[t - 1], path[t]] * model.emit[s[t], path[t]]
            ps.append(p)
        for path, p in zip(paths, ps, strict=True):
            w = p / sum(ps)
            start[path[0]] += w
            for t in range(len(s)):
                emit[s[t], path[t]] += w
                if t:
                    move[path[t - 1], path[t]] += w
    for stretch in (100, 2, 1):  # cuts change nothing
        for got, want in zip(lm.expected(model, sequences, stretch), (start, move, emit), strict=True):
            assert got == pytest.approx(want)


def test_cuts_change_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    model = lm.Model(rng.dirichlet(np.ones(4)), rng.dirichlet(np.ones(4), 4), rng.dirichlet(np.full(50, 0.1), 4).T + 1e-12)
    sequences = [rng.integers(0, 50, n) for n in (700, 1, 64, 65, 333, 2)]
    want = lm.expected(model, sequences, 10_000)
    monkeypatch.setattr(lm, "CELLS", 500)
    for got, x in zip(lm.expected(model, sequences, 64), want, strict=True):
        assert got == pytest.approx(x)
    assert want[0].sum() == pytest.approx(6) and want[1].sum() == pytest.approx(sum(map(len, sequences)) - 6)


@pytest.mark.parametrize("dictionary", [65_536, 7])
def test_base_scores_and_normalisation(spark, dictionary):
    rows = corpus(3, vocabulary=60)
    made = lm.language_model(frame(spark, rows, extra=True), states=2, symbols=5, rounds=2, dictionary=dictionary).collect()
    words = lambda t: ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in (t or "").split()] + [None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for r in rows if not held(r[0]) for w in words(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in rows:
        ws = words(r[1])
        want.append((str(r[0]), held(r[0]), len(ws), sum(w in counts for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)))
    assert sorted((str(r[0]), *r[1:5], round(r["base_score"], 6)) for r in made) == sorted(want)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in made)


@pytest.mark.parametrize(("symbols", "dictionary"), [(5, 65_536), (70_000, 20), (3, 4)])
def test_scores_by_brute_force(spark, symbols, dictionary):
    """The score of a text is the forward sum, token by token, over emissions that are
    probabilities: for each state, those of all known tokens and an unseen one of each shape add up to 1."""
    long = "z" * 90
    rows = corpus(3, vocabulary=60) + [(500 + i, f"{long} {long}y w1", "en", "s", 1) for i in range(8)]
    df = frame(spark, rows)
    own = df.select("doc_id", lm.F.coalesce(lm.crc_mod(lm.F.col("doc_id"), 7) == 2, lm.F.lit(False)).alias("held_out"), "text")
    counts = lm.token_counts(own.filter("not held_out").select("text")).cache()
    vocab = lm.vocabulary(counts, symbols, dictionary)
    shared = spark.sparkContext.broadcast(vocab)
    model = lm.trained(lm.encoded(own, shared).filter("not held_out"), vocab, 2, 2)
    known = {r["token"].encode(): (r["shape"], r["c"]) for r in counts.collect()}
    own_symbols = {t: i for t, i in vocab.index.items() if 0 < i <= vocab.first_shape - 1}
    rest: dict = {}
    for t, (shape, c) in known.items():
        if t and lm.name_of(t) not in own_symbols:
            rest.setdefault(shape, {})[t] = c

    def emission(word):
        name = lm.name_of(word)
        if word == lm.END or name in own_symbols:
            return model.emit[own_symbols.get(name, 0)]
        shape = lm.shape_of(word)
        others = rest.get(shape, {})
        return model.emit[vocab.first_shape + shape] * (others.get(word, 0) + 1) / (sum(others.values()) + len(others) + 1)

    if symbols < len(known) and dictionary < len(known):
        assert any(rest.values())
    total = model.emit[0] + sum(emission(t) for t in known if t) + sum(model.emit[vocab.first_shape + s] / (sum(rest.get(s, {}).values()) + len(rest.get(s, {})) + 1) for s in range(lm.SHAPES))
    assert total == pytest.approx(np.ones(2))
    want = []
    for r in rows:
        a, logs = None, 0.0
        for w in lm.words_of(r[1]):
            a = (model.start if a is None else a @ model.move) * emission(w)
            logs += math.log10(a.sum())
            a = a / a.sum()
        want.append((str(r[0]), round(logs, 6)))
    made = lm.language_model(df, states=2, symbols=symbols, rounds=2, dictionary=dictionary).collect()
    assert sorted((str(r["doc_id"]), round(r["score"], 6)) for r in made) == sorted(want)


def test_more_symbols_than_two_bytes_hold():
    vocab = lm.Vocabulary([(f"t{i}", 0, 1) for i in range(70_000)], 70_000, 70_000, {0: (70_000, 70_000)}, 70_000)
    assert np.array([vocab.n_symbols - 1]).astype(vocab.kind)[0] == vocab.n_symbols - 1


def test_nothing_to_train_on(spark):
    rows = [(i, f"one two w{i}", "en", "s", 1) for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    made = lm.language_model(frame(spark, rows), states=2).collect()
    assert len(made) == len(rows) > 3 and all(r["held_out"] and r["train_tokens"] == r["n_known"] == 0 and r["base_score"] == 0 and math.isfinite(r["score"]) for r in made)


def test_training_raises_likelihood():
    rng = np.random.default_rng(4)
    sequences = [rng.integers(0, 4, 30) + 4 * (i % 2) for i in range(40)]
    share = np.full(8, 1 / 8)
    model, before = lm.first_model(share, 2), -math.inf
    for _ in range(6):
        now = lm.log10_likelihoods(model, sequences).sum()
        assert now > before - 1e-9
        before = now
        start, move, emit = lm.expected(model, sequences)
        model = lm.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def test_empty_table(spark):
    df = frame(spark, corpus())
    assert lm.language_model(df.limit(0)).count() == 0
