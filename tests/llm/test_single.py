"""Operators whose rows stand alone or nearly so: quality, top-k, packing, BPE, toxicity."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from marlstone.llm import bpe, packing, quality, topk, toxicity

from .helpers import corpus, frame


def test_quality_measures():
    for _, text, *_ in corpus(2, vocabulary=4):
        text = text or ""
        words = text.encode().split()
        seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if x.strip()]
        assert quality.measures(text) == (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_hosts(spark):
    good = [(i, " ".join(f"word{i}x{j}" for j in range(30)), "en", f"good{i % 6}", 1) for i in range(60)]
    bad = [(100 + i, "too short", "en", "bad", 1) for i in range(200)] + [(400, good[0][1] + " more", "en", "bad", 1)]
    rows = good + bad + [(500, "x", "en", None, 1), (None, None, None, None, None), *[(600 + i, good[i][1] + " no host", "en", None, 1) for i in range(6)]]
    df = frame(spark, rows, extra=True)
    made = {r["doc_id"]: r for r in quality.quality_rules(df).collect()}
    assert all(made[i]["kept"] for i in range(60))
    assert not made[400]["base_failed"] and made[400]["host_rejected"] and not made[400]["kept"]
    assert made[500]["base_failed"] and None in made and len(made) == len(rows)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [*range(60), *range(600, 606)]
    assert quality.quality_rules(df.limit(0)).count() == 0 and quality.keep_good(df.limit(0)).count() == 0
    maps = df.withColumn("more", topk.F.create_map(topk.F.lit("k"), topk.F.col("text")))
    assert quality.keep_good(maps).count() == 66 and quality.keep_good(maps.drop("doc_id")).count() == 66


@pytest.mark.parametrize(("scale", "block"), [(256.0, 16_384), (3e7, 16_384), (256.0, 20), (3e7, 9), (1e8, 20)])
def test_topk(spark, scale, block, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", block)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "TOGETHER", 2)
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(40)]) for i in range(120)]
    rows += [(150, rows[3][1]), (200, None), (250, [1.0, None]), (300, [float("nan")] * 40), (350, []), (None, rows[5][1]), (7, rows[7][1]), (400, [0.5] * 10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", topk.F.lit("clash")).withColumn("part", topk.F.lit(1))
    f32 = lambda v: None if v is None or any(x is None or x != x for x in v) else [int(np.floor(scale * float(np.float32(x)))) for x in v]
    sound = [(i, w) for i, v in rows if (w := f32(v)) is not None]
    want = []
    for a, (q, v) in enumerate(sound):
        if q is not None and q % 50 == 0:
            scores = sorted(((-sum(x * y for x, y in zip(v, w, strict=False)), c is None, c or 0, c) for b, (c, w) in enumerate(sound) if a != b), key=lambda s: s[:3])
            want += [(q, k + 1, s[3], -s[0]) for k, s in enumerate(scores[:5])]
    got = topk.top_k(df, scale=scale).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert topk.top_k(df.limit(0)).count() == 0
    assert len(topk.top_k(df.filter("vec_id in (50, 51)")).collect()) == 1


def test_topk_search_prunes_nothing_good():
    rng = np.random.default_rng(2)
    columns = rng.integers(-300, 300, (64, 3000)) * (rng.random((64, 1)) ** 4 + 0.01)
    columns = columns.astype(np.int64)
    queries = columns.T[:20].copy()
    found = topk.search(queries, np.arange(20), columns, np.arange(3000), 5)
    for q, (at, scores) in enumerate(found):
        whole = queries[q] @ columns
        order = [i for i in np.lexsort((np.arange(3000), -whole)) if i != q][:5]
        assert at.tolist() == order and scores.tolist() == whole[order].tolist()
    bars = np.array([s[-1] + (i % 2) for i, (_, s) in enumerate(found)], np.float64)  # those below the bar needn't come
    for (at, scores), (a, s), bar in zip(topk.search(queries, np.arange(20), columns, np.arange(3000), 5, bars=bars), found, bars, strict=True):
        assert [x for x in zip(at.tolist(), scores.tolist(), strict=True) if x[1] >= bar] == [x for x in zip(a.tolist(), s.tolist(), strict=True) if x[1] >= bar]


def naive_best_fit(sizes, lengths, overhead):
    """The same rules over plain lists."""
    free, size_of, bins, waiting = [], [], [], list(sizes)
    for s in sizes:
        waiting.remove(s)
        fits = [(room, b) for b, room in enumerate(free) if room >= s]
        if fits:
            b = min(fits)[1]
        else:
            costs = []
            for x in sorted(lengths):
                if x >= s:
                    space = x - s
                    for w in waiting:
                        space -= w if w <= space else 0
                    costs.append(((x + overhead) / (x - space), x))
            free.append(min(costs)[1])
            size_of.append(free[-1])
            b = len(free) - 1
        bins.append(b)
        free[b] -= s
    return bins, [min(x for x in lengths if x >= n - r) for n, r in zip(size_of, free, strict=True)]


def test_best_fit_equals_naive():
    rng = random.Random(6)
    for _ in range(60):
        lengths = tuple(sorted(rng.sample(range(8, 80), 3)))
        sizes = sorted((rng.randrange(1, lengths[-1] + 1) for _ in range(rng.randrange(0, 60))), reverse=True)
        assert packing.best_fit(sizes, lengths, 5) == naive_best_fit(sizes, lengths, 5)


def test_packing(spark):
    rows = corpus(4)
    df = frame(spark, rows, extra=True)
    made = packing.pack(df, (16, 32, 64), shard=20).collect()
    assert sum(r["n_tokens"] for r in made) == sum(len((r[1] or "").split()) + 1 for r in rows)
    bins: dict = {}
    for r in made:
        bins.setdefault((r["bin_id"], r["bin_length"]), []).append((r["slot"], r["bin_offset"], r["n_tokens"]))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, length), pieces in bins.items():
        at = 0
        for k, (slot, offset, n) in enumerate(sorted(pieces)):
            assert (slot, offset) == (k, at)
            at += n
        assert at <= length and not any(at <= x < length for x in (16, 32, 64))
    assert packing.pack(df.limit(0)).count() == 0


def test_sequences(spark):
    """Each document's tokens are found again, in order, in the sequences; bins don't depend
    on how rows lie in partitions, ties and repeated rows included."""
    rows = [*corpus(4), *corpus(4)[:9], (77, None, None, None, None), (78, "w " * 150, "en", "s", 1), (78, "v " * 150, "en", "s", 1)]
    df = frame(spark, rows, extra=True)
    made = packing.packed(df, (16, 32, 64), shard=20).collect()
    parts: dict = {}
    for r in made:
        assert r["n_tokens"] == sum(r["sizes"]) <= r["bin_length"] and not any(r["n_tokens"] <= x < r["bin_length"] for x in (16, 32, 64))
        for i, start, n, part in zip(r["doc_ids"], r["starts"], r["sizes"], r["parts"], strict=True):
            parts.setdefault(i, Counter())[start, tuple(part.split(" "))] += 1
            assert n == len(part.split(" "))
    want: dict = {}
    for i, t, *_ in rows:
        words = [*(t or "").encode().split(), b""]
        for start in range(0, len(words), 64):
            want.setdefault(i, Counter())[start, tuple(w.decode() for w in words[start : start + 64])] += 1
    assert parts == want
    again = packing.packed(df.repartition(7, "text"), (16, 32, 64), shard=20).collect()
    assert sorted(map(str, again)) == sorted(map(str, made))
    assert packing.packed(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, tokenizer):
    rng = random.Random(9)
    texts = [r[1] for r in corpus(5)] + ["".join(rng.choice("abc é\n1😀'st<|endoftext|>") for _ in range(300)) for _ in range(30)]
    texts += ["a" * 5000, "ab" * 3000, "x" * 50_000, " " * 3000 + "x"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(spark, bpe.F.col("text"), path, public_tokenizers.PATTERN)
    for r in df.select("text", ids.alias("ids"), bpe.decode(spark, ids, path, public_tokenizers.PATTERN).alias("back")).collect():
        assert r["ids"] == tokenizer.encode_ordinary(r["text"] or "")
        assert bytes(r["back"]) == (r["text"] or "").encode()


def test_bpe_round_trip(spark, tokenizer, tmp_path):
    rows = [*corpus(5), (None, "no id é", None, None, None)]
    frame(spark, rows, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    made = bpe.op6_bpe(spark, str(tmp_path))
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = []
    for i, t, *_ in rows:
        ids = tokenizer.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, want)) and made.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    frame(spark, rows).limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert bpe.op6_bpe(spark, f"{tmp_path}/empty").count() == 0


def test_toxicity(spark):
    rng = random.Random(2)
    plain = ["".join(rng.choice("abdefilmnoprstu") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    rude = ["grumbolt", "snarvick", "plonkard"]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 120))]
        if toxic := i % 3 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(rude))
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, " ".join(plain[:40]) + " gromboltt snarviick plonkarrd", "en", "s", 1), (1001, "", "en", "s", 1), (1002, None, "en", "s", 1), (None, "hello", None, None, None)]
    labels += [(None, 1, 1), (5000, 1, 0), (3, 1, None)]
    made = toxicity.toxicity(frame(spark, rows, extra=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r for r in made.collect()}
    assert all(r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [i for i in range(400) if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == (i % 3 == 0) for i in held]) > 0.95
    assert got[1000]["predicted"] == 1 and got[1001]["predicted"] == got[1002]["predicted"] == 0
    twice = [*rows, *rows, (402, "x " * 200_000, "en", "s", 1)]
    table = spark.createDataFrame([*labels, *labels, (402, 1, 1)], "doc_id long, quality int, toxic int")
    same = toxicity.toxicity(frame(spark, twice), table)  # repeated rows and a very long text change no score
    assert {(r["doc_id"], round(r["score"], 9)) for r in same.collect() if r["doc_id"] != 402} == {(i, round(r["score"], 9)) for i, r in got.items()}
    sample = toxicity.training_rows(frame(spark, twice), table, (30, 20)).collect()
    assert [r["label"] for r in sample] == [0] * 30 + [1] * 20 and len({r["doc_id"] for r in sample}) == 50
    assert toxicity.toxicity(frame(spark, rows).limit(0), table).count() == 0
    none = toxicity.toxicity(frame(spark, rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["score"] for r in none.collect()} == {0.0}
