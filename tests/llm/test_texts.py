"""Operators over single texts that are cut, counted or searched for runs (11 to 13)."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marlstone.llm import counts, fim, runs

from .helpers import corpus, frame

WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def by_hand(doc_id, text):
    """Operator 11's contract over a list of code points."""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    text = text or ""
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def units_by_hand(text, unit):
    """Where units start, in code points."""
    if unit == "chars":
        return list(range(len(text)))
    if unit == "lines":
        return [i for i in range(len(text)) if not i or text[i - 1] == "\n"]
    return [i for i in range(len(text)) if not i or (text[i - 1] in " \t\n\x0b\x0c\r" and text[i] not in " \t\n\x0b\x0c\r")]


@pytest.mark.parametrize("unit", ["chars", "words", "lines"])
def test_checkpoints(unit):
    rng = random.Random(3)
    for k in range(60):
        text = "".join(rng.choice("aé€🤦 \n\tb") for _ in range(rng.randrange(90)))
        index = fim.Checkpoints(text.encode(), unit, every=rng.randrange(1, 9), block=rng.randrange(1, 12))
        starts = units_by_hand(text, unit)
        assert index.n == len(starts) and index.n_chars == len(text)
        assert len(index.units) <= len(starts) // index.every + 1
        for i, at in enumerate([*starts, len(text)]):
            assert index.find(i) == (len(text[:at].encode()), at)
    with pytest.raises(ValueError):
        fim.Checkpoints(b"", "pages")


def test_fim(spark):
    rows = [*corpus(4), (900, "has <S> in it", "en", "s", 1), (901, "é" * 5000, "en", "s", 1), *[(1000 + i, "a🤦 b" * i, "en", "s", 1) for i in range(60)]]
    df = frame(spark, rows, extra=True).withColumn("form", F.lit("clash"))
    made = df.select("doc_id", "text", fim.fill_in_middle(F.col("text"), F.col("doc_id"), every=7).alias("x")).withColumn("back", fim.restored(F.col("x.output"), F.col("x.form")))
    got = made.collect()
    assert len(got) == len(rows) and {r["x"]["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert tuple(r["x"]) == by_hand(r["doc_id"], r["text"]) and r["back"] == (r["text"] or "")
    for unit in ("words", "lines"):
        for r in df.select("text", fim.fill_in_middle(F.col("text"), F.col("doc_id"), unit=unit, rate=100, suffix_first=50).alias("x")).withColumn("back", fim.restored(F.col("x.output"), F.col("x.form"))).collect():
            assert r["back"] == (r["text"] or "") and r["x"]["n"] == len(units_by_hand(r["text"] or "", unit))
            if r["x"]["form"] != "plain":
                ends = [*units_by_hand(r["text"], unit), len(r["text"])]
                assert r["x"]["prefix_chars"] in ends and r["x"]["prefix_chars"] + r["x"]["middle_chars"] in ends
    assert df.limit(0).select(fim.fill_in_middle(F.col("text"), F.col("doc_id")).alias("x")).count() == 0
    for marks in (("<P>", "<P>x", "<M>"), ("<P<", "<S>", "<M>"), ("<P>", "<S>", "")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(F.col("text"), F.col("doc_id"), marks=marks)


def runs_by_hand(words, least=6, times=4):
    """Every lag, word by word; a stretch counts under its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def periodic_texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        words = []
        for _ in range(rng.randrange(6)):
            unit = [rng.choice("abc") for _ in range(rng.randrange(1, 12))]
            whole = unit * rng.randrange(1, 14)
            words += whole[: rng.randrange(len(whole) + 1)] + [rng.choice("abcdefgh") for _ in range(rng.randrange(5))]
        yield words


def test_runs_against_every_lag():
    some = 0
    for words in periodic_texts(5, 400):
        want = runs_by_hand(words)
        some += len(want) > 1
        assert runs.runs_of(words) == want
        assert runs.runs_of(words, 3, 3) == runs_by_hand(words, 3, 3)
        gone = {i for s, length, q in want for i in range(s + q, s + length)}
        assert runs.collapsed(words, runs.runs_of(words)) == [w for i, w in enumerate(words) if i not in gone]
    assert some > 100
    with pytest.raises(ValueError):
        runs.runs_of(["a"], times=2)


def test_runs_of_long_texts():
    rng = random.Random(6)
    words = [str(rng.randrange(5000)) for _ in range(30_000)]
    words[1000:1003] = ["x", "x", "x"]
    words[2000:2400] = ["y", "z"] * 200
    block = words[5000:6500]
    words[6500:11_500] = (block * 4)[:5000]
    found = runs.runs_of(words)
    assert (2000, 400, 2) in found or (1999, 401, 2) in found
    assert [r for r in found if r[2] == 1500][0][1] >= 6500
    assert runs.runs_of(["same"] * 200_000) == [(0, 200_000, 1)]
    assert runs.runs_of(["p", "q", "r"] * 50_000 + ["s"] * 50_000) == [(0, 150_000, 3), (150_000, 50_000, 1)]


def test_runs_in_spark(spark):
    rows = [*corpus(7, vocabulary=3), *[(2000 + i, " ".join(w), "en", "s", 1) for i, w in enumerate(periodic_texts(8, 60))], (3000, "a \t a\na a a a a", "en", "s", 1)]
    df = frame(spark, rows, extra=True)
    got = df.select("doc_id", "text", runs.periodic(F.col("text")).alias("x")).collect()
    assert len(got) == len(rows)
    for r in got:
        words = WORD.findall(r["text"] or "")
        want = runs_by_hand(words)
        assert r["x"]["n_words"] == len(words) and [tuple(x) for x in r["x"]["runs"]] == want
        best = min(want, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r["x"]["strongest"] and tuple(r["x"]["strongest"])) == best
    assert next(r for r in got if r["doc_id"] == 3000)["x"]["kept"] == "a"
    assert df.limit(0).select(runs.periodic(F.col("text"))).count() == 0


def test_planted_runs(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 40)), "en", "s", 1) for i in range(300)] + [(None, "a b", "en", "s", 1), (1, None, "en", "s", 1)]
    changed = 0
    for r in frame(spark, rows).select("doc_id", "text", runs._planted(F.col("text"), F.col("doc_id")).alias("made")).collect():
        words = (r["text"] or "").split()
        h = zlib.crc32(str(r["doc_id"]).encode()) if r["doc_id"] is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert r["made"].split() == [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        else:
            assert r["made"] == (r["text"] or "")
    assert changed > 10


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        return f.read()


def awkward(rng, size):
    parts = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "\n\n ", "\t", "'", "'s", "'ll", "'l", "l", "é", "🤦🏼", "word", "Antidisestablishment", "12345", "...", "!?", "　", "中文字", "́", "a" * 40, "#" * 30, " " * 35, "7" * 25]
    return "".join(rng.choice(parts) for _ in range(size))


def test_spliced_counts(vocabulary):
    rng = random.Random(9)
    whole = Tokenizer.from_buffer(vocabulary)
    texts = [awkward(rng, rng.randrange(1, 60)) for _ in range(150)] + ["x" * 3000, " " * 3000, "ab " * 900 + "y" * 700 + " z" * 300, "<|endoftext|>" * 60]
    widened = 0
    for chunk, overlap in ((20, 4), (33, 20), (64, 1), (128, 60), (500, 24)):
        counter = counts.TokenCounter(vocabulary, chunk, overlap)
        assert counter.counts(texts) == [len(whole.encode(t, add_special_tokens=False)) for t in texts]
        widened += counter.widened
    assert widened > 100


def test_count_refuses_other_vocabularies(vocabulary):
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f, pytest.raises(ValueError):
        counts.TokenCounter(f.read())


def test_counts_in_spark(spark, vocabulary):
    whole = Tokenizer.from_buffer(vocabulary)
    rows = [*corpus(10), (5000, "word's <|endoftext|> " * 4000, "en", "s", 1), (5001, "z" * 70_000, "en", "s", 1)]
    df = frame(spark, rows, extra=True)
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = df.select("text", counts.token_counts(spark, F.col("text"), path, chunk=900).alias("n"), counts.token_counts(spark, F.col("text"), path).alias("m")).collect()
    assert len(got) == len(rows) and all(r["n"] == r["m"] == len(whole.encode(r["text"] or "", add_special_tokens=False)) for r in got)
    assert df.limit(0).select(counts.token_counts(spark, F.col("text"), path)).count() == 0
