"""The registered queries over the smallest tables, against brute force."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from marlstone.llm import queries as llm

from .test_linededup import cut, later_lines
from .test_simhash import slow_components, slow_fingerprint
from .test_texts import runs_by_hand

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


@pytest.fixture(scope="module")
def docs():
    return [(r["doc_id"], r["text"] or "") for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()]


def rows(spark, name, *columns):
    made = llm.queries()[name](spark, FOLDER)
    assert made.columns[: len(columns)] == list(columns) or set(columns) <= set(made.columns)
    return sorted(tuple(r[c] for c in columns) for r in made.collect())


def covered(units, window, at):
    """Which units lie in a window that also starts anywhere else; ``at`` cuts a window out."""
    seen = Counter(at(t, i) for t in units for i in range(len(t) - window + 1))
    for t in units:
        m = [False] * len(t)
        for i in range(len(t) - window + 1):
            if seen[at(t, i)] > 1:
                m[i : i + window] = [True] * window
        yield m


def test_op2(spark, docs):
    units = [WORD.findall(t) for _, t in docs]
    want = []
    for (i, _), words, m in zip(docs, units, covered(units, 35, lambda t, i: tuple(t[i : i + 35])), strict=True):
        want.append((i, len(words), sum(m), sha(" ".join(w for w, x in zip(words, m, strict=True) if not x).encode())))
    assert rows(spark, "op2_substrings", "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want)
    assert any(0 < w[2] < w[1] for w in want)


def test_op3(spark, docs):
    units = [t.encode() for _, t in docs]
    want = []
    for (i, _), data, m in zip(docs, units, covered(units, 200, lambda t, i: t[i : i + 200]), strict=True):
        spans = sum(b and not a for a, b in zip([False, *m], m, strict=False))
        want.append((i, len(data), sum(m), spans, sha(bytes(b for b, x in zip(data, m, strict=True) if not x))))
    assert rows(spark, "op3_suffix_array", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want)


def test_op4(spark, docs):
    split = [(i, [*("".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(t)), None]) for i, t in docs]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, ws in split if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted((i, held(i), len(ws), sum(w in counts for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in split)
    made = llm.queries()["op4_hmm"](spark, FOLDER).collect()
    assert sorted((*r[:5], round(r["base_score"], 6)) for r in made) == want
    out = [r for r in made if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)  # states help


def test_op5(spark, docs):
    fps = [(i, slow_fingerprint(t)) for i, t in docs]
    want = sorted((i, f"{fp:016x}", c) for (i, fp), c in zip(fps, slow_components(fps), strict=True))
    assert rows(spark, "op5_simhash", "doc_id", "fingerprint", "component_id") == want


def test_op7(spark, docs):
    made = llm.queries()["op7_toxicity"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in made) == sorted(i for i, _ in docs)
    for r in made:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_op8(spark, docs):
    seen, want = set(), []
    for i, t in sorted(docs):
        lines, gone = t.encode().split(b"\n"), set()
        for a, b in cut(lines):
            if tuple(lines[a:b]) in seen:
                gone |= set(range(a, b))
            seen.add(tuple(lines[a:b]))
        want.append((i, len(lines), len(gone), sha(b"\n".join(x for k, x in enumerate(lines) if k not in gone))))
    assert rows(spark, "op8_lines", "doc_id", "n_lines", "n_removed", "kept_sha256") == sorted(want)
    truth = later_lines(t for _, t in sorted(docs))
    assert sum(w[2] for w in want) >= 0.9 * sum(map(len, truth)) > 0


def test_op1(spark, docs):
    made = llm.queries()["op1_packing"](spark, FOLDER).collect()
    words = {i: [*WORD.findall(t), ""] for i, t in docs}
    used = Counter()
    for r in made:
        parts = [words[i][s : s + n] for i, s, n in zip(r["doc_ids"], r["starts"], r["sizes"], strict=True)]
        assert r["tokens_sha256"] == sha(" ".join(x for p in parts for x in p).encode()) and sum(map(len, parts)) == r["n_tokens"] <= r["bin_length"]
        used += Counter((i, s + k) for i, s, n in zip(r["doc_ids"], r["starts"], r["sizes"], strict=True) for k in range(n))
    assert used == Counter((i, k) for i, ws in words.items() for k in range(len(ws)))


def test_op12(spark, docs):
    want = []
    for i, t in docs:
        words, h = WORD.findall(t), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            words = [words[j] if j < a else words[a + (j - a) % (1 + (n - a) // (3 + g % 8))] for j in range(n)]
        found = runs_by_hand(words)
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        gone = {j for s, length, q in found for j in range(s + q, s + length)}
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        want.append((i, len(found), *best, best[0] is not None and 1000 * best[1] // best[2] or None, sha("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()), sha(kept.encode())))
    made = rows(spark, "op12_runs", "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted(map(repr, made)) == sorted(map(repr, want))
    assert any(w[1] for w in want)


def test_op13(spark, docs):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = [len(whole.encode(t, add_special_tokens=False)) for _, t in docs]
    assert rows(spark, "op13_tokens", "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted((i, len(t.encode()), k, k > 1024) for (i, t), k in zip(docs, n, strict=True))


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{FOLDER}/{file}'")
    cursor = con.execute(llm.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    made = llm.queries()[name](spark, FOLDER)
    assert sorted(columns) == sorted(made.columns)
    assert sorted(repr(tuple(r[c] for c in columns)) for r in made.collect()) == sorted(map(repr, cursor.fetchall()))
