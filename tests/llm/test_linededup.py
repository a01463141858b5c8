import hashlib
import random

import xxhash

from marlstone.llm import linededup

from .helpers import corpus, frame


M = 0x9E3779B97F4A7C15


def cut(lines):
    """Chunks (first line, end) of all classes, worked out apart from the operator."""
    worded = [i for i, x in enumerate(lines) if x.strip()]
    found = {}
    for k in range(len(worded) - 1):
        a, b = (xxhash.xxh64_intdigest(lines[worded[k + j]]) for j in range(2))
        rolled = (a * M + b) % 2**64
        found[k] = (rolled, (rolled ^ (rolled >> 32)) % 64)
    kept = set()
    for k in sorted(found, key=lambda k: (found[k][0], k)):
        if not any(j in kept and found[j][1] == found[k][1] for j in (k - 1, k + 1)):
            kept.add(k)
    return [(worded[k], worded[k + 1] + 1) for k in sorted(kept)]


def brute(rows):
    """Kept text of each distinct (doc_id, text), by one pass in order of first occurrence."""
    order = {}
    for i, t in {(r[0], r[1]) for r in rows}:
        data = f"{'' if i is None else i}\x00{t or ''}".encode()
        h = hashlib.sha256(data).digest()
        order[i, t] = (i is None, i or 0, int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:16], "big", signed=True))
    seen, kept = set(), {}
    for i, t in sorted(order, key=order.get):
        lines = (t or "").encode().split(b"\n")
        gone = set()
        for first, end in cut(lines):
            body = tuple(lines[first:end])
            if body in seen:
                gone |= set(range(first, end))
            seen.add(body)
        kept[i, t] = None if t is None else b"\n".join(x for k, x in enumerate(lines) if k not in gone).decode()
    return kept


def documents():
    rows = corpus(8, n=30)
    shared = "\n".join(f"shared line {i}" for i in range(30))
    return rows + [(200 + i, f"own {i}\n" * (i % 4) + shared + f"\nend {i}", "en", "s1", 5) for i in range(6)]


def test_against_brute_force(spark):
    rows = documents()
    want = brute(rows)
    df = frame(spark, rows, extra=True)
    made = linededup.deduplicated(df)
    got = sorted((str(r[0]), str(r["kept_text"])) for r in made.collect())
    assert got == sorted((str(r[0]), str(want[r[0], r[1]])) for r in rows)
    assert made.agg({"n_removed": "sum"}).first()[0] > 50
    cut = linededup.without_repeats(df)
    assert cut.columns == df.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in cut.collect()) == got


def later_lines(texts):
    """Of each text, the lines that lie in a run of two or more lines with a word each that
    occurred before, found pair by pair and without chunks."""
    seen, out = set(), []
    for t in texts:
        lines = t.split("\n")
        pairs = [(a, b) for a, b in zip(lines, lines[1:], strict=False)]
        gone, new = set(), set()
        for k, pair in enumerate(pairs):
            if all(x.strip() for x in pair):
                if pair in seen or pair in new:
                    gone |= {k, k + 1}
                new.add(pair)
        seen |= new
        out.append(gone)
    return out


def test_short_blocks_go(spark):
    """Repeated blocks of 2 to 8 lines between lines of their own: nine of ten lines of every length."""
    rows, sizes = [], {}
    for k in range(420):
        block = [f"block {k} line {j}" for j in range(2 + k % 7)]
        for copy in range(2):
            own = [f"own {k} {copy} {j}" for j in range(7)]
            at = (k * 3 + copy * 2) % 7
            rows.append((2 * k + copy, "\n".join([*own[:at], *block, *own[at:]]), "en", "s1", 1))
        sizes[2 * k + 1] = len(block)
    truth = {r[0]: len(x) for r, x in zip(rows, later_lines(r[1] for r in rows), strict=True)}
    assert {i: n for i, n in truth.items() if n} == sizes
    removed = {r["doc_id"]: r["n_removed"] for r in linededup.deduplicated(frame(spark, rows)).collect()}
    assert all(removed[i] <= truth[i] for i in removed)  # lines that don't repeat stay
    for n in range(2, 9):
        own = [i for i, size in sizes.items() if size == n]
        assert sum(removed[i] for i in own) >= 0.9 * n * len(own), n


def test_recall_of_a_corpus(spark):
    rows = sorted((r for r in documents() if r[0] is not None and r[1] is not None), key=lambda r: r[0])
    rows = list({r[0]: r for r in rows}.values())
    truth = dict(zip([r[0] for r in rows], later_lines(r[1] for r in rows), strict=True))
    got = {r["doc_id"]: r["n_removed"] for r in linededup.deduplicated(frame(spark, rows)).collect()}
    assert sum(got.values()) >= 0.9 * sum(map(len, truth.values())) and all(n <= len(truth[i]) for i, n in got.items())


def test_chunks_equal_those_by_hand():
    rng = random.Random(4)
    for _ in range(200):
        lines = [rng.choice([b"a", b"b", b"c", b"", b" ", b"line %d" % rng.randrange(40)]) for _ in range(rng.randrange(60))]
        assert [(a, b) for a, b, _ in linededup.chunks(lines)] == cut(lines)


def test_chunks_resist_shifts():
    lines = [f"line {i}".encode() for i in range(400)]
    bodies = lambda xs: {b"\n".join(xs[a:b]) for a, b, _ in linededup.chunks(xs)}
    a, b = bodies(lines), bodies([b"new", *lines[:200], b"more", b"lines", *lines[200:]])
    assert len(a) > 380 and len(a - b) <= 3


def test_empty_table(spark):
    df = frame(spark, corpus()).limit(0)
    assert linededup.deduplicated(df).count() == 0 and linededup.without_repeats(df).count() == 0
