import base64
import gc
from collections import Counter

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from marlstone.llm import common

from . import test_linededup, test_neardup
from .helpers import DOCS, corpus


def kept_by_rules(rows):
    """Base rules by hand; no host here fails often enough to be rejected."""
    for r in rows:
        words = (r[1] or "").encode().split()
        seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        if not (len(words) < 20 or 100 * len(covered) > 30 * len(words)):
            yield r


def test_stages_against_brute_force(spark, tmp_path):
    long = "\n".join(" ".join(f"passage{i}word{j}" for j in range(12)) for i in range(9))
    rows = [r for r in corpus(11, n=60, vocabulary=400) if r[0] is not None]
    rows += [(300 + i, f"head{i} " * 3 + " ".join(f"a{i}b{j}" for j in range(40)) + " " + long.replace("\n", " ") + " " + " ".join(f"c{i}d{j}" for j in range(25)), "en", f"s{i}", 7) for i in range(4)]
    df = spark.createDataFrame(rows, DOCS)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "SimHash near-dedup", "suffix-array dedup", "best-fit packing"]
    results = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        results.append(docs.collect())
        if k < 4:
            assert docs.columns == DOCS.fieldNames()
    texts = lambda rs: sorted((r[0], r[1]) for r in rs)
    want = list(kept_by_rules(rows))
    assert texts(results[0]) == texts(want) and 0 < len(want) < len(rows)
    lines = test_linededup.brute(want)
    want = [(r[0], lines[r[0], r[1]]) for r in want]
    assert texts(results[1]) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in results[1])
    want = sorted(dict(want).items())
    first = set(test_neardup.slow_groups(want))
    want = [(i, t) for i, t in want if i in first]
    assert sorted(r[0] for r in results[2]) == sorted(i for i, _ in want)
    seen, cut = set(), {}
    for i, t in sorted(want):
        data = t.encode()
        gone = [False] * len(data)
        for k in range(len(data) - 199):
            if data[k : k + 200] in seen:
                gone[k : k + 200] = [True] * 200
            seen.add(data[k : k + 200])
        cut[i] = bytes(x for x, y in zip(data, gone, strict=True) if not y).decode(errors="ignore")
    cut = {i: t for i, t in cut.items() if t.encode().split()}
    assert {r[0]: r[1] for r in results[3]} == cut and any(len(cut[i]) < len(t) for i, t in want if i in cut)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tokenizer = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    parts = {}
    for r in results[4]:
        assert r["n_tokens"] == len(r["tokens"]) == sum(r["sizes"]) <= r["bin_length"]
        at = 0
        for i, start, size in zip(r["doc_ids"], r["starts"], r["sizes"], strict=True):
            parts.setdefault(i, []).append((start, list(r["tokens"][at : at + size])))
            at += size
    assert {i: [x for _, p in sorted(ps) for x in p] for i, ps in parts.items()} == {i: [*tokenizer.encode_ordinary(t), max(ranks.values()) + 1] for i, t in cut.items()}
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, results[4]))


def test_awkward_tables(spark, tmp_path):
    """Null ids and texts, repeated rows, another column, hosts that are rejected; and no rows."""
    words = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(None, words(0, 40), "en", "good", 1), (None, None, None, None, None), (1, words(1, 40), "en", "good", 1), (1, words(1, 40), "en", "good", 1), (2, "", "en", "good", 0)]
    rows += [(10 + i, words(10 + i, 30), "en", f"host{i % 9}", 1) for i in range(90)]
    rows += [(200 + i, "too short", "en", "bad", 1) for i in range(90)] + [(300, words(300, 60), "en", "bad", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumn("marl_row", F.lit("clash"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == df.columns
            kept.append(Counter(r["doc_id"] for r in docs.collect()))
    assert kept[0] == Counter({None: 1, 1: 2} | {10 + i: 1 for i in range(90)})  # 300 goes with its host
    assert kept[2] == kept[3] == Counter({None: 1, 1: 1} | {10 + i: 1 for i in range(90)})
    assert {i for r in docs.collect() for i in r["doc_ids"]} == set(kept[3])
    empty = df.limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, empty, str(tmp_path)).count() == 0, k


def test_a_stage_leaves_other_frames_alone(spark, tmp_path):
    """A frame can be read whatever ran since it was made; its tables go with it."""
    rows = [r for r in corpus(12, n=50, vocabulary=400) if r[0] is not None]
    docs = spark.createDataFrame(rows, DOCS).withColumn("more", F.create_map(F.lit("k"), F.col("source")))
    good = corpus_pipeline.quality_stage(spark, docs, str(tmp_path)).filter("doc_id >= 0")
    lines = corpus_pipeline.line_stage(spark, docs, str(tmp_path))
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        common.swept(spark)
    corpus_pipeline.near_duplicate_stage(spark, docs, str(tmp_path)).count()
    assert good.count() > 20 and lines.count() == len(rows) and good.columns == docs.columns
    before = len(common._left)
    del good, lines
    for _ in range(3):
        gc.collect()
        spark._jvm.System.gc()
        common.swept(spark)
    assert len(common._left) < before
