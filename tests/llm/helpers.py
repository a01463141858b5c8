"""Small inputs with the awkward cases that every operator must stand."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def corpus(seed: int = 0, n: int = 40, vocabulary: int = 30) -> list[tuple]:
    """Random documents over few words, with copies, near copies, nulls, empty and blank
    texts, repeated rows, a long text, and passages that several documents share."""
    rng = random.Random(seed)
    word = lambda: "w" + "é" * rng.randrange(2) + str(rng.randrange(vocabulary))
    line = lambda k: " ".join(word() for _ in range(k))
    texts = ["\n".join(line(rng.randrange(1, 15)) for _ in range(rng.randrange(1, 12))) for _ in range(n)]
    passage = "\n".join(line(9) for _ in range(8))
    for i in range(0, n, 5):
        texts[i] = texts[i] + "\n" + passage + "\n" + texts[(i * 7 + 1) % n]
    texts += [texts[0], texts[0], texts[1] + " tail", None, "", "  \n\t ", "x" * 900, "ab " * 500, passage]
    rows = [(i, t, "en", f"s{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, "no id at all", None, None, None), (None, None, None, None, None)]


def frame(spark, rows, extra: bool = False):
    """The rows as a frame; with ``extra``, columns whose names operators use themselves."""
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for c in ("n", "row", "host", "fp", "m", "key", "a", "b", "kept", "id", "part", "h", "root", "marl_row", "h1", "h2", "token", "score", "made", "low", "copy"):
            df = df.withColumn(c, df["doc_id"].cast("string"))
    return df.repartition(3)
