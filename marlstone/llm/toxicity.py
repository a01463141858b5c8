"""Toxicity scores by subword-bag embeddings (operator 7).

A word is the mean of the vectors of its character n-grams (over its UTF-8 bytes with
boundary marks, hashed into a fixed number of buckets) and of the word itself; a bag of
words is the mean of its words; a linear softmax over that mean gives the class.  Both
vectors and softmax are trained jointly in numpy with Adagrad.  A misspelt word shares
most n-grams, and so most of its vector, with the word it stands for.

Labels mark whole documents while the toxic words in one are few, so training runs in
rounds: whole documents as bags first, then short windows, where a toxic document gives
its highest windows under the last model and a clean one its highest and a few others.
A document's score is its highest window's logit, calibrated on the training documents.

The model is fitted on the driver on a bounded sample of labelled ids (``PER_CLASS``, the
first by a hash of the id, and of texts up to ``LONGEST`` bytes); scoring covers every
whole text.

Defined results: null and empty texts get the score of a bag without words; labels
without a document, null labels and null ids are no training rows; repeated rows count
once in training and are scored alike; with no training row of either class every score
is 0; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chosen, crc_mod, stored, table

#: Most labelled rows of label 0 and of label 1 that the model is fitted on.
PER_CLASS = (900, 700)
#: Bytes of the longest text that the model is fitted on; the driver holds the sample.
LONGEST = 1 << 17
BUCKETS, WIDTH, GRAMS = 1 << 17, 8, (3, 4, 5)
#: Words in a window, and words from one window to the next.
WINDOW, STEP = 3, 1
EPOCHS, RATE, BATCH, ROUNDS = (5, 8), (0.1, 0.2), 128, 2
SEED = 7
#: Words whose logits a Python worker keeps; when full, it starts anew.
CACHE_ENTRIES = 500_000


def subwords(word: bytes) -> list[int]:
    x = b"<" + word + b">"
    found = [crc32(x[i : i + n]) % BUCKETS for n in GRAMS for i in range(len(x) - n + 1)]
    found.append(crc32(x) % BUCKETS)
    return found


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # bytes: only A-Z change


class Logits(dict):
    """word -> the difference of its two class logits, worked out on demand."""

    def __init__(self, by_bucket: np.ndarray):
        super().__init__()
        self.of = by_bucket.tolist()

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        of, ids = self.of, subwords(word)
        self[word] = value = sum([of[i] for i in ids]) / len(ids)
        return value

    def windows(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The mean logit of each window, and where it starts.  No words: one bag, 0."""
        n = len(words)
        if not n:
            return np.zeros(1), np.zeros(1, np.int64)
        x = np.fromiter(map(self.__getitem__, words), np.float64, n)
        if n <= WINDOW:
            return x.mean(keepdims=True), np.zeros(1, np.int64)
        starts = np.minimum(np.arange(0, n - WINDOW + STEP, STEP), n - WINDOW)
        return sum(x[starts + j] for j in range(WINDOW)) / WINDOW, starts


def bag(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids and weights of a bag of words."""
    parts = [subwords(w) for w in words]
    ids = np.array([i for p in parts for i in p], np.int64)
    sizes = np.array([len(p) for p in parts], np.int64)
    weights = np.repeat(1.0 / np.maximum(sizes, 1) / max(1, len(parts)), sizes)
    kept, at = np.unique(ids, return_inverse=True)
    return kept, np.bincount(at, weights, len(kept)).astype(np.float32)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int, rate: float) -> tuple[np.ndarray, float]:
    """Trains embeddings and softmax together; returns what each bucket adds to the
    difference of the logits, and the bias."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    weights, bias = rng.normal(0, 0.5, (WIDTH, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen = [np.full(x.shape, 1e-8, np.float32) for x in (vectors, weights, bias)]
    order = np.arange(len(bags))
    for _ in range(epochs):
        rng.shuffle(order)
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            sizes = np.array([len(bags[k][0]) for k in rows])
            ids, share = (np.concatenate([bags[k][part] for k in rows]) for part in (0, 1))
            means = np.zeros((len(rows), WIDTH), np.float32)
            full = sizes > 0
            if full.any():
                means[full] = np.add.reduceat(vectors[ids] * share[:, None], (np.cumsum(sizes) - sizes)[full], axis=0)
            logits = means @ weights + bias
            delta = np.exp(logits - logits.max(1, keepdims=True))
            delta /= delta.sum(1, keepdims=True)
            delta[np.arange(len(rows)), y[rows]] -= 1
            delta /= len(rows)
            back = (delta @ weights.T)[np.repeat(np.arange(len(rows)), sizes)] * share[:, None]
            used, where = np.unique(ids, return_inverse=True)
            step = np.stack([np.bincount(where, back[:, k], len(used)) for k in range(WIDTH)], 1).astype(np.float32)
            seen[0][used] += step * step
            vectors[used] -= rate * step / np.sqrt(seen[0][used])
            for x, g, s in ((weights, means.T @ delta, seen[1]), (bias, delta.sum(0), seen[2])):
                s += g * g
                x -= rate * g / np.sqrt(s)
    return vectors @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0])


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through the scores (Newton steps, a little ridge)."""
    a = np.array([1.0, 0.0])
    both = np.stack([x, np.ones(len(x))], 1)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(both @ a, -30, 30)))
        slope = both.T @ (p - y) + 1e-3 * a
        bend = (both * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ both + 1e-3 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        a = a - move / max(1.0, np.abs(move).max())
    return float(a[0]), float(a[1])


def train(texts: list[str | None], labels: list[int]) -> tuple[np.ndarray, float, float] | None:
    """Bucket logits, slope and intercept; None if a class has no text."""
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        return None
    words = [words_of(x) for x in texts]
    by_bucket, _ = fit([bag(sorted(set(w))) for w in words], y, EPOCHS[0], RATE[0])
    rng = np.random.default_rng(SEED)
    for _ in range(ROUNDS):
        logits, bags, classes = Logits(by_bucket), [], []
        for w, label in zip(words, labels, strict=True):
            means, starts = logits.windows(w)
            ranked = np.argsort(-means, kind="stable")
            picked = ranked[: max(1, min(4, len(w) // 200 + 1))] if label else np.concatenate((ranked[:3], rng.integers(0, len(starts), 4)))
            for k in picked:
                bags.append(bag(w[starts[k] : starts[k] + WINDOW]))
                classes.append(label)
        by_bucket, _ = fit(bags, np.array(classes), EPOCHS[1], RATE[1])
    logits = Logits(by_bucket)
    slope, intercept = calibrate(np.array([logits.windows(w)[0].max() for w in words]), y)
    return by_bucket.astype(np.float32), slope, intercept


_models: dict[str, Logits] = {}


def scored(spark: SparkSession, text: Column, model: tuple[np.ndarray, float, float] | None) -> Column:
    """The probability of label 1 for each text."""
    if model is None:
        return F.lit(0.0)
    by_bucket, slope, intercept = model
    content = by_bucket.astype(np.float32).tobytes()
    shared, key = spark.sparkContext.broadcast(content), hashlib.sha256(content).hexdigest()  # BUCKETS floats

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        if key not in _models:
            _models.clear()
            _models[key] = Logits(np.frombuffer(shared.value, np.float32))
        logits = _models[key]
        x = slope * np.array([logits.windows(words_of(t.as_py()))[0].max() for t in texts]) + intercept
        return pa.array(1 / (1 + np.exp(-np.clip(x, -500, 500))), pa.float64())

    return run(text)


def training_rows(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS, longest: int = LONGEST) -> DataFrame:
    """text and label of the bounded sample: of each class the first ids by a hash, each of
    them once, whose crc32 mod 3 isn't 1.  An id with both labels is toxic; of several texts
    of an id the least counts; texts of more than ``longest`` bytes don't."""
    usable = chosen(labels, doc_id="doc_id", label="toxic").filter(F.col("label").isin(0, 1) & (crc_mod(F.col("doc_id"), 3) != 1))
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("place", F.xxhash64("doc_id"))
    first = [usable.filter(F.col("label") == k).orderBy("place", "doc_id").limit(n) for k, n in enumerate(per_class)]
    sample = stored(first[0].unionByName(first[1]), "sample")  # sum(per_class) rows at most
    own = chosen(docs, doc_id="doc_id", text="text").filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest)
    return own.join(F.broadcast(sample), "doc_id").groupBy("label", "place", "doc_id").agg(F.min("text").alias("text")).orderBy("label", "place", "doc_id")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, per_class: tuple[int, int] = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    rows = training_rows(docs, labels, per_class).select("text", "label").collect()
    model = train([r["text"] for r in rows], [r["label"] for r in rows])
    made = chosen(docs, doc_id="doc_id", text="text").select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), scored(spark, F.col("text"), model).alias("score"))
    return made.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
