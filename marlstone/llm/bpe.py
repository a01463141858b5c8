"""Byte-level BPE encoding and decoding (operator 6).

The merges of one pre-token are driven by a rank queue: a bucket for each merge rank
holds the linked-list positions where that merge is possible, and a bitmap of two levels
over the ranks finds the lowest non-empty bucket with find-first-set.  Entries are never
removed when a merge changes their pair; they are skipped as stale when they come up.
A pre-token of n bytes takes about n log n steps, so very long ones are harmless.

Null text: encoded as the empty text (no tokens).  Each row is treated alone, so repeated
rows, ties and empty tables need no special care; only the text column is read.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chosen, table

#: Cached pre-tokens in a Python worker (some 250 bytes each); when full, the cache starts
#: anew.  The smaller cache is for plans whose other steps need the memory.
CACHE_ENTRIES, FEWER_ENTRIES = 1_000_000, 250_000
#: Longer pre-tokens aren't cached.
CACHE_BYTES = 64


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """The rank file: one line per token, its bytes in base64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


class RankQueue:
    """Buckets per rank under a hierarchical bitmap: a bit for each rank in words of 256,
    and a bit in ``top`` for each word that isn't zero.  ``Encoder.merge`` works on the
    fields directly, as a call for each step would cost more than the step."""

    def __init__(self, n_ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.words = [0] * (n_ranks // 256 + 1)
        self.top = 0
        self.bits = [1 << i for i in range(max(256, len(self.words)))]


class Encoder:
    """Encodes and decodes under one rank table and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, entries: int = CACHE_ENTRIES):
        self.ranks, self.entries = ranks, entries
        self.pieces = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.tokens}
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The token ids of one pre-token."""
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        queue = self.queue
        buckets, words, bits, top = queue.buckets, queue.words, queue.bits, 0
        n = len(piece)
        end = list(range(1, n + 2))  # of the part that starts at each position, where the next one starts
        before = list(range(-1, n))
        due = [get(piece[i : i + 2], -1) for i in range(n - 1)]  # the rank of the merge of the part here with the next one
        due.append(-1)
        for i, rank in enumerate(due):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)  # positions ascend, which is heap order
                else:
                    buckets[rank] = [i]
                    words[rank >> 8] |= bits[rank & 255]
                    top |= bits[rank >> 8]
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            rank = (w << 8) + (word & -word).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                words[w] = word = word & (word - 1)
                if not word:
                    top &= top - 1
            if due[i] != rank:
                continue  # stale
            j = end[i]
            due[j] = -1
            end[i] = k = end[j]
            h = before[i]
            if k < n:
                before[k] = i
                due[i] = new = get(piece[i : end[k]], -1)
                if new >= 0:
                    if new in buckets:
                        heappush(buckets[new], i)
                    else:
                        buckets[new] = [i]
                        words[new >> 8] |= bits[new & 255]
                        top |= bits[new >> 8]
            else:
                due[i] = -1
            if h >= 0:
                new = get(piece[h:k], -1)
                if new != due[h]:
                    due[h] = new
                    if new >= 0:
                        if new in buckets:
                            heappush(buckets[new], h)
                        else:
                            buckets[new] = [h]
                            words[new >> 8] |= bits[new & 255]
                            top |= bits[new >> 8]
        ids, i = [], 0
        while i < n:
            j = end[i]
            ids.append(get(piece[i:j]))
            i = j
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        cache, extend = self.cache, ids.extend
        for piece in self.pieces(text):
            known = cache.get(piece)
            if known is None:
                known = tuple(self.merge(piece.encode()))
                if len(piece) <= CACHE_BYTES:
                    if len(cache) >= self.entries:
                        cache.clear()
                    cache[piece] = known
            extend(known)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_encoders: dict[tuple[str, str, int], Encoder] = {}


def _encoder(shared, pattern: str, entries: int = CACHE_ENTRIES) -> Encoder:
    """One encoder for each vocabulary in a Python worker."""
    content = shared.value
    key = hashlib.sha256(content).hexdigest(), pattern, entries
    if key not in _encoders:
        _encoders[key] = Encoder(parse_ranks(content), pattern, entries)
    return _encoders[key]


def _vocabulary(spark: SparkSession, vocabulary: str):
    """The rank file's bytes for the executors; its size is that of a vocabulary (under a MB)."""
    with open(vocabulary, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(spark: SparkSession, text: Column, vocabulary: str, pattern: str, entries: int = CACHE_ENTRIES) -> Column:
    """``array<int>``: the token ids of each text."""
    shared = _vocabulary(spark, vocabulary)

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        encoder = _encoder(shared, pattern, entries)
        return pa.array((encoder.encode(x.as_py() or "") for x in texts), pa.list_(pa.int32()))

    return run(text)


def decode(spark: SparkSession, ids: Column, vocabulary: str, pattern: str) -> Column:
    """``binary``: the bytes that token ids stand for (null: empty)."""
    shared = _vocabulary(spark, vocabulary)

    @F.arrow_udf("binary")
    def run(lists: pa.Array) -> pa.Array:
        encoder = _encoder(shared, pattern)
        return pa.array((encoder.decode(x.as_py() or []) for x in lists), pa.binary())

    return run(ids)


def round_trip(spark: SparkSession, text: Column, vocabulary: str, pattern: str) -> Column:
    """Encodes and decodes in one pass: ``struct<n_tokens, ids_sha256, decoded_sha256>``."""
    shared = _vocabulary(spark, vocabulary)

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def run(texts: pa.Array) -> pa.Array:
        encoder, sha = _encoder(shared, pattern), hashlib.sha256
        counts, ids_sha, decoded_sha = [], [], []
        for x in texts:
            ids = encoder.encode(x.as_py() or "")
            counts.append(len(ids))
            ids_sha.append(sha(" ".join(map(encoder.names.__getitem__, ids)).encode()).hexdigest())
            decoded_sha.append(sha(encoder.decode(ids)).hexdigest())
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return run(text)


def closed(spark: SparkSession, text: Column, vocabulary: str | None = None, pattern: str | None = None) -> Column:
    """``array<int>``: a text's token ids and, to close it, an id that is no token's."""
    import public_tokenizers

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        end = max(parse_ranks(f.read()).values(), default=-1) + 1
    return F.array_append(encode(spark, text, path, pattern or public_tokenizers.PATTERN, FEWER_ENTRIES), F.lit(end))


def op6_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    import public_tokenizers

    docs = chosen(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    made = round_trip(spark, F.col("text"), vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN)
    return docs.select("doc_id", made.alias("made")).select("doc_id", "made.*")
