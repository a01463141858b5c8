"""Token counts (operator 13), as a public library's tokenizer gives them for whole texts.

A huge document isn't encoded in one piece.  It is read in chunks that overlap, each encoded
with offsets, and the chunks are spliced where their pre-tokens provably coincide:

- A pre-token of a byte-level BPE is a match of a pattern that looks at no more than two
  code points behind the match, or three behind its start, and at nothing before it; the
  text is first cut at the vocabulary's added tokens, which are found the same way.  What
  follows a border between pre-tokens therefore depends on the text from there on alone.
- So the borders of a chunk that starts at a true border are true up to ``margin`` (the
  longest added token and three) before its end; later ones may be effects of the cut.
- The next chunk starts anywhere within the overlap, perhaps inside a pre-token.  Where it
  has a border that is a true border of the chunk before, it is right from there on.
- If no border is common, the overlap is doubled, and once it would reach the last splice
  the chunk before is lengthened instead (a pre-token longer than a chunk is encoded whole,
  as its merges may depend on all of it).

Only borders between pre-tokens count: a border between two tokens of one word isn't safe,
although it may be common.  Tokens between splices are counted and forgotten, so memory is
that of two chunks and the longest pre-token.  Ordinary documents are encoded together, a
few hundred KB at a time.

Vocabularies whose borders can't be proven in this way (a normalizer, another pattern, a
prefix space, added tokens that take spaces with them) are refused.

Defined results: a null text is taken as empty and has no tokens; rows stand alone, so
repeated rows get equal counts; an empty table gives no rows.  Counts are an expression over
the text, so other columns can't clash with anything.
"""

from __future__ import annotations

import hashlib
import json
import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chosen, table

#: Code points of a chunk, and of the overlap with the one before.
CHUNK, OVERLAP = 32_768, 256
#: Code points of ordinary texts that are encoded together.
TOGETHER = 1 << 18
#: Tokens beyond which a text is marked.
LIMIT = 1024


class Piece:
    """The tokens of one stretch of a text, and the places of its pre-tokens."""

    def __init__(self, encoding, start: int, end: int):
        self.start, self.end, self.tokens = start, end, len(encoding)
        #: of each border, how many tokens come before it
        self.borders: dict[int, int] = {}
        last = None
        for i, (word, (at, _)) in enumerate(zip(encoding.word_ids, encoding.offsets, strict=True)):
            if word != last:
                self.borders[start + at], last = i, word


class TokenCounter:
    """Counts tokens under one vocabulary (the library's JSON)."""

    def __init__(self, content: bytes, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        kind = json.loads(content)
        before, added = kind.get("pre_tokenizer") or {}, kind.get("added_tokens") or []
        fixed = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not kind.get("normalizer")
        if not fixed or any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in added):
            raise ValueError("splices are proven for byte-level BPE without normalizer and prefix space only")
        self.library = Tokenizer.from_buffer(content)
        self.library.no_truncation()
        self.library.no_padding()
        self.margin = 3 + max((len(x["content"]) for x in added), default=0)
        self.chunk, self.overlap = max(1, chunk), max(1, overlap)
        #: how often an overlap was widened
        self.widened = 0

    def _piece(self, text: str, start: int, end: int) -> Piece:
        end = min(len(text), end)
        return Piece(self.library.encode(text[start:end], add_special_tokens=False), start, end)

    def spliced(self, text: str) -> int:
        """The tokens of one text, chunk by chunk."""
        total, at = 0, 0  # tokens before the border ``at``, which is true
        left = self._piece(text, 0, self.chunk)
        while left.end < len(text):
            overlap, splice = self.overlap, None
            while splice is None and overlap < left.end - at:
                right = self._piece(text, left.end - overlap, left.end + self.chunk)
                splice = min((x for x in right.borders if at < x <= left.end - self.margin and x in left.borders), default=None)
                overlap *= 2
                self.widened += splice is None
            if splice is None:
                left = self._piece(text, at, at + 2 * max(self.chunk, left.end - at))
                continue
            total += left.borders[splice] - left.borders[at]
            left, at = right, splice
        return total + left.tokens - left.borders.get(at, left.tokens)

    def counts(self, texts) -> list[int]:
        """The tokens of each text (null: none)."""
        made: list[int] = []
        waiting: list[tuple[int, str]] = []
        size = 0

        def encode():
            found = self.library.encode_batch_fast([t for _, t in waiting], add_special_tokens=False)
            for (i, _), x in zip(waiting, found, strict=True):
                made[i] = len(x)
            waiting.clear()

        for text in texts:
            made.append(0)
            if text and len(text) > self.chunk:
                made[-1] = self.spliced(text)
            elif text:
                waiting.append((len(made) - 1, text))
                size += len(text)
                if size >= TOGETHER:
                    encode()
                    size = 0
        encode()
        return made


_counters: dict[tuple[str, int, int], TokenCounter] = {}


def _counter(content: bytes, chunk: int, overlap: int) -> TokenCounter:
    """One counter for each vocabulary in a Python worker."""
    key = hashlib.sha256(content).hexdigest(), chunk, overlap
    if key not in _counters:
        _counters[key] = TokenCounter(content, chunk, overlap)
    return _counters[key]


def token_counts(spark: SparkSession, text: Column, vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """``bigint``: the tokens of each text.  The vocabulary (a few MB) is broadcast."""
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    TokenCounter(shared.value)  # refused here rather than in a task

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(_counter(shared.value, chunk, overlap).counts(x.as_py() for x in texts), pa.int64())

    return run(text)


def op13_tokens(spark: SparkSession, sf_dir: str, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    import public_tokenizers

    docs = chosen(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    n_tokens = token_counts(spark, F.col("text"), vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
    made = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), n_tokens.alias("n_tokens"))
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
