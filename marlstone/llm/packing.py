"""Best-fit packing into bins of several permitted lengths (operator 1).

A document's tokens are its words ``[^\\x20\\x09-\\x0D]+`` and an end token, or what a tokenizer
made of it; a document longer than the greatest permitted length is cut into pieces of that length and a rest.  Pieces
are taken by falling length.  Each goes to the open bin that it leaves least room in; if
none has room, a bin is opened at the permitted length of the least expected cost a token:
the cost of each length is set against the fill that it would reach, the piece and then
greedily the longest pieces still to come that fit.  At the end, every bin shrinks to the
shortest permitted length that holds its contents.

Pieces are dealt to shards by a hash of id, text and piece, so each shard is a random part of
the corpus however its files are split, and shards are packed independently; the shard
count follows the number of pieces.  Only lengths are packed; then each document's tokens
are cut into its pieces, and the pieces of a bin meet and are joined to a sequence.

Defined results: a null or empty text is its end token alone; rows equal in id and text are
numbered and packed each; an empty table gives no rows; other columns are never read.  Among
bins with equal room the one opened first wins, among equal lengths the smaller id (null
first), then the order of a hash of the text, the row's number and the piece.
"""

from __future__ import annotations

import re
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucketed, chosen, dropped, stored, table
from .repeats import halves

LENGTHS = (512, 1024, 2048, 4096)
#: Cost of a bin besides its length, in tokens.
OVERHEAD = 64
#: Pieces in a shard.
SHARD = 40_000
#: Equal rows that are numbered from one range, so that no array is as long as there are of them.
COPIES = 10_000
#: Closes each document among words, of which none is empty.
END = ""
_WORD = re.compile("[^\\x20\\x09-\\x0d]+")
#: Names a row: a digest of its id and text, and which of its equals it is.
ROW = ("h1", "h2", "copy")


def n_tokens(text: Column) -> Column:
    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array((len((x.as_py() or "").encode().split()) + 1 for x in texts), pa.int64())

    return run(text)


def best_fit(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> tuple[list[int], list[int]]:
    """The bin of each piece and the final length of each bin; ``sizes`` must fall and
    lie between 1 and the greatest length."""
    lengths = tuple(sorted(lengths))
    waiting: dict[int, int] = {}
    for s in sizes:
        waiting[s] = waiting.get(s, 0) + 1
    ahead = sum(1 << s for s in waiting)  # a bit for each length that still waits
    room: dict[int, list[int]] = {}
    rooms = 0  # a bit for each amount of room that an open bin has
    bins, free, size_of = [], [], []

    def reached(length: int, s: int) -> int:
        """The fill of a new bin: ``s``, then the longest waiting pieces that fit."""
        space, bits = length - s, ahead
        while space and (bits := bits & ((2 << space) - 1)):
            longest = bits.bit_length() - 1
            space -= min(waiting[longest], space // longest) * longest
            bits ^= 1 << longest
        return length - space

    for s in sizes:
        waiting[s] -= 1
        if not waiting[s]:
            ahead ^= 1 << s
        if fits := rooms >> s:
            had = s + (fits & -fits).bit_length() - 1
            b = heappop(room[had])
            if not room[had]:
                del room[had]
                rooms ^= 1 << had
        else:
            length = min((x for x in lengths if x >= s), key=lambda x: (x + overhead) / reached(x, s))
            b, had = len(free), length
            free.append(length)
            size_of.append(length)
        bins.append(b)
        free[b] = left = had - s
        if left:
            if left in room:
                heappush(room[left], b)
            else:
                room[left] = [b]
                rooms |= 1 << left
    final = [next(x for x in lengths if x >= length - left) for length, left in zip(size_of, free, strict=True)]
    return bins, final


def _placed(rows: DataFrame, lengths: tuple[int, ...], overhead: int, shard: int) -> DataFrame:
    """Pieces and their places, of rows (doc_id, h1, h2, n: tokens, copies: how many are equal)."""
    most = max(lengths)
    rows = stored(rows.select("doc_id", "h1", "h2", "n", "copies"), "lengths")
    count = rows.agg(F.sum(F.ceil(F.col("n") / most) * F.col("copies"))).first()[0] or 0
    steps = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"), F.lit(COPIES).cast("bigint")))
    each = rows.select("doc_id", "h1", "h2", "n", "copies", steps.alias("low"))
    each = each.select("doc_id", "h1", "h2", "n", F.explode(F.sequence("low", F.least(F.col("low") + COPIES - 1, F.col("copies")))).alias("copy"))
    pieces = each.select("doc_id", *ROW, "n", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / most).cast("int") - 1)).alias("piece"))
    start = F.col("piece").cast("long") * most
    pieces = pieces.select("doc_id", *ROW, "piece", start.alias("start"), F.least(F.lit(most).cast("long"), F.col("n") - start).alias("n_tokens"))
    sharded = pieces.withColumn("shard", F.pmod(F.xxhash64(*ROW, "piece"), F.lit(max(1, -(-count // shard)))).cast("int"))

    def one(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("n_tokens", "descending"), *[(c, "ascending") for c in ("doc_id", *ROW, "piece")]])
        sizes = rows["n_tokens"].to_pylist()
        bins, final = best_fit(sizes, lengths, overhead)
        filled, slots, slot, offset = [0] * len(final), [0] * len(final), [], []
        for b, s in zip(bins, sizes, strict=True):
            slot.append(slots[b])
            offset.append(filled[b])
            slots[b] += 1
            filled[b] += s
        ids = np.array(bins, np.int64) + (rows["shard"][0].as_py() << 32)
        made = {"bin_id": pa.array(ids), "bin_length": pa.array([final[b] for b in bins], pa.int32()), "slot": pa.array(slot, pa.int32()), "bin_offset": pa.array(offset, pa.int32())}
        return pa.table({x: rows[x] for x in ("doc_id", *ROW, "piece", "start", "n_tokens")} | made)

    shape = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, h1 bigint, h2 bigint, copy bigint, piece int, start bigint, n_tokens bigint, bin_id bigint, bin_length int, slot int, bin_offset int"
    return sharded.groupBy("shard").applyInArrow(one, shape)


def _own(docs: DataFrame, body: Column | None = None) -> DataFrame:
    rows = chosen(docs, doc_id="doc_id", text="text")
    name = F.concat(F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("")), F.lit("\x00"), F.coalesce(F.col("text"), F.lit("")))
    h1, h2 = halves(name)
    return rows.select("doc_id", h1.alias("h1"), h2.alias("h2"), (F.col("text") if body is None else body).alias("body"))


def pack(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, shard: int = SHARD) -> DataFrame:
    """One row for each piece: doc_id, piece (from 0), start and n_tokens (in the document's
    words), bin_id, bin_length, slot (in the bin, from 0) and bin_offset (in its tokens)."""
    rows = _own(docs).select("doc_id", "h1", "h2", n_tokens(F.col("body")).alias("n"))
    return _placed(rows.groupBy("doc_id", "h1", "h2", "n").agg(F.count(F.lit(1)).alias("copies")), lengths, overhead, shard).drop(*ROW)


def packed(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, shard: int = SHARD, tokens: Column | None = None) -> DataFrame:
    """One row for each bin: bin_id, bin_length, n_tokens, and of its pieces in order the
    arrays doc_ids, starts (in the document's tokens), sizes and parts, which joined are the
    sequence.  ``tokens`` makes an array of tokens of the column ``text``, and a part is
    such an array; without it tokens are words and END, and a part joins them by a space."""
    rows = _own(docs, tokens).groupBy("h1", "h2").agg(F.first("doc_id").alias("doc_id"), F.first("body").alias("body"), F.count(F.lit(1)).alias("copies"))
    bodies = bucketed(rows, ["h1", "h2"], "bodies")  # one shuffle of the texts; the join below needs none
    n = n_tokens(F.col("body")) if tokens is None else F.size("body").cast("bigint")
    placed = stored(_placed(bodies.withColumn("n", n), lengths, overhead, shard), "placed")
    place = F.struct("start", "n_tokens", "bin_id", "bin_length", "slot")
    places = stored(placed.groupBy(*ROW).agg(F.collect_list(place).alias("places")), "places")  # of one document
    dropped(placed)
    as_words = tokens is None
    kind = "string" if as_words else bodies.schema["body"].dataType.simpleString()
    id_kind = bodies.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            at = {c: batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "body", "places")}
            take, columns, sizes, parts = [], {c: [] for c in ("bin_id", "bin_length", "slot", "start")}, [], []
            for i, (body, own) in enumerate(zip(at["body"], at["places"].to_pylist(), strict=True)):
                whole = [*_WORD.findall(body.as_py() or ""), END] if as_words else body.values
                for p in own:
                    take.append(i)
                    for c, v in columns.items():
                        v.append(p[c])
                    part = whole[p["start"] : p["start"] + p["n_tokens"]]
                    sizes.append(len(part))
                    parts.append(" ".join(part) if as_words else part)
            none = pa.array([], pa.string() if as_words else at["body"].type.value_type)
            made = pa.array(parts, pa.string()) if as_words else pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]).astype(np.int32)), pa.concat_arrays(parts) if parts else none)
            yield pa.record_batch({"bin_id": pa.array(columns["bin_id"], pa.int64()), "bin_length": pa.array(columns["bin_length"], pa.int32()), "slot": pa.array(columns["slot"], pa.int32()), "doc_id": at["doc_id"].take(pa.array(take, pa.int64())), "start": pa.array(columns["start"], pa.int64()), "size": pa.array(sizes, pa.int32()), "part": made})

    joined = bodies.join(places, ["h1", "h2"]).select("doc_id", "body", "places")
    pieces = joined.mapInArrow(cut, f"bin_id bigint, bin_length int, slot int, doc_id {id_kind}, start bigint, size int, part {kind}")
    bins = pieces.groupBy("bin_id", "bin_length").agg(F.sum("size").cast("int").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("slot", "doc_id", "start", "size", "part"))).alias("p"))  # a bin's, so few
    listed = [F.col(f"p.{c}").alias(name) for name, c in (("doc_ids", "doc_id"), ("starts", "start"), ("sizes", "size"), ("parts", "part"))]
    return bins.select("bin_id", "bin_length", "n_tokens", *listed)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences' places and contents, these as SHA-256 of the words joined by a space."""
    made = packed(table(spark, sf_dir, "documents"))
    return made.withColumn("tokens_sha256", F.sha2(F.array_join("parts", " "), 256)).drop("parts")
