"""Exact top-k search by inner product (operator 10).

Candidates lie in blocks, each block column by column; queries come in blocks as well, and
every block of queries meets every block of candidates: ``TOGETHER`` query blocks at a time
come to one copy of a candidate block, in the narrowest integers that hold them.  The first
candidate block is searched ahead, and each query's k-th score there bounds it in all the
others.  For a query, the product is
accumulated over one block of dimensions after another.  What the remaining dimensions
can still add is at most the product of the two remaining norms; candidates whose partial
sum and this bound stay under the k-th best sum known so far are dropped, and the
survivors are compacted before the next block of dimensions.

Defined results: a vector takes no part if it is null or holds a null, NaN or infinite
component; shorter vectors count as padded with zeros (an empty one scores 0 with all);
a null id is never a query and comes last among ties; repeated rows are separate
candidates; a query with fewer than k candidates gets all of them; an empty table gives
no rows.  Scores beyond the range of a long are kept modulo 2^64, as a long sum would be.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chosen, stored, table

#: Dimensions that are accumulated before survivors are compacted.
DIMENSIONS = 16
#: Vectors in a block of candidates and in a block of queries.
CANDIDATES, QUERIES, TOGETHER = 16_384, 256, 4
#: Candidates with the best first sums that are scored in full to get a first bound.
PROBES = 32


def padded(lists: pa.ListArray) -> np.ndarray:
    """Lists of integers as rows of a matrix in the narrowest type, zeros after short ones."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    most = max((int(flat.max()), -int(flat.min()) - 1), default=0) if len(flat) else 0
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def widened(x: np.ndarray, width: int) -> np.ndarray:
    """With rows of zeros up to ``width``."""
    return np.vstack([x, np.zeros((width - len(x), x.shape[1]), x.dtype)])


def search(queries: np.ndarray, query_rows: np.ndarray, columns: np.ndarray, rows: np.ndarray, k: int, step: int = DIMENSIONS, bars: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the positions and scores of its k best columns, best first, ties to
    smaller positions.  ``columns`` has a row for each dimension and a column for each
    candidate; a candidate whose row number is the query's own takes no part.  ``bars``:
    scores that the result needs nothing below of, for each query."""
    width, n = columns.shape
    most = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    exact = most(queries) * most(columns) * max(width, 1) < 2**53  # then doubles hold each sum without error
    wide = np.float64 if exact else np.int64
    first = np.argsort(-np.square(columns, dtype=np.float64).sum(1), kind="stable")  # heavy dimensions first
    columns, queries = np.ascontiguousarray(columns[first]).astype(wide), queries[:, first].astype(wide)
    cuts = list(range(0, width, step))
    mass = lambda x, axis: [np.sqrt(np.square(x[c:] if axis == 0 else x[:, c:], dtype=np.float64).sum(axis)) for c in (*cuts[1:], width)]
    column_mass, query_mass = mass(columns, 0), mass(queries, 1)
    found = []
    for q, own in zip(range(len(queries)), query_rows, strict=True):
        left = np.flatnonzero(rows != own)
        sums = np.zeros(len(left), wide)
        bar = -math.inf if bars is None else bars[q]
        for b, c in enumerate(cuts):
            block = columns[c : c + step]
            sums = sums + queries[q, c : c + step] @ (block if len(left) == n else block[:, left])
            if not len(left) or len(left) <= k and bars is None or b == len(cuts) - 1 or not exact:
                continue
            if b == 0 and len(left) > k:
                probe = left[np.argpartition(-sums, min(PROBES, len(sums)) - 1)[:PROBES]]
                whole = queries[q] @ columns[:, probe]
                if len(whole) >= k:
                    bar = max(bar, np.partition(whole, len(whole) - k)[len(whole) - k])
            rest = query_mass[b][q] * column_mass[b][left]
            rest += 1e-9 * rest + 1e-6  # the norms are rounded
            if len(left) > k:
                bar = max(bar, np.partition(sums - rest, len(sums) - k)[len(sums) - k])
            alive = sums + rest >= bar
            left, sums = left[alive], sums[alive]
        best = np.lexsort((left, -sums))[:k]
        found.append((left[best], sums[best].astype(np.int64)))
    return found


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each query in ``vectors`` (vec_id, embedding)."""
    own = chosen(vectors, vec_id="vec_id", embedding="embedding")
    x = F.col("embedding")
    sound = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    made = own.filter(sound).select("vec_id", F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("v"), F.monotonically_increasing_id().alias("row"))
    made = stored(made, "vectors")
    is_query = F.col("vec_id") % every == 0
    n, n_queries = made.agg(F.count(F.lit(1)), F.coalesce(F.count_if(is_query), F.lit(0))).first()
    n_blocks, q_blocks = max(1, -(-n // CANDIDATES)), max(1, -(-n_queries // QUERIES))

    def pack(rows: pa.Table) -> pa.Table:
        """One row for a block: ids and row numbers (by id, nulls last), bars, then the matrix column by column."""
        ids = rows["vec_id"].combine_chunks()
        order = np.lexsort((rows["row"].to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
        rows = rows.take(pa.array(order))
        matrix = padded(rows["v"].combine_chunks())
        block = {"part": [rows["part"][0].as_py()], "ids": [rows["vec_id"].to_pylist()], "rows": [rows["row"].to_pylist()], "bars": [rows["bar"].to_pylist()]}
        return pa.table(block | {"kind": [matrix.dtype.str], "matrix": [np.ascontiguousarray(matrix.T).tobytes()]}, schema=packed)

    packed = pa.schema([("part", pa.int32()), ("ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64())), ("bars", pa.list_(pa.int64())), ("kind", pa.string()), ("matrix", pa.binary())])
    shape = "part int, ids array<bigint>, rows array<bigint>, bars array<bigint>, kind string, matrix binary"
    dealt = lambda df, parts: df.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")).groupBy("part").applyInArrow(pack, shape)
    none = F.lit(None).cast("bigint")
    candidates = stored(dealt(made.withColumn("bar", none), n_blocks), "candidates")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for c in left.to_pylist():  # one block, or none
            columns = np.frombuffer(c["matrix"], c["kind"]).reshape(-1, len(c["ids"]))
            ids, rows = pa.array(c["ids"], pa.int64()), np.array(c["rows"])
            for i in range(right.num_rows):
                q = {x: right[x][i].as_py() for x in ("ids", "rows", "bars", "kind", "matrix")}
                own = np.frombuffer(q["matrix"], q["kind"]).reshape(-1, len(q["ids"]))
                width = max(len(columns), len(own))
                bars = np.array([-math.inf if x is None else x for x in q["bars"]])
                found = search(widened(own, width).T, np.array(q["rows"]), widened(columns, width), rows, k, bars=bars if np.isfinite(bars).any() else None)
                sizes = [len(at) for at, _ in found]
                at = np.concatenate([a for a, _ in found]).astype(np.int64)
                out.append(pa.table([np.repeat(np.array(q["rows"], np.int64), sizes), pa.array(q["ids"], pa.int64()).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))), ids.take(pa.array(at)), np.concatenate([s for _, s in found])], schema=met))
        return pa.concat_tables(out) if out else met.empty_table()

    met = pa.schema([(c, pa.int64()) for c in ("query_row", "query_id", "vec_id", "score")])

    def against(blocks: DataFrame, queries: DataFrame, parts: list[int]) -> DataFrame:
        """All query blocks against the candidate blocks ``parts`` (from, to)."""
        salts = max(1, -(-q_blocks // TOGETHER))
        left = blocks.filter(F.col("part").between(*parts)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        right = queries.withColumn("salt", F.floor(F.col("part") / TOGETHER).cast("int")).withColumn("part", F.explode(F.sequence(*map(F.lit, parts))))
        keys = ["part", "salt"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_row bigint, query_id bigint, vec_id bigint, score bigint")

    asked = made.filter(is_query)
    best = against(candidates, dealt(asked.withColumn("bar", none), q_blocks), [0, 0])
    if n_blocks > 1:
        best = stored(best, "first")
        bars = best.groupBy(F.col("query_row").alias("row")).agg(F.min("score").alias("bar"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k).drop("n")
        best = best.unionByName(against(candidates, dealt(asked.join(bars, "row", "left"), q_blocks), [1, n_blocks - 1]))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.rid AS qrid, q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY qrid ORDER BY score DESC, vec_id ASC NULLS LAST) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
