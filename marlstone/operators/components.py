"""Connected components of links, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checkpoints import cut


def components(links: DataFrame) -> DataFrame:
    """id and root (the smallest id of its component) of every node of ``links`` (a, b) that
    has a link to another one.

    Star contraction: each node's larger neighbours are linked to its smallest one, then its
    smaller ones are; both steps group by a node, keep the components and halve the paths, so
    n nodes take some log n rounds.  A round has no more links than the one before."""
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = cut(small.unionByName(lowest.select("u", F.col("low").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = edges.select(F.col("v").alias("id")).distinct()
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots.select("id", F.col("id").alias("root")))
        before = now
