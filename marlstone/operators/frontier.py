"""Which addresses to fetch: skip rules, joins with cache and records, closures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checkpoints import cut
from .dedupe import first_by


def should_skip(status: Column, retry_failed: bool = True) -> Column:
    """F2."""
    skip = status == "success"
    return F.coalesce(skip if retry_failed else skip | (status == "failed"), F.lit(False))


def planned(urls: DataFrame, cache: DataFrame, records: DataFrame, retry_failed: bool = True, resume: bool = True) -> DataFrame:
    """Each address (url, ord, slug) with an action: ``cached`` (its record is
    at hand), ``known`` (a record has its slug or its url) or ``fetch``.  A cached success
    whose record is gone is fetched again (Q12).  cache: url, status, article_slug;
    records: slug, article_url.  Sides are joined by key; the planner broadcasts one only
    under its size threshold."""
    own = first_by(urls, ["url"], ["ord"])
    if not resume:
        return own.withColumns({"status": F.lit(None).cast("string"), "record_slug": F.lit(None).cast("string"), "action": F.lit("fetch")})
    slugs = records.groupBy(F.col("slug").alias("found_slug")).agg(F.first("article_url").alias("found_url")).select("found_slug")
    by_url = records.groupBy(F.lower("article_url").alias("found_url")).agg(F.min("slug").alias("url_slug"))
    joined = (
        own.join(cache.select("url", "status", "article_slug"), "url", "left")
        .join(slugs.withColumnRenamed("found_slug", "cached_slug"), F.col("article_slug") == F.col("cached_slug"), "left")
        .join(slugs, F.col("slug") == F.col("found_slug"), "left")
        .join(by_url, F.lower("url") == F.col("found_url"), "left")
    )
    skip = should_skip(F.col("status"), retry_failed)
    failed = F.col("status") == "failed"
    action = F.when(skip & F.col("cached_slug").isNotNull(), "cached").when(skip & failed, "skipped").when(F.coalesce("found_slug", "url_slug").isNotNull(), "known").otherwise("fetch")
    record = F.when(action == "cached", F.col("cached_slug")).when(action == "known", F.coalesce("found_slug", "url_slug"))
    return joined.select(*own.columns, "status", record.alias("record_slug"), action.alias("action"))


def pending(plan: DataFrame) -> DataFrame:
    """What is left to fetch."""
    return plan.filter(F.col("action") == "fetch")


def union_sources(*sources: DataFrame) -> DataFrame:
    """Several lists (url, ord), one after the other, the first of equals kept."""
    tagged = [s.select("url", F.struct(F.lit(i).alias("list"), F.col("ord").cast("bigint").alias("ord")).alias("place")) for i, s in enumerate(sources)]
    whole = tagged[0]
    for t in tagged[1:]:
        whole = whole.unionByName(t)
    return first_by(whole, ["url"], ["place"])


#: Levels after which the nodes found so far are written as one table.
TOGETHER = 32


def closure(roots: DataFrame, edges: DataFrame, most_levels: int | None = None) -> DataFrame:
    """Nodes reached from the roots (node), breadth first, with their level.
    edges: src, dst.  One join a level, until a level is empty, as it is sooner or later where
    the edges are a table.  ``most_levels``, if given, guards against a source that makes
    nodes without end, and raises when it is passed."""
    found = cut(roots.select("node").distinct().withColumn("level", F.lit(0)))
    last, level = found, 0
    while True:
        level += 1
        reached = edges.join(last.select(F.col("node").alias("src")), "src").select(F.col("dst").alias("node")).distinct()
        last = cut(reached.join(found, "node", "left_anti").withColumn("level", F.lit(level)))
        if not last.head(1):
            return found
        if most_levels is not None and level > most_levels:
            raise ValueError(f"more than {most_levels} levels")
        found = found.unionByName(last)
        if level % TOGETHER == 0:
            found = cut(found)
