"""The fetch catalogue: attempts, latest states, page log, statistics, resuming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_attempts(attempts: DataFrame, order: str = "ord") -> DataFrame:
    """A3, SNK7: per url the last status, time and error, and the last success time and slug
    that weren't null.  attempts: url, status, attempted_at, succeeded_at, article_slug,
    error_message and the order column."""
    latest = lambda c: F.max_by(c, order)
    kept = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order)))
    return attempts.groupBy("url").agg(
        latest("status").alias("status"),
        latest("attempted_at").alias("last_attempted_at"),
        kept("succeeded_at").alias("last_succeeded_at"),
        kept("article_slug").alias("article_slug"),
        latest("error_message").alias("error_message"),
    )


def upserted(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """SNK6, SNK8: rows of ``new`` replace those of ``table`` with their keys."""
    return table.join(new, keys, "left_anti").unionByName(new)


def attempt_stats(articles: DataFrame, latest: DataFrame) -> DataFrame:
    """A1, A2: one row; an empty catalogue gives zeros and nulls (Q17)."""
    n = articles.agg(F.count(F.lit(1)).alias("total_articles"))
    states = latest.agg(
        F.count(F.lit(1)).alias("cached_urls"),
        F.count_if(F.col("status") == "success").alias("success_urls"),
        F.count_if(F.col("status") == "failed").alias("failed_urls"),
        F.max("last_attempted_at").alias("last_attempted_at"),
        F.max("last_succeeded_at").alias("last_succeeded_at"),
    )
    one = F.lit(1).alias("one")  # both sides have one row
    return n.select("*", one).join(states.select("*", one), "one").drop("one")


def failed_urls(latest: DataFrame) -> DataFrame:
    """F3, M11."""
    return latest.filter(F.col("status") == "failed").select("url", "error_message", "last_attempted_at").orderBy("url")


def resume_pages(log: DataFrame, archive: str = "archive_url", page: str = "page_number") -> DataFrame:
    """Per archive the smallest page number that was not visited."""
    pages = log.select(archive, page).filter(F.col(page) > 0).distinct()
    at = F.row_number().over(Window.partitionBy(archive).orderBy(page))
    return pages.withColumn("at", at).groupBy(archive).agg((F.coalesce(F.max(F.when(F.col(page) == F.col("at"), F.col(page))), F.lit(0)) + 1).cast("int").alias("resume_page"))


def fallback_page(n_articles: Column, page_size: int = 20) -> Column:
    """Where to start without a page log."""
    return F.when(n_articles >= page_size, F.floor(n_articles / page_size)).otherwise(1).cast("int")


def underfilled(pages: DataFrame, count: str = "page_discovered", page_size: int = 20) -> DataFrame:
    """pages that gave some articles, but too few."""
    return pages.filter((F.col(count) > 0) & (F.col(count) < page_size))


def cumulative(pages: DataFrame, archive: str = "archive_url", page: str = "page_number", count: str = "page_new") -> DataFrame:
    """A10: articles discovered up to each page."""
    return pages.withColumn("cumulative_discovered", F.sum(count).over(Window.partitionBy(archive).orderBy(page).rowsBetween(Window.unboundedPreceding, 0)))


def cleared(log: DataFrame, archive_url: str) -> tuple[DataFrame, DataFrame]:
    """SNK9: the log without an archive, and how many of its pages went."""
    gone = F.col("archive_url") == archive_url
    return log.filter(~gone), log.filter(gone).agg(F.count(F.lit(1)).alias("deleted"))
