"""Article records from scrapes, and their projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extract as x
from ..functions.ids import duplicate_keys
from ..functions.text import blank_to_null
from ..functions.urls import normalize_article_url, slug_from_url
from ..profile import DEFAULT, SiteProfile

#: The columns of the slim form, which leaves out body and metadata.
SUMMARY = ("article_url", "slug", "title", "doi", "journal", "published_date", "abstract", "article_pdf_url", "peer_review_pdf_url", "markdown_path", "article_pdf_path", "peer_review_pdf_path", "record_path")
_META = ("title", "description", "language", "url", "og_title", "og_description")


def records(scrapes: DataFrame, site: SiteProfile = DEFAULT, source: str = "native", labelled: Column | None = None) -> DataFrame:
    """One record for each scrape (url, markdown, html, links, metadata).
    ``labelled`` is the supplement that the page's markup labels, if there is markup."""
    c = F.col
    # worked out once: the optimizer doesn't copy what isn't cheap into two places
    staged = scrapes.withColumn("marl_lines", x.text_lines(c("markdown")))
    fields = staged.select(
        "*",
        normalize_article_url(c("url")).alias("article_url"),
        x.title(c("url"), c("metadata"), c("markdown"), site, c("marl_lines")).alias("title"),
        x.abstract(c("markdown")).alias("abstract"),
        x.authors(c("metadata"), c("markdown")).alias("authors"),
        x.keywords(c("metadata")).alias("keywords"),
        x.section_headings(c("markdown"), c("marl_lines")).alias("section_headings"),
        x.reference_count(c("markdown")).alias("reference_count"),
        x.article_pdf_url(c("url"), c("links"), c("markdown"), c("html"), c("metadata"), site).alias("article_pdf_url"),
        x.peer_review_url(c("markdown"), F.lit(None).cast("string") if labelled is None else labelled, site).alias("peer_review_pdf_url"),
        *[x.date(c("markdown"), label).alias(label.lower()) for label in ("Received", "Accepted", "Published")],
    )
    details = F.struct(
        F.lit(source).alias("source"),
        c("article_url").alias("source_url"),
        F.array(*map(F.lit, ("markdown", "html", "links"))).alias("scrape_formats"),
        x.content_stats(c("markdown"), c("abstract"), c("section_headings"), c("reference_count")).alias("content_stats"),
        F.struct("received", "accepted", "published").alias("dates"),
        "authors",
        "keywords",
        "section_headings",
        F.struct("article_url", "article_pdf_url", "peer_review_pdf_url").alias("links"),
        F.coalesce(F.array_sort(F.map_keys("metadata")), F.array().cast("array<string>")).alias("raw_metadata_keys"),
        F.struct(*[F.try_element_at("metadata", F.lit(k)).alias(k) for k in _META]).alias("metadata_summary"),
    )
    none = F.lit(None).cast("string")
    return fields.select(
        slug_from_url(c("url")).alias("slug"),
        "article_url",
        c("title"),
        x.doi(c("url"), c("markdown"), site).alias("doi"),
        F.lit(site.journal).alias("journal"),
        c("published").alias("published_date"),
        "abstract",
        blank_to_null(c("markdown")).alias("body_markdown"),
        "article_pdf_url",
        "peer_review_pdf_url",
        *[none.alias(k) for k in ("markdown_path", "article_pdf_path", "peer_review_pdf_path", "record_path")],
        details.alias("detailed_metadata"),
        "metadata",
    )


def summary(rows: DataFrame) -> DataFrame:
    """The slim form."""
    return rows.select(*SUMMARY)


def as_json(rows: DataFrame, *keep: str) -> DataFrame:
    """SNK4: each row as JSON text, nulls included."""
    return rows.select(*keep, F.to_json(F.struct(*[F.col(k) for k in rows.columns]), {"ignoreNullFields": "false"}).alias("json"))


def keys_of(rows: DataFrame) -> Column:
    return duplicate_keys(*[rows[k] for k in ("slug", "article_url", "doi", "article_pdf_url", "peer_review_pdf_url", "title", "journal")])
