"""Fields of an article record, from a scrape: url, markdown, html, raw_html, links, metadata
(a map of strings).  Every function takes and returns columns; null means absent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profile import AUTHOR_KEYS, DATE, DEFAULT, KEYWORD_KEYS, MARKDOWN_LINK, SiteProfile
from .text import BREAK, SPACE, blank_to_null, let, string_list, strip, stripped_lines, word_count
from .urls import is_article_url, normalize_article_url, resolve, slug_from_url


def _text(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def _first(xs: Column) -> Column:
    return F.get(xs, F.lit(0))


def _markdown_links(markdown: Column) -> Column:
    """(label, url) of each markdown link."""
    labels, urls = (F.regexp_extract_all(_text(markdown), F.lit(MARKDOWN_LINK), F.lit(i)) for i in (1, 2))
    return F.arrays_zip(labels.alias("label"), urls.alias("url"))


def _section(markdown: Column, marker: str) -> Column:
    """What follows the marker's first occurrence (anywhere: Q2) up to a line that is a
    level-2 heading; null without one."""
    at = F.instr(markdown, marker)
    after = F.when(at > 0, F.substr(markdown, at + len(marker)))
    return F.regexp_replace(after, rf"(?s)(?:\A|{BREAK})[{SPACE}]*## .*\z", "")


def listing_urls(links: Column, markdown: Column, html: Column, raw_html: Column, base: Column, site: SiteProfile = DEFAULT, strict: bool = True) -> Column:
    """Article addresses of a listing, in order of first occurrence."""
    bare = F.lit(site.article_prefix.replace(".", r"\.") + site.slug + r"(?:[?#][^\s\"')>]*)?")
    found = F.concat(
        F.coalesce(links, F.array().cast("array<string>")),
        F.regexp_extract_all(_text(markdown), F.lit(MARKDOWN_LINK), F.lit(2)),
        *[F.regexp_extract_all(_text(x), bare, F.lit(0)) for x in (markdown, html, raw_html)],
    )
    normal = F.transform(F.filter(found, lambda x: x.isNotNull()), lambda x: normalize_article_url(resolve(base, x)))
    return F.array_distinct(F.filter(normal, lambda x: is_article_url(x, site, strict)))


def peer_review_url(markdown: Column, labelled: Column, site: SiteProfile = DEFAULT) -> Column:
    """The address that the page's markup labels (``labelled``, see ``html``), else a
    labelled markdown link, else the first supplement if the text mentions the file."""
    is_pdf = lambda p: F.lower(p["label"]).contains("peer review") & F.lower(p["url"]).endswith(".pdf")
    link = _first(F.filter(_markdown_links(markdown), is_pdf))["url"]
    low = F.lower(_text(markdown))
    told = low.contains("transparent peer review file") | low.contains("peer review file is available")
    return F.coalesce(labelled, link, F.when(told, F.nullif(F.regexp_extract(markdown, site.supplement, 0), F.lit(""))))


def _listed(metadata: Column, keys: tuple[str, ...]) -> Column:
    found = [F.try_element_at(metadata, F.lit(k)) for k in keys]
    return F.coalesce(*[F.when(x.rlike(f"[^{SPACE}]"), string_list(x)) for x in found])


def authors(metadata: Column, markdown: Column) -> Column:
    """T4: from the metadata, else the second line of the text if it reads like names."""

    def named(second: Column) -> Column:
        names = string_list(F.replace(second, F.lit(" & "), F.lit(", ")))
        return F.when(~second.startswith("## "), let(names, lambda xs: F.when((F.size(xs) > 0) & F.forall(xs, lambda n: word_count(n) <= 6), xs)))

    # breaks take the blank lines after them along
    second = strip(F.get(F.split(strip(_text(markdown)), rf"(?:{BREAK})[{SPACE}]*", 3), F.lit(1)))
    return F.coalesce(_listed(metadata, AUTHOR_KEYS), let(second, named), F.array().cast("array<string>"))


def keywords(metadata: Column) -> Column:
    """T6."""
    return F.coalesce(_listed(metadata, KEYWORD_KEYS), F.array().cast("array<string>"))


def text_lines(markdown: Column) -> Column:
    return F.split(_text(markdown), BREAK)


def section_headings(markdown: Column, lines: Column | None = None) -> Column:
    """T5: level-2 headings in order.  ``lines`` are the text's, if they are at hand."""
    lines = text_lines(markdown) if lines is None else lines
    maybe = F.filter(lines, lambda x: x.contains("## "))  # few are left to be stripped
    found = F.filter(F.transform(maybe, strip), lambda x: x.startswith("## "))
    return F.transform(found, lambda x: strip(F.substr(x, F.lit(4))))


def reference_count(markdown: Column) -> Column:
    """Numbered lines after the references' heading; 0 is null."""
    own = stripped_lines(_section(markdown, "## References"))
    return let(F.size(F.filter(own, lambda x: x.rlike(r"^\d+\.|^\[\d+\]"))), lambda n: F.when(n > 0, n))


def article_pdf_url(url: Column, links: Column, markdown: Column, html: Column, metadata: Column, site: SiteProfile = DEFAULT) -> Column:
    """A link under the article's address, a labelled markdown link, or the address that
    the site would have, if the page mentions a download or has a title (Q5)."""
    own = normalize_article_url(url)
    linked = _first(F.filter(links, lambda x: x.startswith(own) & x.endswith(".pdf")))
    labelled = _first(F.filter(_markdown_links(markdown), lambda p: (F.lower(strip(p["label"])) == "download pdf") & F.lower(p["url"]).endswith(".pdf")))["url"]
    exact = F.nullif(F.regexp_extract(_text(markdown), r"\[Download PDF\]\((" + site.article_prefix.replace(".", r"\.") + r"[^\)]+\.pdf)\)", 1), F.lit(""))
    made = F.when(F.lower(_text(html)).contains("download pdf") | blank_to_null(F.try_element_at(metadata, F.lit("title"))).isNotNull(), F.concat(own, F.lit(".pdf")))
    return F.coalesce(linked, labelled, exact, made)


def title(url: Column, metadata: Column, markdown: Column, site: SiteProfile = DEFAULT, lines: Column | None = None) -> Column:
    """The metadata's title without the journal, else the first level-1 heading that
    isn't the slug.  ``lines`` are the text's, if they are at hand."""
    own = strip(blank_to_null(F.try_element_at(metadata, F.lit("title"))))
    suffix = f" | {site.journal}"
    named = let(own, lambda t: F.when(t.endswith(suffix), strip(F.substr(t, F.lit(1), F.length(t) - len(suffix)))).otherwise(t))
    slug = slug_from_url(url)
    heads = F.transform(F.filter(text_lines(markdown) if lines is None else lines, lambda x: x.startswith("# ")), lambda x: strip(F.substr(x, F.lit(3))))
    return F.coalesce(named, let(slug, lambda own: _first(F.filter(heads, lambda x: (x != "") & (x != F.coalesce(own, F.lit("")))))))


def abstract(markdown: Column) -> Column:
    """The lines after the abstract's heading, joined by spaces."""
    return let(F.array_join(stripped_lines(_section(markdown, "## Abstract")), " "), lambda x: F.when(x != "", x))


def doi(url: Column, markdown: Column, site: SiteProfile = DEFAULT) -> Column:
    """The first one in the text (Q4), else the one the slug implies."""
    found = F.regexp_extract(_text(markdown), "(" + site.doi_prefix.replace(".", r"\.") + "/" + site.slug + ")", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.concat(F.lit(f"{site.doi_prefix}/"), slug_from_url(url)))


def date(markdown: Column, label: str) -> Column:
    """The date after ``Published``, ``Accepted`` or ``Received``, as written."""
    return F.nullif(F.regexp_extract(_text(markdown), f"(?U){label}{DATE}", 1), F.lit(""))


def typed_date(text: Column) -> Column:
    return F.try_to_date(text, "d MMMM yyyy")


def content_stats(markdown: Column, summary: Column, headings: Column, references: Column) -> Column:
    """T13."""
    return F.struct(
        F.length(_text(markdown)).alias("body_markdown_chars"),
        word_count(markdown).alias("body_markdown_words"),
        F.length(_text(summary)).alias("abstract_chars"),
        word_count(summary).alias("abstract_words"),
        F.size(headings).alias("section_count"),
        references.alias("reference_count"),
    )
