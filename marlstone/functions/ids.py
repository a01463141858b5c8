"""Identity: content ids, file names, and the keys by which records are duplicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, text_key

#: Fixed value: the namespace of object identifiers (RFC 4122), in which content ids lie.
_OID = "6ba7b8129dad11d180b400c04fd430c8"


def content_uuid(content: Column) -> Column:
    """The version-5 UUID of the content's SHA-256 in hex."""
    digest = F.sha1(F.concat(F.unhex(F.lit(_OID)), F.sha2(content.cast("binary"), 256).cast("binary")))
    part = lambda at, n: F.substring(digest, at, n)
    variant = F.element_at(F.array(*map(F.lit, "89ab")), F.pmod(F.conv(part(17, 1), 16, 10).cast("int"), F.lit(4)) + 1)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)/*$", 1)


def stem(path: Column) -> Column:
    """The file name without its last extension."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def duplicate_keys(slug: Column, url: Column, doi: Column, article_pdf: Column, review_pdf: Column, title: Column, journal: Column) -> Column:
    """Up to six keys."""
    tagged = lambda tag, x: let(x, lambda v: F.when(v != "", F.concat(F.lit(f"{tag}:"), v)))
    named = let(F.struct(text_key(title).alias("t"), text_key(journal).alias("j")), lambda v: F.coalesce(F.concat(F.lit("title_journal:"), v["j"], F.lit(":"), v["t"]), F.concat(F.lit("title:"), v["t"])))
    return F.array_compact(
        F.array(
            tagged("slug", slug),
            tagged("url", F.lower(url)),
            tagged("doi", F.lower(doi)),
            tagged("article_pdf", F.lower(article_pdf)),
            tagged("peer_review_pdf", F.lower(review_pdf)),
            named,
        )
    )


