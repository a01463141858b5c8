"""What is particular to one publisher's site; operators take it as a parameter."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SiteProfile:
    # They must be these for the right results on the default site.
    host: str = "https://www.nature.com"
    slug: str = r"(?:s41467-\d{3}-\d{5}-[0-9a-z]|ncomms\d+)"
    doi_prefix: str = "10.1038"
    journal: str = "Nature Communications"
    supplement: str = r"(?i)https://static-content\.springer\.com/[^\s\"')>]+MOESM\d+_ESM\.pdf"
    archive: str = "https://www.nature.com/ncomms/research-articles?type=article"
    listing_path: str = "/research-articles"
    listing_type: str = "article"
    listing_defaults: tuple[tuple[str, str], ...] = (("searchType", "journalSearch"), ("sort", "PubDate"))
    page_size: int = 20

    @property
    def article_prefix(self) -> str:
        return f"{self.host}/articles/"

    @property
    def article_pattern(self) -> str:
        """Matches article addresses; anything may follow the slug."""
        return "^" + self.article_prefix.replace(".", r"\.") + self.slug

    @property
    def strict_article_pattern(self) -> str:
        """Matches article addresses with nothing after the slug."""
        return self.article_pattern + "$"


DEFAULT = SiteProfile()

# Fixed values, for the right results: how pages name their fields, and what links and dates look like.
AUTHOR_KEYS = ("authors", "author", "citation_author", "dc.creator", "dc_creator")
KEYWORD_KEYS = ("keywords", "keyword", "citation_keywords")
MARKDOWN_LINK = r"\[([^\]]+)\]\((https?://[^\)]+)\)"
DATE = r":\s*([0-9]{1,2}\s+\w+\s+[0-9]{4})"
