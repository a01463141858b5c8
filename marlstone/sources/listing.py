"""A listing's pages through an engine, as a stream whose offset is a page number.

Whether page n + 1 exists is known only once page n turned out not to be empty, so pages are
asked for one after the other, by the reader that plans the stream: ``ahead`` pages at most
for each micro-batch, until the first empty one, which counts (Q13) and ends the listing.
What a page had rides to the executors in its partition.  A batch that is planned again from
a checkpoint asks for its pages again, each in its own task.
"""

from __future__ import annotations

import importlib
import re
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions.html import page_links, parsed
from ..functions.urls import archive_page_url
from ..profile import DEFAULT, MARKDOWN_LINK, SiteProfile
from .clients import Client, NotThere

SCHEMA = "archive_url string, page_number int, urls array<string>, retries int"
#: Pages that the first micro-batch asks for, each next one for twice as many, and the most.
FIRST_PAGES, MOST_PAGES = 8, 64
#: Stands for the page number in the address of "any" page.
_ANY = 987_654_321


def page_addresses(spark: SparkSession, archive: str, site: SiteProfile = DEFAULT) -> tuple[str, str]:
    """U4: the address of page 1, and that of any other with ``{}`` for its number."""
    row = spark.range(1).select(*[archive_page_url(F.lit(archive), F.lit(n), site).alias(f"p{n}") for n in (1, _ANY)]).first()
    return row[0], row[1].replace(str(_ANY), "{}")


def article_addresses(found: dict, base: str, site: SiteProfile = DEFAULT) -> list[str]:
    """T1 for one scrape: what ``extract.listing_urls`` gives, where there is no frame.  An
    engine that tells no links has them read from its markup (T20)."""
    markdown, html, raw = (found.get(n) or "" for n in ("markdown", "html", "raw_html"))
    links = found.get("links")
    if links is None:
        links = page_links(parsed(html or raw), site.host)
    bare = re.compile(re.escape(site.article_prefix) + site.slug + r"(?:[?#][^\s\"')>]*)?", re.ASCII)
    told = [*links, *(m[2] for m in re.finditer(MARKDOWN_LINK, markdown)), *(m[0] for text in (markdown, html, raw) for m in bare.finditer(text))]
    article = re.compile(site.article_prefix.replace(".", r"\.") + site.slug)
    kept: dict[str, None] = {}
    for link in told:
        try:
            whole = urljoin(base, (link or "").strip())
        except ValueError:  # no address at all
            continue
        scheme, colon, rest = re.split("[?#]", whole, maxsplit=1)[0].partition(":")
        normal = re.sub("(/[^/;]*);$", r"\1", f"{scheme.lower()}{colon}{rest}").rstrip("/")
        if article.fullmatch(normal):
            kept.setdefault(normal)
    return list(kept)


def asked(ask: Callable[[int], list[str]], page_size: int) -> tuple[list[str], int]:
    """SRC4, SRC5: a page's addresses, and how often it was asked for again.  One that isn't
    there is empty; one that has fewer than it should is asked for once more, with the retry's
    index, and both answers are joined (Q30)."""

    def got(retry: int) -> list[str]:
        try:
            return ask(retry)
        except NotThere:
            return []

    urls = list(dict.fromkeys(got(0)))
    return (list(dict.fromkeys([*urls, *got(1)])), 1) if 0 < len(urls) < page_size else (urls, 0)


class _Pages:
    """How a page is asked for: through an engine, or by a function of archive and page."""

    def __init__(self, options, client: Client | None, site: SiteProfile):
        self.archive, self.client, self.site = options["archive"], client, site
        self.first, last = int(options.get("first", 1)), options.get("last")
        self.last = int(last) if last is not None else None
        self.page_size = int(options.get("page_size", site.page_size))
        self.addresses = options.get("first_url"), options.get("page_url")
        self.function = options.get("pages")

    def __call__(self, number: int) -> tuple[list[str], int]:
        if self.client is None:
            module, name = self.function.split(":")
            function = getattr(importlib.import_module(module), name)
            return asked(lambda retry: function(self.archive, number), self.page_size)
        client, url = self.client, self.addresses[0] if number <= 1 else self.addresses[1].format(number)
        return asked(lambda retry: article_addresses(client.listing(url, retry) or {}, url, self.site), self.page_size)

    def row(self, number: int, got: tuple[list[str], int] | None = None) -> tuple:
        urls, retries = got or self(number)
        return self.archive, number, urls, retries


class Page(InputPartition):
    """One page, and what it had if that is known."""

    def __init__(self, number: int, got: tuple[list[str], int] | None = None):
        super().__init__(number)
        self.got = got


class ListingSource(DataSource):
    """SRC8: a listing.  As a batch: pages ``first`` to ``last``, a task each, all of which
    are asked for; ``until_empty`` then ends the listing.  As a stream: see above; ``last`` is
    then optional.  The option ``pages`` names a function ``module:name`` of archive and page
    that returns the page's addresses; ``of`` makes a source that asks an engine.
    ``page_size`` tells which pages to ask for again."""

    client: Client | None = None
    site: SiteProfile = DEFAULT

    @classmethod
    def name(cls) -> str:
        return "listing"

    @classmethod
    def of(cls, client: Client, site: SiteProfile = DEFAULT) -> type[ListingSource]:
        """A source under its own name whose pages the engine ``client`` is asked for."""
        own = f"listing_{uuid.uuid4().hex}"
        return type("EngineListing", (cls,), {"client": client, "site": site, "name": classmethod(lambda _: own)})

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(_Pages(self.options, self.client, self.site))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _Stream(_Pages(self.options, self.client, self.site), int(self.options.get("ahead", MOST_PAGES)))


class _Batch(DataSourceReader):
    def __init__(self, pages: _Pages):
        self.pages = pages

    def partitions(self):
        return [Page(n) for n in range(self.pages.first, (self.pages.last or 0) + 1)]

    def read(self, partition) -> Iterator[tuple]:
        yield self.pages.row(partition.value)


class _Stream(DataSourceStreamReader):
    """Offsets: the next page, and whether the listing may go on there."""

    def __init__(self, pages: _Pages, most: int):
        self.pages, self.most, self.ahead = pages, most, min(FIRST_PAGES, most)
        self.at: dict | None = None
        self.held: dict[int, tuple[list[str], int]] = {}

    def initialOffset(self) -> dict:  # noqa: N802
        return {"page": self.pages.first, "open": True}

    def latestOffset(self) -> dict:  # noqa: N802
        """Asks for the next pages."""
        at = self.at or self.initialOffset()
        number, goes_on = at["page"], at["open"]
        for _ in range(self.ahead):
            if not goes_on or self.pages.last is not None and number > self.pages.last:
                break
            self.held[number] = self.pages(number)
            goes_on = bool(self.held[number][0])
            number += 1
        self.ahead = min(2 * self.ahead, self.most)
        self.at = {"page": number, "open": goes_on}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Also called, with twice the same offset, to tell where a checkpoint has come to."""
        if self.at is None or self.at["page"] < end["page"]:
            self.at = dict(end)
        return [Page(n, self.held.get(n)) for n in range(start["page"], end["page"])]

    def commit(self, end: dict) -> None:
        self.held = {n: got for n, got in self.held.items() if n >= end["page"]}

    def read(self, partition) -> Iterator[tuple]:
        yield self.pages.row(partition.value, partition.got)


def stream(spark: SparkSession, client: Client, archive: str, first: int = 1, last: int | None = None, site: SiteProfile = DEFAULT, ahead: int = MOST_PAGES) -> DataFrame:
    """SRC4, SRC5, SRC8, ST1, ST3: the pages of a listing, from ``first`` on, as a stream
    (archive_url, page_number, urls, retries).  It has no more data after the listing's end,
    so ``processAllAvailable`` returns there."""
    source = ListingSource.of(client, site)
    spark.dataSource.register(source)
    first_url, page_url = page_addresses(spark, archive, site)
    made = spark.readStream.format(source.name()).option("archive", archive).option("first", first).option("ahead", ahead).option("first_url", first_url).option("page_url", page_url)
    return (made if last is None else made.option("last", last)).load()
