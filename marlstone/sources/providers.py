"""What the engine asks of the outside world, and stand-ins that answer from tables."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import is_article_url, normalize_article_url
from ..operators.dedupe import first_by
from ..operators.numbering import numbered
from ..profile import DEFAULT, SiteProfile
from .clients import Client, found_urls
from .listing import ListingSource, asked  # noqa: F401

SCRAPE = "url string, markdown string, html string, raw_html string, links array<string>, metadata map<string,string>, error string"


class Fetcher(Protocol):
    """Fetches one address; returns the fields of a scrape, or raises."""

    def __call__(self, url: str) -> dict: ...


class TableFetcher:
    """Answers from a mapping; an address that isn't there fails."""

    def __init__(self, pages: dict[str, dict]):
        self.pages = pages

    def __call__(self, url: str) -> dict:
        if url not in self.pages:
            raise KeyError(f"no page at {url}")
        return self.pages[url]


class Gate:
    """ST8: lets one request through in each interval; for a driver's or a task's own loop."""

    def __init__(self, per_second: float, clock=None, sleep=None):
        self.interval = 1 / per_second if per_second > 0 else 0.0
        self.clock, self.sleep, self.next = clock or time.monotonic, sleep or time.sleep, 0.0

    def wait(self) -> None:
        now = self.clock()
        if now < self.next:
            self.sleep(self.next - now)
            now = self.next
        self.next = now + self.interval


class Slots(Gate):
    """ST8: one rate for all tasks.  Second ``began + n / per_second`` is slot n; of ``tasks``
    tasks, number ``task`` sends requests only in the slots whose number leaves it as rest.
    A task that is late, or is run again, goes on with its next slot, so requests never
    come faster than the rate, whichever tasks run when; machines need but equal clocks."""

    def __init__(self, per_second: float, task: int = 0, tasks: int = 1, began: float = 0.0, clock=None, sleep=None):
        super().__init__(per_second, clock or time.time, sleep)
        self.task, self.tasks, self.began, self.last = task, tasks, began, -1

    def wait(self) -> None:
        if not self.interval:
            return
        now = self.clock()
        due = max(self.last + 1, math.ceil((now - self.began) / self.interval - 1e-6), 0)
        due += (self.task - due) % self.tasks
        self.last = due
        if (left := self.began + due * self.interval - now) > 0:
            self.sleep(left)


def _dealt(rows: DataFrame, partitions: int | None, per_second: float) -> tuple[DataFrame, Callable[[], Gate]]:
    """Rows over so many tasks, and what makes the gate of the task that asks, so that all
    together keep to ``per_second``."""
    if per_second > 0 and not partitions:
        raise ValueError("a rate is shared between tasks, so their number must be given")
    if not partitions:
        return rows, lambda: Gate(0.0)
    began = time.time()
    return rows.repartition(partitions), lambda: Slots(per_second, TaskContext.get().partitionId(), partitions, began)


def fetched(urls: DataFrame, fetch: Fetcher, partitions: int | None = None, per_second: float = 0.0) -> DataFrame:
    """SRC4-SRC7, M7: one scrape for each address (url); a failure is a row with its error.
    ``per_second`` requests are let through, over all of the ``partitions`` tasks.  The caller
    stores the result before using it twice, as a fetch isn't repeatable."""
    own, make_gate = _dealt(urls.select("url"), partitions, per_second)
    names = ("markdown", "html", "raw_html", "links", "metadata")
    kinds = {"links": pa.list_(pa.string()), "metadata": pa.map_(pa.string(), pa.string())}
    schema = pa.schema([("url", pa.string()), *[(n, kinds.get(n, pa.string())) for n in names], ("error", pa.string())])

    def run(batches):
        gate = make_gate()
        for batch in batches:
            rows = []
            for url in batch.column(0).to_pylist():
                gate.wait()
                try:
                    got = fetch(url)
                    rows.append({"url": url} | {n: list(got[n].items()) if n == "metadata" and got.get(n) is not None else got.get(n) for n in names} | {"error": None})
                except Exception as e:  # a failed fetch is a result
                    rows.append({"url": url} | dict.fromkeys(names) | {"error": str(e)})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return own.mapInArrow(run, SCRAPE)


class TableSource:
    """Answers with the rows of a table of scrapes, by a join on the normal address, and
    searches and contents from tables as well; nothing of them comes to the driver."""

    engine = "table"

    def __init__(self, scrapes: DataFrame, searches: DataFrame | None = None, contents: DataFrame | None = None, listings: DataFrame | None = None):
        self.scrapes, self.searches, self.contents, self.listings = scrapes, searches, contents, listings

    def pages(self, archive: str, first: int = 1, last: int | None = None) -> DataFrame:
        """SRC8, Z6: the pages (archive_url, page_number, urls) of a listing up to ``last`` or
        its first empty one, which counts (Q13); one that isn't there is empty."""
        rows = self.listings.filter((F.col("archive_url") == archive) & (F.col("page_number") >= first) & (F.lit(True) if last is None else F.col("page_number") <= last))
        full = rows.filter(F.size("urls") > 0).groupBy("page_number").agg(F.min("urls").alias("urls"))
        start = rows.sparkSession.range(1).select(F.lit(first - 1).alias("n"))
        numbers = full.select(F.col("page_number").alias("n")).unionByName(start)
        ends = numbers.select((F.col("n") + 1).alias("n")).join(numbers, "n", "left_anti").agg(F.min("n").alias("end"))
        empty = ends.select(F.col("end").cast("int").alias("page_number"), F.array().cast("array<string>").alias("urls")).filter(F.lit(True) if last is None else F.col("page_number") <= last)
        known = full.select(F.col("page_number").cast("int").alias("page_number"), F.array_distinct("urls").alias("urls"))
        one = F.lit(1).alias("one")
        before = known.select("*", one).join(ends.select("end", one), "one").filter("page_number < end").select("page_number", "urls")  # the end is one row
        return before.unionByName(empty).select(F.lit(archive).alias("archive_url"), "page_number", "urls")

    def fetched(self, urls: DataFrame) -> DataFrame:
        """The first scrape of each address by markdown; those that aren't there fail."""
        names = ("markdown", "html", "raw_html", "links", "metadata")
        own = self.scrapes.select(normalize_article_url(F.col("url")).alias("url"), F.struct(*names).alias("s"))
        own = own.groupBy("url").agg(F.min_by("s", F.col("s.markdown")).alias("a"), F.any_value("s").alias("b")).select("url", F.coalesce("a", "b").alias("s"))
        error = F.when(F.col("s").isNull(), F.concat(F.lit("no page at "), "url")).alias("error")
        return urls.select("url").join(own, "url", "left").select("url", *[F.col(f"s.{n}").alias(n) for n in names], error)

    def downloaded(self, urls: DataFrame) -> DataFrame:
        """contents: url, content."""
        own = self.contents.groupBy("url").agg(F.min("content").alias("content"))
        return urls.select("url").join(own, "url", "left").select("url", "content", F.when(F.col("content").isNull(), F.concat(F.lit("nothing at "), "url")).alias("error"))

    def search(self, query: str, limit: int) -> dict:
        """searches: query, ord, url."""
        rows = self.searches.filter(F.col("query") == query).orderBy("ord").limit(limit).collect() if self.searches is not None else []
        return {"web": [{"url": r["url"]} for r in rows]}


def downloaded(urls: DataFrame, content: Callable[[str], bytes], partitions: int | None = None, per_second: float = 0.0) -> DataFrame:
    """SNK2, SRC23: url, content and error of each address (url), under the same rate."""
    own, make_gate = _dealt(urls.select("url"), partitions, per_second)
    schema = pa.schema([("url", pa.string()), ("content", pa.binary()), ("error", pa.string())])

    def run(batches):
        gate = make_gate()
        for batch in batches:
            for url in batch.column(0).to_pylist():  # a row at a time, as contents are large
                gate.wait()
                try:
                    row = {"url": url, "content": content(url), "error": None}
                except Exception as e:  # a failed download is a result
                    row = {"url": url, "content": None, "error": str(e)}
                yield pa.RecordBatch.from_pylist([row], schema)

    return own.mapInArrow(run, "url string, content binary, error string")


def searched(spark: SparkSession, client: Client, query: str, limit: int = 20, site: SiteProfile = DEFAULT) -> DataFrame:
    """SRC3, L1: url and ord of a search's hits: normal, articles only, the first of equals,
    ``limit`` at most.  A search answers with few hits, which come through the driver."""
    hits = spark.createDataFrame(list(enumerate(found_urls(client.search(query, limit)))), "ord bigint, url string")
    own = hits.select(normalize_article_url(F.col("url")).alias("url"), "ord").filter(is_article_url(F.col("url"), site))
    return first_by(own, ["url"], ["ord"]).orderBy("ord").limit(limit)


def until_empty(pages: DataFrame) -> DataFrame:
    """SRC8, Z6: pages (archive_url, page_number, urls) up to each archive's first empty one,
    which counts (Q13)."""
    ends = pages.filter(F.size("urls") == 0).groupBy("archive_url").agg(F.min("page_number").alias("marl_end"))
    return pages.join(ends, "archive_url", "left").filter("marl_end is null or page_number <= marl_end").drop("marl_end")


def iter_pages(archive: str, page: Callable[[str, int], list[str]], first: int = 1, max_pages: int | None = None, page_size: int = 20) -> Iterator[tuple[str, int, list[str], list[str]]]:
    """SRC8, L2, Z6: archive, page number, addresses and new addresses, page by page until an
    empty one (which is included: Q13) or past the page numbered ``max_pages`` (Q14).  The
    number of pages isn't known ahead, so this loop is the driver's; only addresses that
    were seen are held."""
    seen: set[str] = set()
    number = first
    while max_pages is None or number <= max_pages:
        urls, _ = asked(lambda retry, n=number: page(archive, n), page_size)
        new = [u for u in urls if u not in seen]
        seen.update(new)
        yield archive, number, urls, new
        if not urls:
            return
        number += 1


def listing_pages(spark: SparkSession, archive: str, page: Callable[[str, int], list[str]], first: int = 1, max_pages: int | None = None, page_size: int = 20) -> DataFrame:
    """The pages of ``iter_pages`` as a frame."""
    rows = list(iter_pages(archive, page, first, max_pages, page_size))
    return spark.createDataFrame(rows, "archive_url string, page_number int, page_urls array<string>, new_urls array<string>")


def discovered(pages: DataFrame) -> DataFrame:
    """SRC9: the addresses of listing pages in order (url, ord)."""
    return numbered(pages.select("page_number", F.posexplode("new_urls").alias("at", "url")), ["page_number", "at"]).select("url", "ord")


def sitemap_entries(documents: DataFrame) -> DataFrame:
    """SRC11, SRC12: addresses in sitemap documents (url, xml), of indexes and of url sets,
    whatever their namespace: src, dst, kind."""
    loc = lambda kind: F.expr(f"""xpath(xml, "//*[local-name()='{kind}']/*[local-name()='loc']/text()")""")
    rows = [documents.select(F.col("url").alias("src"), F.posexplode(loc(kind)).alias("at", "dst"), F.lit(name).alias("kind")) for kind, name in (("sitemap", "index"), ("url", "page"))]
    return rows[0].unionByName(rows[1]).withColumn("dst", F.trim("dst"))
