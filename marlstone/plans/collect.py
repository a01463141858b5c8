"""Collecting end to end: frontier, fetch, extraction, dedupe, and the catalogue's tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import html_links, html_markdown, html_meta, html_review, last_meta
from ..functions.urls import is_article_url, listing_url_with_year, normalize_article_url, slug_from_url
from ..operators import catalog, dedupe, frontier, records
from ..operators.checkpoints import cut, scratch
from ..operators.ledger import Ledger, Log, now
from ..operators.numbering import numbered
from ..profile import DEFAULT, SiteProfile
from ..sources import files, listing, providers, sitemaps
from ..streaming.seen import with_first

ATTEMPT = "url string, status string, attempted_at string, succeeded_at string, article_slug string, error_message string"
KEY = "dup_key string, slug string"
UNDERFILLED = "archive_url string, page_number int, page_discovered int"
PAGE = "archive_url string, page_number int, articles_found int, visited_at string"
ASSET = "slug string, kind string, path string, error string"
#: A batch of a listing's pages: what each has, and what of that no page before it had.
PAGES = "archive_url string, page_number int, urls array<string>, new_urls array<string>, retries int"
#: Pages of a listing that are collected at once, at most.
MOST_PAGES = listing.MOST_PAGES
#: The columns of an article record, once they are known.
_article: list[str] = []


def _last_attempt(rows: DataFrame) -> DataFrame:
    """One row for each url that later rows continue as all of its rows would (SNK7)."""
    latest = catalog.latest_attempts(rows.withColumn("ord", F.struct("at", "attempted_at")))
    return latest.withColumnsRenamed({"last_attempted_at": "attempted_at", "last_succeeded_at": "succeeded_at"}).join(rows.groupBy("url").agg(F.max("at").alias("at")), "url")


class Catalog(Ledger):
    """SNK3, SNK6-SNK8, SNK12, D5-D9: keyed logs in one folder, of any file system, whose rows
    appear together; the current state is the last row of each key."""

    def __init__(self, spark: SparkSession, folder: str, **how):
        if not _article:  # a long plan, of which only the columns are wanted
            _article.append(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.records(spark.createDataFrame([], providers.SCRAPE)).schema))
        logs = {
            "articles": Log(_article[0], "slug", lambda rows: dedupe.last_by(rows, ["slug"], ["at"])),
            "keys": Log(KEY, "dup_key", lambda rows: rows.groupBy("dup_key").agg(F.min("slug").alias("slug"), F.max("at").alias("at"))),
            "attempts": Log(ATTEMPT, "url", _last_attempt),
            "pages": Log(PAGE, "archive_url", lambda rows: dedupe.last_by(rows, ["archive_url", "page_number"], ["at"])),
            "underfilled": Log(UNDERFILLED, "archive_url"),
            "assets": Log(ASSET, "slug"),
        }
        super().__init__(spark, folder, logs, **how)

    def log(self, name: str, schema: str = "") -> DataFrame:
        """All rows of a log; its columns are known, so ``schema`` says nothing new."""
        return self.read(name)

    def append(self, name: str, rows: DataFrame) -> None:
        """A commit to one log."""
        self.commit({name: rows})

    def articles(self, slugs: DataFrame | None = None) -> DataFrame:
        """SNK6: one row for each slug (of ``slugs`` only, if given), the last written."""
        keys = None if slugs is None else slugs.select("slug")
        return dedupe.last_by(self.read("articles", keys), ["slug"], ["at"]).drop("at")

    def names(self, slugs: DataFrame | None = None) -> DataFrame:
        """slug and article_url of what is there: two columns of the log."""
        return self.read("articles", slugs).select("slug", "article_url")

    def owners(self, keys: DataFrame) -> DataFrame:
        """Of each of these keys (dup_key) the first record that has it."""
        return self.read("keys", keys).groupBy("dup_key").agg(F.min("slug").alias("first_id"))

    def attempts(self, urls: DataFrame | None = None) -> DataFrame:
        """SNK7: the latest state of each url (of ``urls`` only, if given)."""
        return catalog.latest_attempts(self.read("attempts", urls).withColumn("ord", F.struct("at", "attempted_at")))

    def pages(self, archives: DataFrame | None = None) -> DataFrame:
        """SNK8: the page log without what was cleared (SNK9)."""
        log = self.read("pages", archives)
        cleared = log.filter("page_number is null").groupBy("archive_url").agg(F.max("at").alias("cleared_at"))
        left = log.join(cleared, "archive_url", "left").filter("page_number is not null and (cleared_at is null or at > cleared_at)")
        return dedupe.last_by(left.drop("cleared_at"), ["archive_url", "page_number"], ["at"]).drop("at")

    def _archive(self, archive_url: str) -> DataFrame:
        return self.spark.range(1).select(F.lit(archive_url).alias("archive_url"))

    def stats(self) -> dict:
        """A2, Q17."""
        return catalog.attempt_stats(self.names().select("slug").distinct(), self.attempts()).first().asDict()

    def failed(self) -> DataFrame:
        return catalog.failed_urls(self.attempts())

    def resume_page(self, archive_url: str, page_size: int = 20) -> int:
        """The first page not visited; without a log, by the number of articles."""
        if not self.commits():
            return 1
        row = catalog.resume_pages(self.pages(self._archive(archive_url))).first()
        if row:
            return row["resume_page"]
        return self.names().agg(catalog.fallback_page(F.countDistinct("slug"), page_size)).first()[0]

    def clear_pages(self, archive_url: str) -> int:
        """SNK9: forgets an archive's visits; returns how many there were."""
        n = self.pages(self._archive(archive_url)).count()
        self.append("pages", self.spark.createDataFrame([(archive_url, None, None, None)], PAGE))
        return n


class Collector:
    """M1-M9 over a catalogue (X2: a folder, or a Catalog), with an engine (X1: ``article``
    and, for PDFs, ``content``, for listings ``listing``; or a function that fetches a page)
    and a callback (X3).  ``per_second`` holds for articles and PDFs, over all ``partitions``
    tasks."""

    def __init__(self, spark: SparkSession, store: str | Catalog, client, site: SiteProfile = DEFAULT, on_progress: Callable[[dict], None] | None = None, partitions: int | None = None, per_second: float = 0.0):
        self.spark, self.site = spark, site
        self.catalog = store if isinstance(store, Catalog) else Catalog(spark, store)
        pace = {"partitions": partitions, "per_second": per_second}
        self.client, content = client, getattr(client, "content", None)
        self._fetched = getattr(client, "fetched", None) or (lambda urls: providers.fetched(urls, getattr(client, "article", client), **pace))
        self._downloaded = (client.downloaded if getattr(client, "contents", None) is not None else None) if isinstance(client, providers.TableSource) else (lambda urls: providers.downloaded(urls, content, **pace)) if content else None
        self.engine = getattr(client, "engine", "native")
        self.on_progress = on_progress or (lambda event: None)

    def collect_urls(self, urls: DataFrame, resume: bool = True, retry_failed: bool = True, peer_reviews: bool = True, also: dict[str, DataFrame] | None = None) -> DataFrame:
        """M1: fetches what is neither cached nor known; returns the records of all addresses,
        one for each slug.  Duplicates are found before anything of theirs is written (Q11);
        the order of addresses decides who leads (Q10).

        Of the catalogue only the buckets of these addresses, their slugs and their records'
        keys are read.  Articles, keys, attempts and files (and ``also``, more logs) are one
        commit, so a run that dies leaves the catalogue as it was."""
        own = urls.withColumn("url", normalize_article_url(F.col("url"))).filter(is_article_url(F.col("url"), self.site))
        own = own.withColumn("slug", slug_from_url(F.col("url"))).select("url", "ord", "slug")
        resume = resume and bool(self.catalog.commits())
        plan = cut(self._planned(cut(own), retry_failed) if resume else frontier.planned(own, own, own, resume=False))
        got = cut(plan.filter("action = 'fetch'").select("url", "ord").join(self._fetched(frontier.pending(plan)), "url"))
        good = got.filter("error is null")
        made = cut(good.select("ord", "url").join(self._records(good).withColumnRenamed("article_url", "url0"), F.col("url") == F.col("url0")).withColumnRenamed("url0", "article_url"))
        keyed = made.select("ord", records.keys_of(made).alias("keys"))
        if resume:
            match = cut(dedupe.existing_match(keyed, self.catalog.owners(keyed.select(F.explode("keys").alias("dup_key"))), "ord", "keys"))
            keyed = keyed.join(match.filter("duplicate_of is null"), "ord", "left_semi")
        else:
            match = made.select("ord", F.lit(None).cast("string").alias("duplicate_of"))
        leaders = cut(dedupe.greedy_leaders(keyed, "ord", "keys"))
        kept = made.join(leaders.filter("ord = leader"), "ord", "left_semi")
        slug_of = made.select(F.col("ord").alias("leader"), F.col("slug").alias("leader_slug"))
        outcome = made.select("ord", "url").join(match, "ord", "left").join(leaders, "ord", "left").join(slug_of, "leader", "left")
        outcome = outcome.select("ord", "url", F.coalesce("duplicate_of", "leader_slug").alias("slug"))
        new, assets = self._with_files(cut(kept.drop("url")), peer_reviews)
        time = now()
        known_rows = plan.filter("action = 'known'").select("url", F.col("record_slug").alias("slug"))
        succeeded = outcome.select("url", "slug").unionByName(known_rows)
        none = F.lit(None).cast("string")
        attempts = succeeded.select("url", F.lit("success").alias("status"), F.lit(time).alias("attempted_at"), F.lit(time).alias("succeeded_at"), F.col("slug").alias("article_slug"), none.alias("error_message")).unionByName(
            got.filter("error is not null").select("url", F.lit("failed").alias("status"), F.lit(time).alias("attempted_at"), none.alias("succeeded_at"), none.alias("article_slug"), F.col("error").alias("error_message"))
        )
        self.catalog.commit({"articles": new.drop("ord"), "keys": new.select(F.explode(records.keys_of(new)).alias("dup_key"), "slug"), "attempts": attempts, "assets": assets} | (also or {}))
        if not resume:
            return new.drop("ord")
        slugs = match.select(F.col("duplicate_of").alias("slug")).unionByName(plan.select(F.col("record_slug").alias("slug"))).filter("slug is not null")
        # a checkpoint, as later commits may merge what it reads
        return cut(self.catalog.articles(slugs.join(new, "slug", "left_anti")).unionByName(new.drop("ord")))

    def _planned(self, own: DataFrame, retry_failed: bool) -> DataFrame:
        """What to do with addresses (url, ord, slug), by lookups of their states, of
        the records that have their slugs, and of those that own their addresses' keys."""
        states = cut(self.catalog.attempts(own.select("url")))
        slugs = own.select("slug").unionByName(states.filter("article_slug is not null").select(F.col("article_slug").alias("slug")))
        by_url = own.select(F.concat(F.lit("url:"), F.lower("url")).alias("dup_key"))
        named = self.catalog.owners(by_url).select(F.col("first_id").alias("slug"), F.substr("dup_key", F.lit(len("url:") + 1)).alias("article_url"))
        return frontier.planned(own, states, self.catalog.names(slugs).unionByName(named), retry_failed)

    def _with_files(self, new: DataFrame, peer_reviews: bool) -> tuple[DataFrame, DataFrame]:
        """SNK1-SNK4: writes each record's markdown, PDFs and JSON, and its slim form to the
        JSON lines; returns the records with the paths, and rows of the log ``assets``: a file
        that can't be had is one with its error, and no reason to lose the record (Q11)."""
        folder = self.catalog.folder
        named = lambda end: F.concat("slug", F.lit(end)).alias("name")
        slug = F.regexp_replace("name", r"\.[a-z]+$", "").alias("slug")
        written = files.write_blobs(new.filter("body_markdown is not null").select(named(".md"), "body_markdown"), f"{folder}/markdown", "name", "body_markdown")
        assets = [written.select(slug, F.lit("markdown_path").alias("kind"), "path", "error")]
        for kind, wanted in (("article_pdf", True), ("peer_review_pdf", peer_reviews)):
            if not wanted or self._downloaded is None:
                continue
            urls = new.filter(F.col(f"{kind}_url").isNotNull()).select("slug", F.col(f"{kind}_url").alias("url"))
            got = cut(urls.join(self._downloaded(urls.select("url").distinct()), "url"))
            written = files.write_blobs(got.filter("error is null").select(named(".pdf"), "content"), f"{folder}/{kind}s", "name", "content")
            assets += [written.select(slug, F.lit(f"{kind}_path").alias("kind"), "path", "error"), got.filter("error is not null").select("slug", F.lit(f"{kind}_path").alias("kind"), F.lit(None).cast("string").alias("path"), "error")]
        whole = reduce(DataFrame.unionByName, assets)
        kinds = ("markdown_path", "article_pdf_path", "peer_review_pdf_path")
        paths = whole.groupBy("slug").agg(*[F.max(F.when(F.col("kind") == k, F.col("path"))).alias(k) for k in kinds])
        out = new.drop(*kinds).join(paths, "slug", "left").withColumn("record_path", F.concat(F.lit(f"{folder}/records/"), "slug", F.lit(".json")))
        out = cut(out.select(*new.columns))
        files.write_blobs(records.as_json(out.drop("ord"), "slug").select(named(".json"), "json"), f"{folder}/records", "name", "json")
        files.append_jsonl(out.select("ord", *records.SUMMARY), f"{folder}/articles.jsonl", ["ord"])
        return out, whole

    def _records(self, scrapes: DataFrame) -> DataFrame:
        """Fields that the fetcher left out come from the page's markup."""
        html = F.coalesce("html", "raw_html")
        full = scrapes.select(
            "url",
            F.coalesce("markdown", html_markdown(html)).alias("markdown"),
            "html",
            F.coalesce("links", html_links(html, self.site)).alias("links"),
            F.coalesce("metadata", last_meta(html_meta(html, F.col("url")))).alias("metadata"),
            html_review(html).alias("review"),
        )
        return records.records(full, self.site, self.engine, labelled=F.col("review"))

    def collect_archive(self, archive: str, page: Callable[[str, int], list[str]] | None = None, max_pages: int | None = 1, resume: bool = True, retry_failed: bool = True, start: int | None = None, peer_reviews: bool = True) -> DataFrame:
        """M2, ST1-ST3: a listing's pages, from the resume page on until an empty one or
        ``max_pages``: a stream of what the engine answers, the listings of a table source in
        one batch, or those of a function (in the driver's own loop).  A batch's pages are
        logged in the commit of its articles, so a run that dies begins again with that batch."""
        first = start if start is not None else self.catalog.resume_page(archive, self.site.page_size) if resume else 1
        found: list[DataFrame] = []
        total = 0

        def collected(pages: DataFrame) -> None:
            nonlocal total
            pages = cut(pages)
            own = pages.select("archive_url", "page_number", F.size("urls").alias("page_discovered"), F.size("new_urls").alias("page_new"), "retries").cache()
            seen = own.orderBy("page_number")
            new = numbered(pages.select("page_number", F.posexplode("new_urls").alias("at", "url")), ["page_number", "at"]).select("url", "ord")
            also = {"pages": own.select("archive_url", "page_number", F.col("page_discovered").alias("articles_found"), F.lit(now()).alias("visited_at")), "underfilled": catalog.underfilled(own, page_size=self.site.page_size).select("archive_url", "page_number", "page_discovered")}
            found.append(self.collect_urls(new, resume, retry_failed, peer_reviews, also))
            for r in seen.toLocalIterator():
                total += r["page_new"]
                self.on_progress({"page_number": r["page_number"], "page_discovered": r["page_discovered"], "page_new": r["page_new"], "cumulative_discovered": total, "retry_count": r["retries"], "underfilled": 0 < r["page_discovered"] < self.site.page_size})
            own.unpersist()

        if page is not None:
            for pages in self._told(archive, page, first, max_pages):
                collected(pages)
        elif getattr(self.client, "listings", None) is not None:
            collected(with_new(self.client.pages(archive, first, max_pages)))
        elif callable(getattr(self.client, "listing", None)):
            self._streamed(archive, first, max_pages, collected)
        else:
            raise ValueError("nothing here can read listings: neither a function, nor a table, nor an engine")
        return reduce(DataFrame.unionByName, found).dropDuplicates(["slug"]) if found else self.catalog.articles().limit(0)

    def _told(self, archive: str, page: Callable[[str, int], list[str]], first: int, last: int | None) -> Iterator[DataFrame]:
        """Batches of pages of a function, as large as those of a stream."""
        pages, size = providers.iter_pages(archive, page, first, last, self.site.page_size), listing.FIRST_PAGES
        while batch := list(islice(pages, size)):
            size = min(2 * size, MOST_PAGES)
            yield self.spark.createDataFrame([(a, number, urls, new, 0) for a, number, urls, new in batch], PAGES)

    def _streamed(self, archive: str, first: int, last: int | None, collected: Callable[[DataFrame], None]) -> None:
        """Pages that the engine is asked for, as a stream; what a page has that none had before
        is keyed state.  The checkpoint lives as long as the run: a later one begins at the
        page after the last that was committed."""
        pages = listing.stream(self.spark, self.client, archive, first, last, self.site, MOST_PAGES)
        rows = with_first(pages.select("archive_url", "page_number", "retries", F.posexplode_outer("urls").alias("at", "url")).withColumn("url", F.coalesce("url", F.lit(""))), "url", ["page_number", "at"])

        def each(batch: DataFrame, number: int) -> None:
            one = lambda test: F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("at", "url")))), lambda x: x["url"])
            listed = F.col("url") != ""
            collected(batch.groupBy("archive_url", "page_number", "retries").agg(one(listed).alias("urls"), one(listed & F.col("new")).alias("new_urls")))

        query = rows.writeStream.foreachBatch(each).option("checkpointLocation", scratch(self.spark, "pages")).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    def fill_gaps_archive(self, archive: str, page: Callable[[str, int], list[str]] | None = None, max_pages: int | None = None) -> DataFrame:
        """M3, ST4."""
        self.catalog.clear_pages(archive)
        return self.collect_archive(archive, page, max_pages, start=1)

    def collect_site(self, archives: list[str], page: Callable[[str, int], list[str]] | None = None, max_pages: int | None = 1, **how) -> DataFrame:
        """M4: archive after archive; the union isn't deduplicated across them."""
        return reduce(DataFrame.unionByName, [self.collect_archive(a, page, max_pages, **how) for a in archives])

    def collect_sitemap(self, documents: DataFrame | None, root: str, batch: int = 10_000, **how) -> DataFrame:
        """M5, ST5: the article addresses under a sitemap, breadth first, in batches of ``batch``:
        what a batch found is written before the next one is asked for.  Without documents
        (url, xml) the engine is asked for them."""
        urls = cut(self.discover_sitemap(documents, root))
        total, found = urls.count(), []
        for start in range(0, max(1, total), batch):
            found.append(self.collect_urls(urls.filter((F.col("ord") >= start) & (F.col("ord") < start + batch)), **how))
            self.on_progress({"discovered": min(total, start + batch), "of": total})
        return reduce(DataFrame.unionByName, found).dropDuplicates(["slug"])

    def discover(self, query: str, limit: int = 20) -> DataFrame:
        """M6, SRC3."""
        return providers.searched(self.spark, self.client, query, limit, self.site)

    def discover_archive(self, archive: str, page: Callable[[str, int], list[str]] | None = None, max_pages: int | None = 5, year: int | None = None) -> DataFrame:
        return discover_archive(self.spark, archive, page or self.client, max_pages, year, self.site)

    def discover_site(self, archives: list[str], page: Callable[[str, int], list[str]] | None = None, max_pages: int | None = 20) -> DataFrame:
        return discover_site(self.spark, archives, page or self.client, max_pages, self.site)

    def discover_sitemap(self, documents: DataFrame | None, root: str) -> DataFrame:
        if documents is not None:
            return discover_sitemap(documents, root, self.site)
        return crawl_sitemap(self.spark, self.client, root, self.site, self.on_progress)

    def stats(self) -> dict:
        return self.catalog.stats()


def crawl_sitemap(spark: SparkSession, client, root: str, site: SiteProfile = DEFAULT, on_progress: Callable[[dict], None] | None = None) -> DataFrame:
    """SRC11, SRC12: url and ord of the articles below the sitemap ``root``, whose documents the
    engine is asked for.  Documents and entries that can't be read are told as events."""
    pages, errors = sitemaps.crawled(spark, client.content, root)
    if on_progress:
        for r in errors.toLocalIterator():
            on_progress({"sitemap": r["src"], "error": r["error"]})
    return _articles(pages, site)


def _articles(pages: DataFrame, site: SiteProfile) -> DataFrame:
    """Sitemap entries (level, src, at, dst) as the articles' addresses in order."""
    urls = pages.select(normalize_article_url(F.col("dst")).alias("url"), F.struct("level", "src", "at").alias("place")).filter(is_article_url(F.col("url"), site))
    first = dedupe.first_by(urls, ["url"], ["place"])
    return numbered(first.select("url", "place"), ["place"]).select("url", "ord")


def discover_sitemap(documents: DataFrame, root: str, site: SiteProfile = DEFAULT) -> DataFrame:
    """SRC11: url and ord of the articles below the sitemap ``root`` among documents (url, xml)."""
    entries = providers.sitemap_entries(documents)
    start = documents.sparkSession.createDataFrame([(root,)], "node string")
    reached = frontier.closure(start, entries.filter("kind = 'index'").select("src", "dst"))
    pages = entries.filter("kind = 'page'").join(reached.select(F.col("node").alias("src"), "level"), "src")
    return _articles(pages, site)


def with_new(pages: DataFrame) -> DataFrame:
    """Pages (archive_url, page_number, urls) of one archive with ``new_urls``: what no page
    before has."""
    rows = pages.select("page_number", F.posexplode("urls").alias("at", "url"))
    first = dedupe.first_by(rows, ["url"], ["page_number", "at"]).groupBy("page_number").agg(F.array_sort(F.collect_list(F.struct("at", "url"))).alias("new"))
    urls = F.transform(F.coalesce("new", F.array().cast(first.schema["new"].dataType.simpleString())), lambda x: x["url"])
    return pages.join(first, "page_number", "left").select("archive_url", "page_number", "urls", urls.alias("new_urls"), F.lit(0).alias("retries"))


def listed(spark: SparkSession, archive: str, source, first: int = 1, last: int | None = None, site: SiteProfile = DEFAULT) -> DataFrame:
    """SRC8: the pages of a listing with what is new on each, from a function of archive and
    page, a table source with listings, or an engine, whose pages come as a stream and are
    written as they come."""
    if getattr(source, "listings", None) is not None:
        return with_new(source.pages(archive, first, last))
    if not callable(getattr(source, "listing", None)):
        if not callable(source):
            raise ValueError("nothing here can read listings: neither a function, nor a table, nor an engine")
        pages = providers.listing_pages(spark, archive, source, first, last, site.page_size)
        return pages.select("archive_url", "page_number", F.col("page_urls").alias("urls"), "new_urls", F.lit(0).alias("retries"))
    folder = scratch(spark, "listed")
    query = listing.stream(spark, source, archive, first, last, site).writeStream.format("parquet").option("path", f"{folder}/pages").option("checkpointLocation", f"{folder}/checkpoint").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return with_new(spark.read.schema(listing.SCHEMA).parquet(f"{folder}/pages"))


def discover_archive(spark: SparkSession, archive: str, source, max_pages: int | None = 5, year: int | None = None, site: SiteProfile = DEFAULT) -> DataFrame:
    """SRC9, U3: url and ord of what a listing has."""
    if year is not None:
        archive = spark.range(1).select(listing_url_with_year(F.lit(archive), F.lit(year))).first()[0]
    return providers.discovered(listed(spark, archive, source, last=max_pages, site=site))


def discover_site(spark: SparkSession, archives: list[str], source, max_pages: int | None = 20, site: SiteProfile = DEFAULT) -> DataFrame:
    """SRC10."""
    return frontier.union_sources(*[discover_archive(spark, a, source, max_pages, site=site) for a in archives])
