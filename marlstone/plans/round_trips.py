"""Sources, sinks, engines, collecting and parsing, run end to end over the driver's tables in a
scratch folder, and the same result in SQL."""

from __future__ import annotations

import contextlib
import gzip
import io
import json
import zipfile
import zlib
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pa_fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import extract, html, ids, text, urls
from ..operators import bibliography, blocks, records, tables, tasks
from ..operators.checkpoints import cut, scratch
from ..profile import DEFAULT
from ..sources import clients, files, listing, providers, sitemaps
from ..streaming.polls import final_states
from .collect import Collector, discover_archive, discover_site, discover_sitemap, listed
from .queries import AUTHORS, HEADINGS, PARTS, RECORDS, ROWS, _blocks, query, scrapes, table

c = F.col
A = DEFAULT.article_prefix


def none():
    return F.lit(None).cast("string")



# -- lists, logs, files ------------------------------------------------------------------


@query("SELECT CAST(ord AS BIGINT) AS ord, url FROM (VALUES (0, 'b'), (1, 'a'), (2, 'b')) t(ord, url)")
def url_list(spark, sf_dir):
    return files.urls_from_list(spark, ["b", "a", "b"])


def _text_lines(spark: SparkSession, rows: DataFrame, order: list[str]) -> str:
    """The column ``value`` of rows as a folder of text files, in order."""
    path = scratch(spark, "lines")
    rows.repartitionByRange(3, *order).sortWithinPartitions(*order).select("value").write.text(path)
    return path


@query("SELECT trim(url) AS url, row_number() OVER (ORDER BY page_id) - 1 AS ord FROM pages")
def url_file(spark, sf_dir):
    lines = F.array(F.concat(F.lit("# page "), c("page_id").cast("string")), F.lit("  "), F.concat(F.lit(" "), "url", F.lit("\t")))
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(lines).alias("k", "value"))
    return files.urls_from_file(spark, _text_lines(spark, rows, ["page_id", "k"]))


@query("SELECT CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '10.1/' || c_custkey END AS doi, row_number() OVER (ORDER BY c_custkey) - 1 AS ord FROM customer")
def doi_list(spark, sf_dir):
    value = F.when(c("c_custkey") % 7 == 0, "").otherwise(F.concat(F.lit(" 10.1/"), c("c_custkey").cast("string"), F.lit(" ")))
    return files.doi_list(spark, _text_lines(spark, table(spark, sf_dir, "customer").select("c_custkey", value.alias("value")), ["c_custkey"]))


@query("SELECT 'u' || user_id AS slug, arg_max(event_type || event_id, (event_id % 2) * 1000000000 + event_id) AS title FROM events GROUP BY user_id")
def jsonl_roundtrip(spark, sf_dir):
    path = scratch(spark, "log")
    rows = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("u"), c("user_id").cast("string")).alias("slug"), F.concat("event_type", c("event_id").cast("string")).alias("title"))
    for odd in (0, 1):  # two appends, which between them have every row
        files.append_jsonl(rows.filter(c("event_id") % 2 == odd), path, ["event_id"])
    return files.records_from_jsonl(spark, path).select("slug", "title")


@query("SELECT CAST(page_id AS VARCHAR) || '.html' AS name, CAST(octet_length(encode(html)) AS BIGINT) AS n_bytes, sha256(html) AS sha FROM pages")
def blob_roundtrip(spark, sf_dir):
    folder = scratch(spark, "blobs")
    files.write_blobs(table(spark, sf_dir, "pages").select(F.concat(c("page_id").cast("string"), F.lit(".html")).alias("name"), "html"), folder, "name", "html")
    found = spark.read.format("binaryFile").load(folder)
    return found.select(ids.base_name(c("path")).alias("name"), c("length").alias("n_bytes"), F.sha2("content", 256).alias("sha"))


PDFS = "SELECT 'a/' || s_suppkey || '.pdf' AS place, '%PDF-1.4 << /Title (' || s_name || ') /Author (n' || s_nationkey || ') >>' AS body FROM supplier UNION ALL SELECT 'b/' || n_nationkey || '.PDF', '%PDF-1.4 nothing' FROM nation UNION ALL SELECT 'b/' || n_nationkey || '.txt', 'x' FROM nation"


def _pdfs(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch(spark, "pdfs")
    rows = spark.sql(PDFS.replace("FROM supplier", "FROM {s}").replace("FROM nation", "FROM {n}"), s=table(spark, sf_dir, "supplier"), n=table(spark, sf_dir, "nation"))
    for sub in ("a", "b"):
        own = rows.filter(c("place").startswith(f"{sub}/")).select(ids.base_name(c("place")).alias("name"), "body")
        files.write_blobs(own, f"{folder}/{sub}", "name", "body")
    return folder


@query(f"SELECT place, CAST(length(body) AS BIGINT) AS length FROM ({PDFS}) WHERE lower(place) LIKE '%.pdf'")
def pdf_scan(spark, sf_dir):
    found = files.pdf_files(spark, _pdfs(spark, sf_dir))
    return found.select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("place"), "length")


@query(f"SELECT substr(place, 3) AS name FROM ({PDFS}) WHERE place LIKE 'a/%.pdf'")
def pdf_scan_flat(spark, sf_dir):
    return files.pdf_files(spark, f"{_pdfs(spark, sf_dir)}/a", recursive=False).select("name")


@query("SELECT CAST(s_suppkey AS VARCHAR) || '.pdf' AS name, s_name AS title, 'n' || s_nationkey AS author FROM supplier UNION ALL SELECT n_nationkey || '.PDF', NULL, NULL FROM nation")
def pdf_metadata(spark, sf_dir):
    info = files.pdf_files(spark, _pdfs(spark, sf_dir), content=True).select("name", files.pdf_info(c("content")).alias("i"))
    return info.select("name", c("i")["Title"].alias("title"), c("i")["Author"].alias("author"))


@query("SELECT '/d/' || n_nationkey || CASE WHEN n_nationkey % 4 = 0 THEN '.txt' ELSE '.pdf' END AS path, n_nationkey % 4 = 1 AS ok, CASE n_nationkey % 4 WHEN 0 THEN 'not a PDF' WHEN 2 THEN 'empty' WHEN 3 THEN 'missing' END AS why FROM nation")
def validated_files(spark, sf_dir):
    k = c("n_nationkey")
    path = F.concat(F.lit("/d/"), k.cast("string"), F.when(k % 4 == 0, ".txt").otherwise(".pdf"))
    rows = table(spark, sf_dir, "nation").select(path.alias("path"), F.when(k % 4 == 1, 9).otherwise(0).alias("length"), k.alias("k"))
    return files.validated(rows.filter("k % 4 <> 3").withColumn("path", F.concat(F.lit("file:"), "path")), rows)


# -- engines, search, listings -------------------------------------------------------------


@query(f"WITH h AS (SELECT '{A}ncomms' || (n_nationkey % 10) AS url, min(n_nationkey) AS ord FROM nation GROUP BY 1) SELECT url, CAST(ord AS BIGINT) AS ord FROM h ORDER BY ord LIMIT 7")
def search_hits(spark, sf_dir):
    hits = table(spark, sf_dir, "nation").select(F.lit("q").alias("query"), c("n_nationkey").cast("bigint").alias("ord"), F.concat(F.lit(f"{A}ncomms"), (c("n_nationkey") % 10).cast("string"), F.lit("?a=b")).alias("url"))
    return providers.searched(spark, providers.TableSource(hits, searches=hits), "q", 20).filter("ord < 7")


class _Web:
    """A transport for either engine that answers from a table (url, status, body), which lies
    in the shared folder in parts by address: a request reads one part, and nothing of the
    table goes through the driver or into a task's closure.  Parts are as many as the table
    needs to have some ``rows`` in each, so a request costs the same however large it is."""

    rows = 512

    def __init__(self, folder: str, parts: int):
        self.folder, self.parts = folder, parts

    @classmethod
    def of(cls, rows: DataFrame) -> _Web:
        folder, rows = scratch(rows.sparkSession, "web"), cut(rows.select("url", "status", "body"))
        parts = max(1, -(-rows.count() // cls.rows))
        dealt = rows.withColumn("part", (F.crc32(F.encode("url", "UTF-8")) % parts).cast("int"))
        dealt.repartition("part").write.partitionBy("part").parquet(folder)  # a part is one file
        return cls(folder, parts)

    def __call__(self, url: str) -> tuple[int, str]:
        store, base = pa_fs.FileSystem.from_uri(self.folder) if ":" in self.folder else (pa_fs.LocalFileSystem(), self.folder)
        part = f"{base}/part={zlib.crc32(url.encode()) % self.parts}"
        if store.get_file_info(part).type == pa_fs.FileType.NotFound:
            return 404, ""
        for file in store.get_file_info(pa_fs.FileSelector(part)):
            if file.base_name.endswith(".parquet"):
                with store.open_input_file(file.path) as opened:
                    held = pq.ParquetFile(opened).read(["url", "status", "body"], use_threads=False)
                at = pc.index(held["url"], url).as_py()
                if at >= 0:
                    return held["status"][at].as_py(), held["body"][at].as_py()
        return 404, ""

    def get(self, url: str, headers: dict) -> tuple[int, bytes]:
        status, body = self(url)
        return status, body.encode()

    def call(self, method: str, arguments: dict) -> dict:
        status, body = self(arguments["url"])
        if status >= 400:
            raise OSError(f"status {status} at {arguments['url']}")
        return {"data": {"markdown": f"# {body}", "rawHtml": body, "links": [arguments["url"]], "metadata": {"n": len(body), "none": None}}}


def _nations(spark: SparkSession, sf_dir: str, start: str = "http://n/") -> tuple[_Web, DataFrame]:
    """Nations as pages, of which every fifth isn't there."""
    rows = table(spark, sf_dir, "nation").select(F.concat(F.lit(start), c("n_nationkey").cast("string")).alias("url"), F.when(c("n_nationkey") % 5 == 0, 404).otherwise(200).alias("status"), F.concat(F.lit("<title>"), "n_name", F.lit("</title>")).alias("body"))
    return _Web.of(rows), rows


@query("SELECT 'http://n/' || n_nationkey AS url, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS title, CASE WHEN n_nationkey % 5 = 0 THEN 'http://n/' || n_nationkey END AS error FROM nation")
def fetched_native(spark, sf_dir):
    transport, rows = _nations(spark, sf_dir)
    got = providers.fetched(rows, clients.client("native", transport.get).article, partitions=2, per_second=1000.0)
    return got.select("url", html.html_title(c("html")).alias("title"), "error")


@query("SELECT 'http://n/' || n_nationkey AS url, CASE WHEN n_nationkey % 5 <> 0 THEN '# <title>' || n_name || '</title> ' || (15 + length(n_name)) || ' 1 ' || '<title>' || n_name || '</title>' END AS fields, CASE WHEN n_nationkey % 5 = 0 THEN 'status 404 at http://n/' || n_nationkey END AS error FROM nation")
def fetched_service(spark, sf_dir):
    transport, rows = _nations(spark, sf_dir)
    got = providers.fetched(rows, clients.client("service", transport.call).article)
    return got.select("url", F.concat("markdown", F.lit(" "), c("metadata")["n"], F.lit(" "), F.size("links").cast("string"), F.lit(" "), "raw_html").alias("fields"), "error")


@query("SELECT 'http://n/' || n_nationkey AS url, CASE WHEN n_nationkey % 5 <> 0 THEN sha256('<title>' || n_name || '</title>') END AS sha FROM nation")
def downloads(spark, sf_dir):
    transport, rows = _nations(spark, sf_dir)
    return providers.downloaded(rows, clients.client("native", transport.get).content, partitions=2, per_second=1000.0).select("url", F.sha2("content", 256).alias("sha"))


@query("SELECT '10.1/' || n_nationkey AS doi, CASE WHEN n_nationkey % 5 <> 0 THEN '<title>' || n_name || '</title>' END AS html FROM nation")
def landing_pages(spark, sf_dir):
    moved, _ = _nations(spark, sf_dir, "https://doi.org/10.1/")
    dois = table(spark, sf_dir, "nation").select(F.concat(F.lit("10.1/"), c("n_nationkey").cast("string")).alias("url"))
    native = clients.client("native", moved.get)

    def landing(doi: str) -> bytes | None:
        page = clients.landing_html(native, doi)
        return page if page is None else page.encode()

    return providers.downloaded(dois, landing).select(c("url").alias("doi"), F.decode("content", "UTF-8").alias("html"))


def _listing(spark: SparkSession, sf_dir: str, archives: dict[str, int]) -> providers.TableSource:
    """Suppliers as listings with pages of 20 addresses, one for each modulus of keys."""
    rows = table(spark, sf_dir, "supplier")
    number = F.floor(c("s_suppkey") / 20 + 1).cast("int").alias("page_number")
    one = lambda name, of: rows.groupBy(number).agg(F.transform(F.array_sort(F.collect_list("s_suppkey")), lambda k: F.concat(F.lit("s"), (k % of).cast("string"))).alias("urls")).withColumn("archive_url", F.lit(name))
    return providers.TableSource(rows, listings=reduce(DataFrame.unionByName, [one(name, of) for name, of in archives.items()]))


@query("SELECT 's' || (s_suppkey % 97) AS url, row_number() OVER (ORDER BY min(s_suppkey)) - 1 AS ord FROM supplier GROUP BY 1")
def listing_discovered(spark, sf_dir):
    return discover_archive(spark, "x", _listing(spark, sf_dir, {"x": 97}), None)


@query("""WITH s AS (SELECT (row_number() OVER (ORDER BY s_suppkey) - 1) // 20 + 1 AS page_number FROM supplier), p AS (SELECT page_number, count(*) AS n FROM s GROUP BY 1)
SELECT * FROM p WHERE page_number <= 3 UNION ALL SELECT * FROM (SELECT max(page_number) + 1 AS p, 0 FROM p) WHERE p <= 3""")
def listing_pages(spark, sf_dir):
    pages = listed(spark, "x", _listing(spark, sf_dir, {"x": 10**9}), last=3)
    return pages.select(c("page_number").cast("bigint").alias("page_number"), F.size("urls").cast("bigint").alias("n"))


@query("WITH s AS (SELECT 's' || (s_suppkey % 97) AS url, 0 AS list, s_suppkey AS k FROM supplier UNION ALL SELECT 's' || (s_suppkey % 130), 1, s_suppkey FROM supplier) SELECT url, min(list) AS list FROM s GROUP BY url")
def site_discovered(spark, sf_dir):
    found = discover_site(spark, ["0", "1"], _listing(spark, sf_dir, {"0": 97, "1": 130}), None)
    return found.select("url", "place.list")


def _markup(spark: SparkSession, sf_dir: str, of: str, key: str, name: str) -> _Web:
    """Rows of a table as a site: article pages with a title, and a listing of 20 links a
    page, as markup, under the addresses that its pages have."""
    rows, k = table(spark, sf_dir, of), c(key).cast("string")
    title = F.concat(F.lit("<title>"), name, F.lit("</title><main><h1>"), name, F.lit("</h1></main>"))
    articles = rows.select(F.concat(F.lit(f"{A}ncomms"), k).alias("url"), F.lit(200).alias("status"), title.alias("body"))
    number = F.floor(c(key) / 20 + 1).cast("int").alias("number")
    link = F.struct(c(key).alias("at"), F.concat(F.lit('<li><a href="/articles/ncomms'), k, F.when(c(key) % 3 == 0, "?a=b").when(c(key) % 3 == 1, "#x").otherwise("/"), F.lit('">x</a><a href="/other">y</a></li>')).alias("tag"))
    pages = rows.groupBy(number).agg(F.array_join(F.transform(F.array_sort(F.collect_list(link)), lambda x: x["tag"]), "").alias("body"))
    listings = pages.select(urls.archive_page_url(F.lit(DEFAULT.archive), c("number")).alias("url"), F.lit(200).alias("status"), F.concat(F.lit("<ul>"), "body", F.lit("</ul>")).alias("body"))
    return _Web.of(articles.unionByName(listings))


@query("SELECT CAST(s_suppkey // 20 + 1 AS INTEGER) AS page_number, string_agg('ncomms' || s_suppkey, ' ' ORDER BY s_suppkey) AS slugs, CAST(CASE WHEN count(*) < 20 THEN 1 ELSE 0 END AS INTEGER) AS retries FROM supplier GROUP BY 1 UNION ALL SELECT CAST(max(s_suppkey // 20) + 2 AS INTEGER), '', CAST(0 AS INTEGER) FROM supplier")
def listing_stream(spark, sf_dir):
    """A listing's markup, page by page as a stream that ends at the first page that isn't there."""
    web, folder = _markup(spark, sf_dir, "supplier", "s_suppkey", "s_name"), scratch(spark, "pages")
    pages = listing.stream(spark, clients.client("native", web.get), DEFAULT.archive)
    slugs = F.array_join(F.transform("urls", lambda u: F.replace(u, F.lit(A), F.lit(""))), " ")
    stream = pages.select("page_number", slugs.alias("slugs"), "retries").writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint").start()
    stream.processAllAvailable()
    stream.stop()
    return spark.read.schema("page_number int, slugs string, retries int").parquet(f"{folder}/rows")


@query("SELECT 'ncomms' || n_nationkey AS slug, n_name AS title, CAST(n_nationkey // 20 + 1 AS INTEGER) AS page_number FROM nation")
def native_archive(spark, sf_dir):
    """A listing and its articles, both asked of the engine."""
    told: list[dict] = []
    web = _markup(spark, sf_dir, "nation", "n_nationkey", "n_name")
    collector = Collector(spark, scratch(spark, "catalog"), clients.client("native", web.get), on_progress=told.append, partitions=4)
    got = collector.collect_archive(DEFAULT.archive, max_pages=None)
    pages = collector.catalog.pages().filter("articles_found > 0").select("page_number", (c("page_number") * 20).alias("last"))
    number = F.regexp_extract("slug", r"(\d+)$", 1).cast("int")
    return got.select("slug", "title", F.floor(number / 20 + 1).cast("int").alias("page_number")).join(pages.select("page_number"), "page_number", "left_semi")


@query("SELECT CAST(p AS INTEGER) AS page_number FROM range(1, 5) t(p)")
def listing_ends(spark, sf_dir):
    """A listing read page by page in parallel ends at its first empty page."""
    rows = table(spark, sf_dir, "nation").filter("n_nationkey > 0")  # pages 4 and 7 are empty
    pages = rows.select(F.lit("x").alias("archive_url"), c("n_nationkey").cast("int").alias("page_number"), F.when(c("n_nationkey").isin(4, 7), F.array().cast("array<string>")).otherwise(F.array("n_name")).alias("urls"))
    return providers.until_empty(pages).select("page_number")


class _Hit:
    def __init__(self, url: str):
        self.url = url


@query(f"SELECT '{A}ncomms' || n_nationkey AS url, CAST(n_nationkey AS BIGINT) AS ord FROM nation WHERE n_nationkey % 2 = 0")
def search_service(spark, sf_dir):
    """A service's answer: objects, nested under ``data``, of which odd ones are no articles."""
    keys = [r[0] for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").select("n_nationkey").collect()]
    hits = [_Hit(f"{A}ncomms{k}/#x" if k % 2 == 0 else f"http://other/{k}") for k in keys]
    return providers.searched(spark, clients.client("service", lambda method, arguments: {"data": {"web": hits}}), "q", 1000)


@query("""SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN 'http://h.org/a/x' || c_custkey WHEN 1 THEN 'http://h.org/a/b/y' || c_custkey || '?q=1' WHEN 2 THEN 'http://o.org/' || c_custkey
  WHEN 3 THEN 'http://h.org/a/b/c?p=2#f' || c_custkey WHEN 4 THEN 'http://h.org/r/' || c_custkey ELSE 'http://h.org/a/b/c?k=' || c_custkey END AS url FROM customer""")
def resolve_relative(spark, sf_dir):
    starts = ("../x", "./y", "//o.org/", "#f", "/q/../r/", "?k=")
    k = c("c_custkey")
    href = F.coalesce(*[F.when(k % 6 == i, F.concat(F.lit(x), k.cast("string"), F.lit("?q=1" if i == 1 else ""))) for i, x in enumerate(starts)])
    return table(spark, sf_dir, "customer").select(k.alias("k"), urls.resolve(F.lit("http://h.org/a/b/c?p=2"), href).alias("url"))


@query("SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events")
def date_stamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.stamp(c("ts")).alias("stamp"), text.iso_time(c("ts")).alias("iso"))


SITEMAP = f"""WITH e AS (SELECT 'map' || c_nationkey AS src, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS pos, '{A}ncomms' || (c_custkey % 500) AS url FROM customer),
f AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY url ORDER BY src, pos) = 1)"""


def _sitemap(spark: SparkSession, sf_dir: str, of: str = "customer", key: str = "c_custkey", nation: str = "c_nationkey", modulus: int = 500) -> DataFrame:
    """Sitemap documents: a root, and for each nation a set of addresses."""
    loc = lambda kind, x: F.concat(F.lit(f"<{kind}><loc>"), x, F.lit(f"</loc></{kind}>"))
    rows = table(spark, sf_dir, of).groupBy(nation).agg(F.array_sort(F.collect_list(key)).alias("ks"))
    sets = rows.select(F.concat(F.lit("map"), c(nation).cast("string")).alias("url"), F.concat(F.lit("<urlset>"), F.array_join(F.transform("ks", lambda k: loc("url", F.concat(F.lit(f"{A}ncomms"), (k % modulus).cast("string")))), ""), F.lit("</urlset>")).alias("xml"))
    maps = F.array_join(F.collect_list(loc("sitemap", F.concat(F.lit("map"), c("n_nationkey").cast("string")))), "")
    root = table(spark, sf_dir, "nation").agg(maps.alias("x")).select(F.lit("root").alias("url"), F.concat(F.lit("<sitemapindex>"), "x", F.lit("</sitemapindex>")).alias("xml"))
    return root.unionByName(sets)


@query(f"{SITEMAP} SELECT url, row_number() OVER (ORDER BY src, pos) - 1 AS ord FROM f")
def sitemap_order(spark, sf_dir):
    return discover_sitemap(_sitemap(spark, sf_dir), "root")


@query("SELECT 'http://w/' || (c_custkey % 50) AS src, 'index' AS kind, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS total FROM customer WHERE c_custkey % 7 = 0 GROUP BY 1 UNION ALL SELECT 'http://w/' || (c_custkey % 50), 'page', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_custkey % 7 <> 0 GROUP BY 1")
def sitemap_files(spark, sf_dir):
    """Entries of sitemap files, of which every second is compressed, read by their tags."""
    k = c("c_custkey")
    tag = F.when(k % 7 == 0, "sitemap").otherwise("url")
    entry = F.concat(F.lit("<"), tag, F.lit("><lastmod>2024</lastmod><loc> http://x?a=1&amp;k="), k.cast("string"), F.lit(" </loc></"), tag, F.lit(">"))
    rows = table(spark, sf_dir, "customer").withColumn("file", k % 50).select("file", k.alias("k"), entry.alias("e"))
    body = F.concat(F.lit('<?xml version="1.0"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n'), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "e"))), lambda x: x["e"]), "\n"), F.lit("\n</urlset>"))
    made = rows.groupBy("file").agg(F.encode(body, "UTF-8").alias("content"))

    @F.arrow_udf("binary")
    def packed(contents):
        return pa.array((gzip.compress(x.as_py()) for x in contents), pa.binary())

    folder, odd = scratch(spark, "sitemaps"), c("file") % 2 == 1
    named = made.select(F.concat(c("file").cast("string"), F.when(odd, ".xml.gz").otherwise(".xml")).alias("name"), F.when(odd, packed(c("content"))).otherwise(c("content")).alias("content"))
    files.write_blobs(named, folder, "name", "content")
    found = sitemaps.entries(spark, folder).select(F.concat(F.lit("http://w/"), F.regexp_extract("file", r"(\d+)\.xml(\.gz)?$", 1)).alias("src"), "kind", F.regexp_extract("dst", r"^http://x\?a=1&k=(\d+)$", 1).cast("bigint").alias("k"))
    return found.groupBy("src", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


@query(f"SELECT '{A}ncomms' || s_suppkey AS url, CAST(s_nationkey AS INTEGER) AS nation FROM supplier")
def sitemap_crawled(spark, sf_dir):
    """A sitemap of sitemaps, one for each nation, fetched through the engine."""
    k = c("s_suppkey").cast("string")
    rows = table(spark, sf_dir, "supplier")
    sets = rows.groupBy("s_nationkey").agg(F.array_join(F.collect_list(F.concat(F.lit(f"<url><loc>{A}ncomms"), k, F.lit("?x=1</loc></url>"))), "\n").alias("x")).select(F.concat(F.lit("http://w/"), c("s_nationkey").cast("string")).alias("url"), F.lit(200).alias("status"), F.concat(F.lit("<urlset>"), "x", F.lit("</urlset>")).alias("body"))
    index = table(spark, sf_dir, "nation").agg(F.array_join(F.collect_list(F.concat(F.lit("<sitemap><loc>http://w/"), c("n_nationkey").cast("string"), F.lit("</loc></sitemap>"))), "\n").alias("x")).select(F.lit("http://w/root").alias("url"), F.lit(200).alias("status"), F.concat(F.lit("<sitemapindex>"), "x", F.lit("</sitemapindex>")).alias("body"))
    web = _Web.of(sets.unionByName(index))
    pages, _ = sitemaps.crawled(spark, clients.client("native", web.get).content, "http://w/root")
    return pages.select(urls.normalize_article_url(c("dst")).alias("url"), F.regexp_extract("src", r"(\d+)$", 1).cast("int").alias("nation"))


@query("SELECT '10.1/' || s_suppkey AS doi, CASE WHEN s_suppkey % 5 < 3 THEN s_nationkey END AS citations, CAST(least(s_suppkey % 5 + 1, 3) AS INTEGER) AS tries, CASE WHEN s_suppkey % 5 >= 3 THEN 'busy' END AS error FROM supplier")
def works_looked_up(spark, sf_dir):
    """Works asked for in rounds: some come at the second or third try, some never."""
    k = c("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("10.1/"), k.cast("string")).alias("url"), F.lit(200).alias("status"), F.to_json(F.struct((k % 5).alias("after"), c("s_nationkey").alias("is-referenced-by-count"), F.array("s_name").alias("container-title"))).alias("body"))
    web = _Web.of(rows)

    def lookup(doi: str, retry: int) -> dict | None:
        work = json.loads(web(doi)[1])
        if retry < work["after"]:
            raise OSError("busy")
        return work

    works, dead = bibliography.looked_up(rows.select(c("url").alias("doi")), lookup, gap=0.0)
    return works.select("doi", c("work.is_referenced_by_count").cast("int").alias("citations"), "tries", none().alias("error")).unionByName(dead.select("doi", F.lit(None).cast("int").alias("citations"), "tries", "error"))


# -- fields of pages ---------------------------------------------------------------------------


@query(f"""
WITH l AS (SELECT c_custkey AS k, [('{A}ncomms' || c_custkey), '{A}ncomms' || (c_custkey + 1), '{A}ncomms' || (c_custkey + 2), '{A}ncomms' || (c_custkey + 3)] AS urls FROM customer)
SELECT k, array_to_string(urls, ' ') AS urls FROM l
""")
def listing_urls(spark, sf_dir):
    at = lambda n: F.concat(F.lit(f"{A}ncomms"), (c("c_custkey") + n).cast("string"))
    links = F.array(F.concat(at(0), F.lit("/?x=1")), F.concat(F.lit("/articles/ncomms"), (c("c_custkey") + 1).cast("string")), none(), F.lit("http://other/ncomms1"))
    markdown = F.concat(F.lit("[a]("), at(2), F.lit(") "), at(1))
    raw = F.concat(F.lit('<a href="'), at(3), F.lit('#top">'))
    found = extract.listing_urls(links, markdown, none(), raw, F.lit(f"{DEFAULT.host}/list"))
    return table(spark, sf_dir, "customer").select(c("c_custkey").alias("k"), F.array_join(found, " ").alias("urls"))


@query("SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN 'http://s/' || s_suppkey || '.pdf' WHEN 1 THEN 'http://l/' || s_suppkey || '.PDF' END AS url FROM supplier")
def review_markup(spark, sf_dir):
    k = c("s_suppkey").cast("string")
    kinds = [('<div data-test="supp-item"><h3>A Peer Review file</h3><a href="http://s/', '.pdf">x</a></div>'), ('<div data-test="supp-item"><a data-track-label="peer review" href="http://l/', '.PDF">x</a></div>'), ('<div data-test="supp-item"><h3>Data</h3><a href="http://d/', '.pdf">x</a></div>'), ('<div><h3>Peer Review</h3><a href="http://o/', '.pdf">x</a></div>')]
    page = F.coalesce(*[F.when(c("s_suppkey") % 4 == i, F.concat(F.lit(a), k, F.lit(b))) for i, (a, b) in enumerate(kinds)])
    return table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("k"), html.html_review(page).alias("url"))


@query("SELECT s_suppkey AS k, '# ' || s_name || chr(10) || chr(10) || '## Part' || chr(10) || chr(10) || 'n' || s_nationkey || chr(10) || 'end' AS markdown FROM supplier")
def article_markdown(spark, sf_dir):
    page = F.concat(F.lit('<script>no()</script><h1 class="c-article-title"> '), "s_name", F.lit('</h1><section class="c-article-section"><h2>Part</h2><p>n'), c("s_nationkey").cast("string"), F.lit("</p><p>end</section>"))
    return table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("k"), html.html_markdown(page).alias("markdown"))


@query("SELECT s_suppkey AS k, 'T & ' || s_name AS title, 'b' AS last, '2' AS og FROM supplier")
def meta_tags(spark, sf_dir):
    page = F.concat(F.lit("<title> T &amp; "), "s_name", F.lit(' </title><meta name="x" content="a"><META content="b" name="x"><meta property="og:n.o" content="2">'))
    meta = html.last_meta(html.html_meta(page, F.lit("u")))
    return table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("k"), meta.alias("m")).select("k", c("m")["title"].alias("title"), c("m")["x"].alias("last"), c("m")["og_n_o"].alias("og"))


WORDS = "CAST(len(regexp_extract_all(coalesce({}, ''), '[^ \\t\\n\\r\\f\\v]+')) AS INTEGER)"
DETAILS = f"""{RECORDS}, d AS (SELECT rec.*, r.md, r.meta_title, r.meta_author, r.meta_keywords FROM rec JOIN r USING (k))
SELECT k, CAST(to_json(struct_pack(source := 'native', source_url := article_url, scrape_formats := ['markdown', 'html', 'links'],
  content_stats := struct_pack(body_markdown_chars := n_chars, body_markdown_words := n_words, abstract_chars := CAST(length(coalesce(abstract, '')) AS INTEGER),
    abstract_words := {WORDS.format('abstract')}, section_count := n_sections, reference_count := CAST({{references}} AS INTEGER)),
  dates := struct_pack(received := {{received}}, accepted := {{accepted}}, published := published_date),
  authors := {AUTHORS}, keywords := coalesce({PARTS.format('meta_keywords')}, []::VARCHAR[]), section_headings := {HEADINGS},
  links := struct_pack(article_url := article_url, article_pdf_url := article_pdf_url, peer_review_pdf_url := peer_review_pdf_url),
  raw_metadata_keys := list_sort(list_filter([CASE WHEN meta_author IS NOT NULL THEN 'author' END, CASE WHEN meta_keywords IS NOT NULL THEN 'keywords' END, CASE WHEN meta_title IS NOT NULL THEN 'title' END], lambda x: x IS NOT NULL)),
  metadata_summary := struct_pack(title := meta_title, description := NULL::VARCHAR, language := NULL::VARCHAR, url := NULL::VARCHAR, og_title := NULL::VARCHAR, og_description := NULL::VARCHAR))) AS VARCHAR) AS details FROM d"""


def _details_sql() -> str:
    from .queries import DATE, REFERENCES

    return DETAILS.replace("{references}", REFERENCES).replace("{received}", DATE.format("Received")).replace("{accepted}", DATE.format("Accepted"))


@query(_details_sql())
def record_details(spark, sf_dir):
    rows = scrapes(spark, sf_dir)
    keyed = rows.withColumn("metadata", F.map_concat("metadata", F.create_map(F.lit("zz"), c("k").cast("string"))))
    made = records.records(keyed).select(c("metadata")["zz"].cast("bigint").alias("k"), "detailed_metadata")
    known = c("detailed_metadata").withField("raw_metadata_keys", F.filter("detailed_metadata.raw_metadata_keys", lambda x: x != "zz"))
    return made.select("k", F.to_json(known, {"ignoreNullFields": "false"}).alias("details"))


# -- collecting ---------------------------------------------------------------------------------------

FETCHED = "SELECT s_suppkey AS k, 'ncomms' || s_suppkey AS slug FROM supplier WHERE s_suppkey % 10 <> 3"
LEADERS = f"SELECT k % 40 AS g, min(k) AS k FROM ({FETCHED}) GROUP BY 1"


def _source(spark: SparkSession, sf_dir: str, contents: bool = False) -> providers.TableSource:
    """Suppliers as articles, of which those with equal keys modulo 40 share a title; of every
    ten one isn't there."""
    k = c("s_suppkey")
    rows = table(spark, sf_dir, "supplier").filter("s_suppkey % 10 <> 3")
    url = F.concat(F.lit(f"{A}ncomms"), k.cast("string"))
    markdown = F.concat(F.lit("# T"), (k % 40).cast("string"), F.lit("\n[Peer Review File](http://p/"), k.cast("string"), F.lit(".pdf)"))
    pages = rows.select(url.alias("url"), markdown.alias("markdown"), *[none().alias(n) for n in ("html", "raw_html")], F.lit(None).cast("array<string>").alias("links"), F.create_map().cast("map<string,string>").alias("metadata"))
    bodies = rows.filter("s_suppkey % 2 = 0").select(F.concat(F.lit("http://p/"), k.cast("string"), F.lit(".pdf")).alias("url"), F.encode(F.concat(F.lit("%PDF"), k.cast("string")), "UTF-8").alias("content"))
    return providers.TableSource(pages, contents=bodies if contents else None)


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("s_suppkey")
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit(f"{A}ncomms"), k.cast("string"), F.when(k % 3 == 0, "?x=1").otherwise("")).alias("url"), k.alias("ord"))


def _collected(spark: SparkSession, sf_dir: str, contents: bool = False) -> Collector:
    collector = Collector(spark, scratch(spark, "catalog"), _source(spark, sf_dir, contents))
    collector.collect_urls(_urls(spark, sf_dir))
    return collector


@query(f"SELECT 'ncomms' || k AS slug, 'T' || g AS title FROM ({LEADERS})")
def collect_articles(spark, sf_dir):
    return _collected(spark, sf_dir).catalog.articles().select("slug", "title")


@query(f"""SELECT '{A}ncomms' || s_suppkey AS url, CASE WHEN s_suppkey % 10 = 3 THEN 'failed' ELSE 'success' END AS status, CASE WHEN s_suppkey % 10 <> 3 THEN 'ncomms' || l.k END AS article_slug,
  CASE WHEN s_suppkey % 10 = 3 THEN 'no page at {A}ncomms' || s_suppkey END AS error_message FROM supplier LEFT JOIN ({LEADERS}) l ON l.g = s_suppkey % 40""")
def collect_attempts(spark, sf_dir):
    return _collected(spark, sf_dir).catalog.attempts().select("url", "status", "article_slug", "error_message")


@query(f"SELECT (SELECT count(*) FROM ({LEADERS})) AS total_articles, count(*) AS cached_urls, count(*) FILTER (WHERE s_suppkey % 10 <> 3) AS success_urls, count(*) FILTER (WHERE s_suppkey % 10 = 3) AS failed_urls FROM supplier")
def collect_stats(spark, sf_dir):
    stats = _collected(spark, sf_dir).stats()
    names = ("total_articles", "cached_urls", "success_urls", "failed_urls")
    return spark.createDataFrame([tuple(stats[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


@query(f"SELECT 'ncomms' || k AS slug, 'ncomms' || k || '.md' AS markdown, CASE WHEN k % 2 = 0 THEN 'ncomms' || k || '.pdf' END AS review, CASE WHEN k % 2 = 0 THEN sha256('%PDF' || k) END AS sha, 'T' || g AS title FROM ({LEADERS})")
def collect_files(spark, sf_dir):
    collector = _collected(spark, sf_dir, contents=True)
    folder = collector.catalog.folder
    base = lambda x: ids.base_name(c(x))
    rows = collector.catalog.articles().select("slug", base("markdown_path").alias("markdown"), base("peer_review_pdf_path").alias("review"))
    pdfs = spark.read.format("binaryFile").load(f"{folder}/peer_review_pdfs").select(base("path").alias("review"), F.sha2("content", 256).alias("sha"))
    written = spark.read.json(f"{folder}/records").select("slug", "title")
    return rows.join(pdfs, "review", "left").join(written, "slug").select("slug", "markdown", "review", "sha", "title")


@query(f"SELECT '{A}ncomms' || s_suppkey AS url FROM supplier WHERE s_suppkey % 10 = 3")
def collect_again(spark, sf_dir):
    """A second run asks only for what failed."""
    collector, asked = _collected(spark, sf_dir), []
    before = collector._fetched
    collector._fetched = lambda urls: asked.append(cut(urls.select("url"))) or before(urls)
    collector.collect_urls(_urls(spark, sf_dir))
    return asked[0]


def _archive(spark: SparkSession, sf_dir: str, again: bool = False) -> Collector:
    """Nations as a listing of 20 and 5 articles and an empty page."""
    collector = Collector(spark, scratch(spark, "catalog"), _nation_source(spark, sf_dir, F.lit("x"), 20))
    collector.collect_archive("x", max_pages=2 if again else None)
    if again:
        collector.fill_gaps_archive("x")
    return collector


def _nation_source(spark: SparkSession, sf_dir: str, archive, width: int) -> providers.TableSource:
    """Nations as articles, and as listings with so many on a page."""
    rows = table(spark, sf_dir, "nation")
    url = F.concat(F.lit(f"{A}ncomms"), c("n_nationkey").cast("string"))
    pages = rows.select(url.alias("url"), F.concat(F.lit("# "), "n_name").alias("markdown"), *[none().alias(n) for n in ("html", "raw_html")], F.lit(None).cast("array<string>").alias("links"), F.create_map().cast("map<string,string>").alias("metadata"))
    keys = rows.withColumn("archive_url", archive)
    at = F.row_number().over(Window.partitionBy("archive_url").orderBy("n_nationkey")) - 1  # nations are few
    listings = keys.withColumn("page_number", F.floor(at / width + 1).cast("int")).groupBy("archive_url", "page_number").agg(F.transform(F.array_sort(F.collect_list("n_nationkey")), lambda k: F.concat(F.lit(f"{A}ncomms"), k.cast("string"))).alias("urls"))
    return providers.TableSource(pages, listings=listings)


@query("SELECT CAST(n_nationkey // 20 + 1 AS INTEGER) AS page_number, CAST(count(*) AS INTEGER) AS articles_found FROM nation GROUP BY 1 UNION ALL SELECT 3, 0")
def archive_pages(spark, sf_dir):
    return _archive(spark, sf_dir).catalog.pages().select("page_number", "articles_found")


@query("SELECT CAST(2 AS INTEGER) AS page_number, CAST(count(*) AS INTEGER) AS page_discovered FROM nation WHERE n_nationkey >= 20")
def archive_underfilled(spark, sf_dir):
    return _archive(spark, sf_dir).catalog.log("underfilled", "").select("page_number", "page_discovered")


@query("SELECT (SELECT count(*) FROM nation) AS articles, 3 AS pages, 4 AS resume_page")
def archive_filled(spark, sf_dir):
    catalog = _archive(spark, sf_dir, again=True).catalog
    return spark.createDataFrame([(catalog.articles().count(), catalog.pages().filter(c("archive_url") == "x").count(), catalog.resume_page("x"))], "articles bigint, pages int, resume_page int")


@query(f"SELECT DISTINCT 'ncomms' || s_suppkey AS slug FROM supplier JOIN ({LEADERS}) l ON l.k = s_suppkey")
def sitemap_collected(spark, sf_dir):
    collector = Collector(spark, scratch(spark, "catalog"), _source(spark, sf_dir))
    loc = lambda x: F.concat(F.lit("<url><loc>"), x, F.lit("</loc></url>"))
    keys = F.transform(F.array_sort(F.collect_list("s_suppkey")), lambda k: loc(F.concat(F.lit(f"{A}ncomms"), k.cast("string"))))
    root = table(spark, sf_dir, "supplier").agg(keys.alias("x")).select(F.lit("root").alias("url"), F.concat(F.lit("<urlset>"), F.array_join("x", ""), F.lit("</urlset>")).alias("xml"))
    return collector.collect_sitemap(root, "root").select("slug")


@query("SELECT list, count(*) AS n FROM (SELECT n_nationkey // 13 AS list FROM nation) GROUP BY list")
def site_collected(spark, sf_dir):
    """Two archives, one after the other."""
    collector = Collector(spark, scratch(spark, "catalog"), _nation_source(spark, sf_dir, F.floor(c("n_nationkey") / 13).cast("string"), 13))
    got = collector.collect_site(["0", "1"], max_pages=1)
    return got.select(F.floor(F.regexp_extract("slug", r"(\d+)$", 1).cast("bigint") / 13).alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n"))


# -- parsing --------------------------------------------------------------------------------------------


class _Service:
    """A parsing service without a network: what becomes of a file is in its name's number."""

    def upload(self, contents: dict[str, bytes]) -> str:
        if not contents:
            raise ValueError("nothing to parse")
        return f"b{len(contents)}"

    def poll(self, batch: str) -> dict[str, tuple]:
        raise NotImplementedError

    def download(self, url: str) -> bytes:
        number = int(url.removeprefix("http://r/"))
        if number % 11 == 0:
            raise OSError("gone")
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            z.writestr("job_origin.pdf", f"%PDF{number}")
            z.writestr("images/i.png", b"png")
            z.writestr("../out.txt", b"no")
        return data.getvalue()


class _Known(_Service):
    """Knows the files of its batch."""

    names: list[str]
    now = 0.0

    def upload(self, contents: dict[str, bytes]) -> str:
        self.names, self.polls = list(contents), 0
        return super().upload(contents)

    def poll(self, batch: str) -> dict[str, tuple]:
        self.polls += 1
        if self.polls == 1:
            raise OSError("busy")  # and nothing is uploaded again
        found = {}
        for name in self.names:
            k = int(name.removesuffix(".pdf"))
            state = "failed" if k % 5 == 0 else "running" if k % 7 == 0 or self.polls < 3 else "done"
            found[name] = (state, f"http://r/{k}", "bad" if state == "failed" else None)
        return found

    def clock(self) -> float:
        return self.now

    def sleep(self, seconds: float) -> None:
        self.now += seconds


STATE = "CASE WHEN s_suppkey % 5 = 0 THEN 'failed' WHEN s_suppkey % 7 = 0 THEN 'running' ELSE 'done' END"
PARSED = f"SELECT s_suppkey AS k, s_suppkey || '.pdf' AS file, {STATE} AS state, CASE WHEN {STATE} = 'done' THEN 'download' ELSE 'poll' END AS phase, CASE {STATE} WHEN 'failed' THEN 'bad' WHEN 'running' THEN 'no end after 60 s' ELSE CASE WHEN s_suppkey % 11 = 0 THEN 'gone' END END AS error FROM supplier"


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    service = _Known()
    rows = table(spark, sf_dir, "supplier").select(F.concat(c("s_suppkey").cast("string"), F.lit(".pdf")).alias("file"), F.encode("s_name", "UTF-8").alias("content"))
    return tasks.parse_documents(rows, service, tasks.Settings(poll_timeout=60.0), clock=service.clock, sleep=service.sleep)


@query(f"SELECT file, state, phase, error FROM ({PARSED})")
def parse_run(spark, sf_dir):
    return _parsed(spark, sf_dir).select("file", "state", "phase", "error")


@query(f"SELECT CAST(k AS VARCHAR) AS stem, k || '_origin.pdf' AS name, sha256('%PDF' || k) AS sha FROM ({PARSED}) WHERE error IS NULL UNION ALL SELECT CAST(k AS VARCHAR), 'images/i.png', sha256('png') FROM ({PARSED}) WHERE error IS NULL")
def parse_members(spark, sf_dir):
    return tasks.result_members(_parsed(spark, sf_dir)).select("stem", "name", F.sha2("content", 256).alias("sha"))


@query(f"SELECT file, error IS NULL AS has_result, error IS NULL AS processed FROM ({PARSED})")
def parse_flags(spark, sf_dir):
    got = _parsed(spark, sf_dir)
    return tasks.has_result(got).select("file", "has_result").join(tasks.processed(got), "file")


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE error IS NULL) AS successful, count(*) FILTER (WHERE error IS NOT NULL) AS failed FROM ({PARSED})")
def parse_summary(spark, sf_dir):
    path = scratch(spark, "summary")
    files.write_one_json(tasks.run_summary(_parsed(spark, sf_dir)), path)
    return spark.read.schema("total bigint, successful bigint, failed bigint").json(path)


@query(f"SELECT file AS value FROM ({PARSED}) WHERE error IS NULL")
def success_list(spark, sf_dir):
    path = scratch(spark, "list")
    files.write_list(_parsed(spark, sf_dir).filter("error is null"), "file", path)
    return spark.read.text(path)


@query(f"SELECT file AS file_name, state, error IS NULL AS processed FROM ({PARSED})")
def task_log(spark, sf_dir):
    path, got = scratch(spark, "log"), _parsed(spark, sf_dir)
    got.join(tasks.processed(got), "file").select(c("file").alias("file_name"), "state", "processed").write.json(path)
    return files.read_task_log(spark, path).select("file_name", "state", "processed")


POLLED = "CASE event_id % 9 WHEN 0 THEN 'done' WHEN 4 THEN 'failed' ELSE 'running' END"


@query(f"""
WITH p AS (SELECT CAST(user_id AS VARCHAR) AS file, {POLLED} AS state, ts, event_id FROM events),
f AS (SELECT *, min(ts) OVER (PARTITION BY file) AS begun, max(ts) OVER () AS seen FROM p),
g AS (SELECT file, min(begun) + INTERVAL 1 DAY AS stop, min(seen) AS seen,
  arg_min(state, struct_pack(ts := ts, e := event_id)) FILTER (WHERE state <> 'running' AND ts <= begun + INTERVAL 1 DAY) AS state FROM f GROUP BY file)
SELECT file, coalesce(state, 'timeout') AS state FROM g WHERE state IS NOT NULL OR stop < seen
""")
def polls_stream(spark, sf_dir):
    """Polls of all files as a stream: ends, and timeouts after a day without one."""
    rows = table(spark, sf_dir, "events").select(c("user_id").cast("string").alias("file"), F.expr(POLLED).alias("state"), "ts", c("event_id").alias("ord"))
    source, sink = scratch(spark, "polls"), scratch(spark, "ends")
    rows.write.parquet(source)
    stream = final_states(spark.readStream.schema(rows.schema).parquet(source), timeout_s=86_400)
    stream.writeStream.format("parquet").option("checkpointLocation", scratch(spark, "state")).option("path", sink).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("file string, state string").parquet(sink)


@query("WITH a AS (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) - 1 AS place FROM supplier), b AS (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS place FROM nation) SELECT place, s_name, n_name FROM a JOIN b USING (place)")
def zipped_rows(spark, sf_dir):
    a, b = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("k"), "s_name"), table(spark, sf_dir, "nation").select(c("n_nationkey").alias("k"), "n_name")
    return tasks.zipped(a, b, "k")


# -- blocks -----------------------------------------------------------------------------------------------

PAGED = f"""{ROWS}, p AS (SELECT doc, page_idx, string_agg("index" || type, ',' ORDER BY "index") FILTER (WHERE "index" % 5 <> 4) AS shown, string_agg("index" || type, ',' ORDER BY "index") FILTER (WHERE "index" % 5 = 4) AS gone FROM f GROUP BY ALL)"""


def _paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _blocks(spark, sf_dir)
    kind = F.when(c("index") % 5 == 4, F.concat(F.lit("x"), "type")).otherwise(c("type"))  # those of a kind that isn't shown
    blocks_ = rows.select("doc", "page_idx", "index", kind.alias("type"), "text", (c("index") % 3 + 1).alias("level"))
    pages = rows.select("doc", "page_idx").distinct().select("*", F.lit(600).alias("width"), F.lit(800).alias("height"))
    return blocks.page_infos(blocks_, pages)


@query(f"{PAGED} SELECT doc, page_idx, '600x800' AS size, coalesce(shown, '') AS shown, coalesce(replace(replace(gone, 'ti', 'xti'), 'te', 'xte'), '') AS gone FROM p")
def page_infos(spark, sf_dir):
    listed = lambda x: F.array_join(F.transform(x, lambda b: F.concat(b["index"].cast("string"), b["type"])), ",")
    return _paged(spark, sf_dir).select("doc", "page_idx", F.array_join(F.transform("page_size", lambda n: n.cast("string")), "x").alias("size"), listed("para_blocks").alias("shown"), listed("discarded_blocks").alias("gone"))


@query(f"""{ROWS} SELECT doc, '{{"pdf_info":' || CAST(to_json(list(page ORDER BY page_idx)) AS VARCHAR) || ',"_backend":"vlm"}}' AS middle FROM (
  SELECT doc, page_idx, struct_pack(page_idx := page_idx, page_size := [600, 800],
    para_blocks := coalesce(list(b ORDER BY "index") FILTER (WHERE "index" % 5 <> 4), []), discarded_blocks := coalesce(list(b ORDER BY "index") FILTER (WHERE "index" % 5 = 4), [])) AS page
  FROM (SELECT doc, page_idx, "index", struct_pack("index" := "index", type := CASE WHEN "index" % 5 = 4 THEN 'x' ELSE '' END || type, text := text, level := CAST("index" % 3 + 1 AS INTEGER)) AS b FROM f) GROUP BY doc, page_idx) GROUP BY doc""")
def middle_json(spark, sf_dir):
    return blocks.middle(_paged(spark, sf_dir))


def _answers(titles: list[dict]) -> str:
    """A model's answer: unreadable for every fourth number of titles."""
    if len(titles) % 4 == 0:
        return "I can't"
    return "<think>{1: 2}</think> {" + ", ".join(f"'{t['ordinal']}': {t['ordinal'] % 3 + 1}" for t in titles) + ",}"


@query(f"""{ROWS}, t AS (SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY page_idx, "index") - 1 AS INTEGER) AS ordinal, count(*) OVER (PARTITION BY doc) AS k FROM f WHERE type = 'title')
SELECT doc, ordinal, CASE WHEN k % 4 <> 0 THEN CAST(ordinal % 3 + 1 AS INTEGER) END AS level FROM t""")
def provided_levels(spark, sf_dir):
    rows = blocks.titles(_blocks(spark, sf_dir)).withColumn("height", c("n").cast("double"))
    return blocks.with_levels(rows.select("doc", "ordinal"), blocks.provided_levels(rows, _answers))


@query(f"""{ROWS} SELECT doc, replace(string_agg(CASE WHEN type = 'title' THEN '# ' || text ELSE text END, chr(10) || chr(10) ORDER BY page_idx, "index"), 'the', 'images') AS markdown FROM f GROUP BY doc""")
def render_pipeline(spark, sf_dir):
    made = blocks.RENDERERS["pipeline"](_blocks(spark, sf_dir))
    return made.select("doc", blocks.with_image_dir(c("markdown"), "the").alias("markdown"))


# -- commands -------------------------------------------------------------------------------------------------


def _said(spark: SparkSession, *argv: str) -> DataFrame:
    """What a command prints, a line each."""
    from .. import cli

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        code = cli.main([str(a) for a in argv], spark)
    lines = out.getvalue().splitlines()
    return spark.createDataFrame([(i, x) for i, x in enumerate([*lines, f"exit {code}"])], "ord int, line string").select("line")


def _as_json(rows: DataFrame, name: str) -> str:
    path = scratch(rows.sparkSession, name)
    rows.write.json(path)
    return path


@query(f"SELECT '{A}ncomms' || n_nationkey AS line FROM nation WHERE n_nationkey < 5 UNION ALL SELECT 'exit 0'")
def cli_discover(spark, sf_dir):
    searches = table(spark, sf_dir, "nation").select(F.lit("q").alias("query"), c("n_nationkey").alias("ord"), F.concat(F.lit(f"{A}ncomms"), c("n_nationkey").cast("string")).alias("url"))
    return _said(spark, "discover", "--searches", _as_json(searches, "searches"), "--query", "q", "--limit", 5)


def _listings(spark: SparkSession, sf_dir: str) -> str:
    rows = table(spark, sf_dir, "nation").groupBy((c("n_regionkey") % 2).cast("string").alias("archive_url"), F.floor(c("n_nationkey") / 10 + 1).cast("int").alias("page_number"))
    return _as_json(rows.agg(F.array_sort(F.collect_list("n_name")).alias("urls")), "listings")


@query("SELECT n_name AS line FROM nation WHERE n_regionkey % 2 = 0 UNION ALL SELECT 'exit 0'")
def cli_archive(spark, sf_dir):
    return _said(spark, "discover-archive", "--listings", _listings(spark, sf_dir), "--archive-url", "0", "--all-pages")


@query("SELECT n_name AS line FROM nation WHERE n_nationkey < 20 UNION ALL SELECT 'exit 0'")
def cli_site(spark, sf_dir):
    return _said(spark, "discover-site", "--listings", _listings(spark, sf_dir), "--archive-url", "0", "--archive-url", "1", "--pages", 2)


@query(f"SELECT '{A}ncomms' || s_suppkey AS line FROM supplier UNION ALL SELECT 'exit 0'")
def cli_sitemap(spark, sf_dir):
    documents = _as_json(_sitemap(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey", 10**9), "sitemaps")
    return _said(spark, "discover-sitemap", "--documents", documents, "--sitemap-url", "root")


@query(f"SELECT unnest(['total_articles: ' || count(*), 'cached_urls: 25', 'success_urls: 25', 'failed_urls: 0', 'exit 0']) AS line FROM nation")
def cli_collect(spark, sf_dir):
    url = F.concat(F.lit(f"{A}ncomms"), c("n_nationkey").cast("string"))
    pages = table(spark, sf_dir, "nation").select(url.alias("url"), F.concat(F.lit("# "), "n_name").alias("markdown"))
    listing = _text_lines(spark, pages.select(c("url").alias("value")), ["value"])
    folder = scratch(spark, "collected")
    _said(spark, "collect", "--scrapes", _as_json(pages, "scrapes"), "--input", listing, "--output-dir", folder)
    return _said(spark, "stats", "--output-dir", folder).filter("not line like 'last_%'")


@query(f"SELECT CAST(count(*) FILTER (WHERE error IS NULL) AS VARCHAR) AS successful, CAST(count(*) FILTER (WHERE error IS NOT NULL) AS VARCHAR) AS failed FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'bad' WHEN s_suppkey % 11 = 0 THEN 'gone' END AS error FROM supplier)")
def cli_parse(spark, sf_dir):
    folder = f"{scratch(spark, 'pdfs')}"
    rows = table(spark, sf_dir, "supplier").select(F.concat(c("s_suppkey").cast("string"), F.lit(".pdf")).alias("name"), "s_name")
    files.write_blobs(rows, folder, "name", "s_name")
    said = _said(spark, "parse", "--all", "--data-dir", folder, "--output-dir", scratch(spark, "parsed"), "--service", "marlstone.plans.round_trips:fast_service", "--retry-gap", 0, "--save-summary")
    found = said.filter("line like '{%'").select(F.from_json("line", "successful string, failed string").alias("s"))
    return found.select("s.successful", "s.failed")


class _Fast(_Known):
    """As ``_Known``, and at an end at the first poll."""

    def poll(self, batch: str) -> dict[str, tuple]:
        return {n: ("failed", None, "bad") if int(n.removesuffix(".pdf")) % 5 == 0 else ("done", f"http://r/{n.removesuffix('.pdf')}", None) for n in self.names}


def fast_service(settings: tasks.Settings) -> _Fast:
    return _Fast()


@query("SELECT CAST(s_suppkey AS VARCHAR) AS doi, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS citations FROM supplier")
def cli_papers(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier")
    dois = _text_lines(spark, rows.select("s_suppkey", c("s_suppkey").cast("string").alias("value")), ["s_suppkey"])
    works = _as_json(rows.filter("s_suppkey % 2 = 0").select(c("s_suppkey").cast("string").alias("doi"), c("s_nationkey").alias("citations")), "works")
    said = _said(spark, "papers", "--doi-list", dois, "--works", works, "--output-dir", scratch(spark, "papers"))
    return said.filter("line like '{%'").select(F.from_json("line", "doi string, citations int").alias("r")).select("r.*")


@query(f"""{ROWS}, picked AS (SELECT doc FROM (SELECT DISTINCT doc FROM f) ORDER BY CAST(doc AS VARCHAR) LIMIT 5 OFFSET 2)
SELECT doc || '.md' AS name, sha256(string_agg(CASE WHEN type = 'title' THEN '## ' || text ELSE text END, chr(10) || chr(10) ORDER BY page_idx, "index")) AS sha FROM f WHERE doc IN (SELECT doc FROM picked) GROUP BY doc""")
def cli_render(spark, sf_dir):
    rows = _blocks(spark, sf_dir).select(c("doc").cast("string").alias("doc"), "page_idx", "index", "type", "text", F.lit(2).alias("level"))
    folder = scratch(spark, "rendered")
    for _ in range(2):  # the second time every file is there
        _said(spark, "render", "--blocks", _as_json(rows, "blocks"), "--start", 2, "--end", 7, "--output-dir", folder)
    found = spark.read.format("binaryFile").load(folder)
    return found.select(ids.base_name(c("path")).alias("name"), F.sha2("content", 256).alias("sha"))
