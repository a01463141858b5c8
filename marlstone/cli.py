"""Command line.  Without ``--transport`` pages come from tables: a file of scrapes in JSON lines
(url, markdown, html, links, metadata), listings (archive_url, page_number, urls), searches
(query, ord, url) and a folder of PDFs by file name; so no network is needed.  With one,
articles, PDFs and listings are asked of the engine.  A transport or a parsing service is named
as ``module:function``."""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.ids import stem
from .functions.urls import listing_url_with_year
from .operators import bibliography, blocks, tasks
from .operators.frontier import union_sources
from .operators.numbering import numbered
from .plans.collect import Catalog, Collector, crawl_sitemap, discover_archive, discover_site, discover_sitemap
from .profile import DEFAULT
from .sources import clients, files, providers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("marlstone", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def add(name: str, *flags) -> None:
        made = sub.add_parser(name)
        for names, how in flags:
            made.add_argument(*names, **how)

    flag = lambda *f, **k: (f, k)
    switch = lambda *f: flag(*f, action="store_true")
    out, listings = flag("--output-dir", default="output"), flag("--listings")
    engine = (flag("--engine", choices=[*clients.ENGINES, "table"], default="table"), flag("--transport"), flag("--scrapes"), flag("--searches"), flag("--pdfs"))
    pages = lambda n: (flag("--pages", type=int, default=n), switch("--all-pages"))
    add("discover", *engine, flag("--query", required=True), flag("--limit", type=int, default=20))
    add("discover-archive", *engine, listings, flag("--archive-url", default=DEFAULT.archive), flag("--year", type=int), *pages(5))
    add("discover-site", *engine, listings, flag("--archive-url", action="append"), *pages(20))
    add("discover-sitemap", *engine, flag("--documents"), flag("--sitemap-url", required=True))
    add("stats", out, switch("--json"), switch("--list-failed"))
    sources = (flag("--url", action="append", default=[]), flag("--input"), flag("--query"), flag("--limit", type=int, default=20), switch("--archive"), switch("--site"), flag("--archive-url", action="append"), flag("--sitemap-url"), flag("--documents"), flag("--year", type=int))
    how = (switch("--skip-peer-reviews"), switch("--force"), switch("--skip-failed-cache"), switch("--fill-gaps"), flag("--json-output"), switch("--print-records"), flag("--max-workers", type=int, default=4), flag("--requests-per-second", type=float, default=1.0))
    add("collect", out, *engine, listings, *sources, *pages(1), *how)
    add("parse", out, flag("pdf_files", nargs="*"), switch("--all"), flag("--data-dir", default="."), flag("--recursive", action=argparse.BooleanOptionalAction, default=True), flag("--service"), flag("--task-log"), flag("--max-retries", type=int, default=3), switch("--fail-on-error"), flag("--model-version", default="vlm"), flag("--language", default="en"), switch("--no-ocr"), flag("--poll-timeout", type=float, default=300.0), flag("--retry-gap", type=float, default=1.0), switch("--verbose"), switch("--save-summary"))
    add("papers", out, flag("--dois", nargs="*", default=[]), flag("--doi-list"), flag("--works"), flag("--lookup"), flag("--max-retries", type=int, default=3), flag("--retry-gap", type=float, default=0.2), flag("--pdf-dir"), switch("--metadata"))
    add("render", out, flag("--blocks", required=True), flag("--start", type=int, default=0), flag("--end", type=int), flag("--mode", choices=[*blocks.RENDERERS], default="vlm"))
    return top


def named(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def make_client(spark: SparkSession, args):
    if args.engine != "table":
        if not args.transport:
            raise SystemExit(f"--engine {args.engine} needs a --transport")
        if getattr(args, "listings", None):
            raise SystemExit(f"--listings is a table of pages; --engine {args.engine} reads listings itself")
        return clients.client(args.engine, named(args.transport))
    scrapes = spark.read.schema(providers.SCRAPE).json(args.scrapes) if args.scrapes else spark.createDataFrame([], providers.SCRAPE)
    searches = spark.read.schema("query string, ord bigint, url string").json(args.searches) if args.searches else None
    contents = None
    if args.pdfs:  # by the last part of an address
        contents = files.pdf_files(spark, args.pdfs, content=True).select(F.col("name").alias("url"), "content")
    path = getattr(args, "listings", None)
    listings = spark.read.schema("archive_url string, page_number int, urls array<string>").json(path) if path else None
    return FolderSource(scrapes, searches, contents, listings)


def sitemap_documents(spark: SparkSession, args) -> DataFrame | None:
    """Documents from a file; without one the engine is asked for them."""
    if args.documents:
        return spark.read.schema("url string, xml string").json(args.documents)
    if args.engine == "table":
        raise SystemExit("--engine table reads sitemaps from --documents")
    return None


def listing_source(client):
    """The client, if it can read listings."""
    if client.engine == "table" and client.listings is None:
        raise SystemExit("--engine table reads listings from --listings")
    return client


class FolderSource(providers.TableSource):
    def downloaded(self, urls: DataFrame) -> DataFrame:
        last = urls.select("url", F.element_at(F.split("url", "/"), -1).alias("name"))
        got = super().downloaded(last.select(F.col("name").alias("url")).distinct()).withColumnRenamed("url", "name")
        return last.join(got, "name").select("url", "content", "error")


def parse(args, spark: SparkSession) -> int:
    """Checks the files, parses them, writes results, summary and task log."""
    if not args.pdf_files and not args.all:
        print("name PDFs, or --all", file=sys.stderr)
        return 1
    found = files.pdf_files(spark, args.data_dir, args.recursive, content=True)
    if args.pdf_files:
        wanted = [f.rsplit("/", 1)[-1] for f in args.pdf_files]
        there = {r["name"] for r in found.filter(found["name"].isin(wanted)).select("name").collect()}
        for name in sorted(set(wanted) - there):
            print(f"missing: {name}", file=sys.stderr)
        if args.fail_on_error and set(wanted) - there:
            return 1
        found = found.filter(found["name"].isin(wanted))
    chosen = files.unique_names(found)
    if not chosen.head(1):
        return 1
    if args.verbose or not args.service:
        for r in chosen.select("path").orderBy("path").toLocalIterator():
            print(r["path"])
    if not args.service:
        return 0
    settings = tasks.Settings(tries=args.max_retries, poll_timeout=args.poll_timeout, download_gap=args.retry_gap, model_version=args.model_version, language=args.language, ocr=not args.no_ocr)
    known = None
    if args.task_log:
        known = files.read_task_log(spark, args.task_log).filter("state = 'done'").select(F.col("file_name").alias("file"), "batch_id", F.col("result_path").alias("url"))
    got = tasks.parse_documents(chosen.select(F.col("name").alias("file"), "content"), named(args.service)(settings), settings, known)
    members = tasks.result_members(got)
    own = members.select(F.concat_ws("/", "stem", "name").alias("name"), "content")  # a folder for each file
    files.write_blobs(own, args.output_dir, "name", "content", nested=True)
    errors = [r.asDict() for r in tasks.run_errors(got).orderBy("file").collect()]  # of the files that were named
    summary = tasks.run_summary(got).first().asDict() | {"errors": errors, "output_dir": args.output_dir}
    log = got.join(tasks.processed(got), "file").select("batch_id", F.col("file").alias("file_name"), "state", "phase", "error", "processed")
    log.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{args.output_dir}/task_log")
    if args.save_summary:
        files.write_one_json(tasks.run_summary(got), f"{args.output_dir}/summary")
    print(json.dumps(summary))
    return 1 if errors and (args.fail_on_error or not summary["successful"]) else 0


def papers(args, spark: SparkSession) -> int:
    """DOIs with their works, from a file (doi, title, journal, citations) or asked of a
    function ``module:function`` of a DOI and the retry's number; and what PDFs say of themselves."""
    if args.metadata:
        info = files.pdf_files(spark, args.pdf_dir or ".").select("path", files.pdf_info_at(F.col("path")).alias("info"))
        for r in info.orderBy("path").toLocalIterator():
            print(json.dumps({"path": r["path"], "title": (r["info"] or {}).get("Title"), "info": r["info"]}))
        return 0
    given = [spark.createDataFrame([(i, d) for i, d in enumerate(args.dois)], "ord bigint, doi string")]
    if args.doi_list:
        given.append(files.doi_list(spark, args.doi_list).select("ord", "doi"))
    dois = union_sources(*[g.select(F.col("doi").alias("url"), "ord") for g in given]).filter("url <> ''").select(F.col("url").alias("doi"), "place")
    if args.works:
        works = spark.read.schema("doi string, title string, journal array<string>, citations bigint").json(args.works)
        dois = dois.join(works, "doi", "left")
    elif args.lookup:
        works, dead = bibliography.looked_up(dois, named(args.lookup), args.max_retries, args.retry_gap)
        told = works.select("doi", F.get("work.title", F.lit(0)).alias("title"), F.col("work.container_title").alias("journal"), F.col("work.is_referenced_by_count").alias("citations"), F.lit(None).cast("string").alias("error"))
        none = [F.lit(None).cast(told.schema[k].dataType).alias(k) for k in ("title", "journal", "citations")]
        dois = dois.join(told.unionByName(dead.select("doi", *none, "error")), "doi", "left")
    for r in dois.orderBy("place").drop("place").toLocalIterator():
        print(json.dumps(r.asDict()))
    files.write_list(dois, "doi", f"{args.output_dir}/dois")
    return 0


def render(args, spark: SparkSession) -> int:
    """Sessions ``start`` to ``end`` of blocks in JSON lines (doc, page_idx, index, type,
    text, level) as markdown files; one that is there is left alone."""
    rows = spark.read.schema("doc string, page_idx int, index int, type string, text string, level int").json(args.blocks)
    docs = files.sliced(rows.select("doc").distinct(), "doc", args.start, args.end)
    made = blocks.RENDERERS[args.mode](rows.join(docs, "doc", "left_semi"))
    made = made.select(F.concat(stem(F.col("doc")), F.lit(".md")).alias("name"), blocks.with_image_dir(F.col("markdown"), f"{args.output_dir}/images").alias("markdown"))
    written = files.write_blobs(made, args.output_dir, "name", "markdown", replace=False)
    for r in written.orderBy("name").toLocalIterator():
        print(r["path"] or f"{r['name']}: {r['error']}")
    return 1 if written.filter("error is not null").head(1) else 0


def collect(args, spark: SparkSession, most: int | None) -> int:
    collector = Collector(spark, args.output_dir, make_client(spark, args), on_progress=lambda e: print(json.dumps(e), file=sys.stderr), partitions=args.max_workers, per_second=args.requests_per_second)
    how = {"resume": not args.force, "retry_failed": not args.skip_failed_cache, "peer_reviews": not args.skip_peer_reviews}
    archives = args.archive_url or [DEFAULT.archive]
    if args.fill_gaps or args.archive or args.site:
        listing_source(collector.client)
    if args.year is not None:
        archives = [spark.range(1).select(listing_url_with_year(F.lit(a), F.lit(args.year))).first()[0] for a in archives]
    if args.fill_gaps:
        got = collector.fill_gaps_archive(archives[0], max_pages=most)
    elif args.archive:
        got = collector.collect_archive(archives[0], max_pages=most, **how)
    elif args.site:
        got = collector.collect_site(archives, max_pages=most, **how)
    elif args.sitemap_url:
        got = collector.collect_sitemap(sitemap_documents(spark, args), args.sitemap_url, **how)
    else:
        lists = [files.urls_from_list(spark, args.url)] + ([files.urls_from_file(spark, args.input)] if args.input else []) + ([collector.discover(args.query, args.limit)] if args.query else [])
        got = collector.collect_urls(numbered(union_sources(*lists), ["place"]).select("url", "ord"), **how)
    if args.json_output:
        got.drop("metadata").write.mode("overwrite").option("ignoreNullFields", "false").json(args.json_output)
    if args.print_records:
        for text in got.drop("metadata").toJSON().toLocalIterator():
            print(text)
    print("\n".join(f"{k}: {v}" for k, v in collector.stats().items()))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("marlstone").getOrCreate()
    most = None if getattr(args, "all_pages", False) else getattr(args, "pages", None)
    if args.command in ("parse", "papers", "render"):
        return {"parse": parse, "papers": papers, "render": render}[args.command](args, spark)
    if args.command == "collect":
        return collect(args, spark, most)
    if args.command == "stats":
        catalog = Catalog(spark, args.output_dir)
        stats = catalog.stats()
        print(json.dumps(stats) if args.json else "\n".join(f"{k}: {v}" for k, v in stats.items()))
        if args.list_failed:
            for r in catalog.failed().toLocalIterator():
                print(r["url"], r["error_message"], sep="\t")
        return 0
    if args.command == "discover":
        urls = providers.searched(spark, make_client(spark, args), args.query, args.limit)
    elif args.command == "discover-sitemap":
        documents = sitemap_documents(spark, args)
        urls = discover_sitemap(documents, args.sitemap_url) if documents is not None else crawl_sitemap(spark, make_client(spark, args), args.sitemap_url)
    elif args.command == "discover-site":
        urls = discover_site(spark, args.archive_url or [DEFAULT.archive], listing_source(make_client(spark, args)), most)
        urls = numbered(urls, ["place"])
    else:
        urls = discover_archive(spark, args.archive_url, listing_source(make_client(spark, args)), most, args.year)
    for r in urls.orderBy("ord").toLocalIterator():
        print(r["url"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
