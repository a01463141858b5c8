"""Listings through engines: pages as a stream, resumed, and collected."""

import json
import os
import random
import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from marlstone import cli
from marlstone.functions import extract
from marlstone.plans.collect import Catalog, Collector, listed
from marlstone.profile import DEFAULT
from marlstone.sources import clients, listing, providers

A = DEFAULT.article_prefix
SITE = f"{DEFAULT.host}/ncomms/research-articles"


def none(*names):
    return [F.lit(None).cast("string").alias(n) for n in names]


class Web:
    """Pages of a listing with ``width`` articles each, and the articles; requests are noted in a
    file, as they come from other processes."""

    def __init__(self, folder, n, width=20, fails=()):
        self.folder, self.n, self.width, self.fails = str(folder), n, width, fails
        os.makedirs(self.folder, exist_ok=True)

    def asked(self):
        path = f"{self.folder}/asked"
        return [x.rstrip("\n") for x in open(path)] if os.path.exists(path) else []

    def get(self, url, headers):
        with open(f"{self.folder}/asked", "a") as f:
            f.write(url + "\n")
        if url.startswith(A):
            return 200, f"<title>T{url.rsplit('ncomms', 1)[1]}</title>".encode()
        page = int((re.search(r"[?&]page=(\d+)", url) or [0, 1])[1])
        if page in self.fails and not os.path.exists(f"{self.folder}/mended"):
            return 500, b""
        own = range((page - 1) * self.width, min(page * self.width, self.n))
        return (200, "".join(f'<a href="/articles/ncomms{k}?x=1">a</a><a href="/other">b</a>' for k in own).encode()) if own else (404, b"")

    def call(self, method, arguments):
        status, body = self.get(arguments["url"], {})
        with open(f"{self.folder}/waits", "a") as f:
            f.write(str(arguments["actions"][0]["milliseconds"]) + "\n")
        return {"links": re.findall('href="([^"]+)"', body.decode()), "markdown": ""}


def get(url, headers):
    """A transport for the command line, told its folder by the environment."""
    return Web(os.environ["MARLSTONE_TEST_WEB"], 45).get(url, headers)


def test_addresses_of_a_scrape_equal_the_expression(spark):
    rng = random.Random(1)
    parts = [f"{A}ncomms1", f"{A}ncomms2?x#y", f"{A}s41467-024-12345-6/", "/articles/ncomms3", "../articles/ncomms4;", "HTTPS://www.nature.com/articles/ncomms5", f"{A}ncomms6/figures/1", "http://other", "#x", "?page=2", " /articles/ncomms7 ", "ncomms8", "[b](http://[", ""]
    rows = []
    for i in range(80):
        pick = lambda k: [rng.choice(parts) for _ in range(rng.randrange(k))]
        markdown = " ".join(f"[l]({p.strip()})" if rng.random() < 0.5 else p for p in pick(4))
        rows.append((i, [*pick(4), None], markdown, " ".join(f'<a href="{p}">' for p in pick(4)), rng.choice([None, f"({A}ncomms9)"])))
    base = f"{SITE}?type=article&page=2"
    df = spark.createDataFrame(rows, "id int, links array<string>, markdown string, html string, raw_html string")
    made = df.select("id", extract.listing_urls(F.col("links"), F.col("markdown"), F.col("html"), F.col("raw_html"), F.lit(base)).alias("urls")).collect()
    for r, (_, links, markdown, html, raw) in zip(sorted(made), rows, strict=True):
        assert listing.article_addresses({"links": links, "markdown": markdown, "html": html, "raw_html": raw}, base) == r["urls"]
    assert listing.article_addresses({"html": '<a href="/articles/ncomms3/">x</a>'}, base) == [f"{A}ncomms3"] and listing.article_addresses({}, base) == []


def test_page_addresses(spark):
    first, later = listing.page_addresses(spark, f"{SITE}?type=article#top")
    assert first == f"{SITE}?type=article" and later.format(7) == f"{SITE}?type=article&page=7&searchType=journalSearch&sort=PubDate"


def pages_of(df):
    return {r["page_number"]: (len(r["urls"]), r["retries"]) for r in df.collect()}


@pytest.mark.parametrize("last", [None, 2])
def test_pages_of_both_engines(spark, tmp_path, last):
    for engine in ("native", "service"):
        web = Web(tmp_path / engine, 45)
        got = listed(spark, SITE, clients.client(engine, web.get if engine == "native" else web.call), last=last)
        want = {1: (20, 0), 2: (20, 0), 3: (5, 0), 4: (0, 0)}
        assert {k: v[0] for k, v in pages_of(got).items()} == {k: v[0] for k, v in want.items() if last is None or k <= last}
        asked = [SITE, f"{SITE}?page=2", f"{SITE}?page=3", f"{SITE}?page=3", f"{SITE}?page=4"]
        assert web.asked() == (asked if last is None else asked[:2])  # the underfilled page once more, and nothing after the end
    waits = (tmp_path / "service" / "waits").read_text().split()
    assert waits == (["2000", "2000", "2000", "3500", "2000"] if last is None else ["2000"] * 2)  # the retry waits longer


def test_a_killed_stream_resumes(spark, tmp_path):
    web, seen = Web(tmp_path / "web", 150), []
    client = clients.client("native", web.get)

    def run(broken):
        def each(batch, number):
            rows = sorted((r["page_number"], len(r["urls"])) for r in batch.collect())
            if broken and number == 1:
                raise RuntimeError("killed")
            seen.extend(rows)

        query = listing.stream(spark, client, SITE, ahead=4).writeStream.foreachBatch(each).option("checkpointLocation", f"{tmp_path}/checkpoint").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(StreamingQueryException):
        run(True)
    assert seen == [(n, 20) for n in (1, 2, 3, 4)]
    run(False)
    assert seen == [(n, 20) for n in range(1, 8)] + [(8, 10), (9, 0)]
    numbers = [int((re.search(r"page=(\d+)", u) or [0, 1])[1]) for u in web.asked()]
    assert all(numbers.count(n) == 1 for n in (1, 2, 3, 4))  # what was done isn't asked for again
    before = len(web.asked())
    run(False)  # the listing has ended
    assert len(seen) == 9 and len(web.asked()) == before


def test_collecting_through_an_engine(spark, tmp_path):
    web, events = Web(tmp_path / "web", 185, fails=(10,)), []
    collector = Collector(spark, f"{tmp_path}/out", clients.client("native", web.get), on_progress=events.append, partitions=2)
    with pytest.raises(StreamingQueryException):
        collector.collect_archive(SITE, max_pages=None)
    assert collector.catalog.resume_page(SITE) == 9 and collector.stats()["total_articles"] == 160  # the second batch of pages died
    (tmp_path / "web" / "mended").write_text("")
    assert collector.collect_archive(SITE, max_pages=None).count() == 25
    assert [(e["page_number"], e["page_new"], e["retry_count"], e["underfilled"]) for e in events] == [(n, 20, 0, False) for n in range(1, 10)] + [(10, 5, 1, True), (11, 0, 0, False)]
    assert collector.stats()["total_articles"] == 185 and collector.catalog.resume_page(SITE) == 12
    articles = [u for u in web.asked() if u.startswith(A) and not u.endswith(".pdf")]
    assert len(articles) == len(set(articles)) == 185
    assert [(r["page_number"], r["page_discovered"]) for r in collector.catalog.log("underfilled").collect()] == [(10, 5)]


def test_repeated_addresses_are_new_once(spark, tmp_path):
    pages = {SITE: [1, 2], f"{SITE}?page=2": [2, 3], f"{SITE}?page=3": [3]}
    client = clients.client("service", lambda method, a: {"markdown": "# x", "links": [f"{A}ncomms{k}" for k in pages.get(a["url"], [])]})
    events = []
    Collector(spark, f"{tmp_path}/out", client, on_progress=events.append).collect_archive(SITE, max_pages=None)
    assert [(e["page_discovered"], e["page_new"], e["cumulative_discovered"]) for e in events] == [(2, 2, 2), (2, 1, 3), (1, 0, 3), (0, 0, 3)]


def test_table_listings_end_at_holes(spark):
    rows = [("x", 1, ["a", "b", "a"]), ("x", 2, ["b", "c"]), ("x", 4, ["d"]), ("y", 1, []), ("x", 3, None)]
    source = providers.TableSource(None, listings=spark.createDataFrame(rows, "archive_url string, page_number int, urls array<string>"))
    got = lambda *a: sorted((r["page_number"], r["urls"], r["new_urls"]) for r in listed(spark, *a).collect())
    assert got("x", source) == [(1, ["a", "b"], ["a", "b"]), (2, ["b", "c"], ["c"]), (3, [], [])]
    assert got("x", source, 1, 2) == got("x", source)[:2] and got("y", source) == got("z", source) == [(1, [], [])]


def test_commands_ask_the_transport(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setenv("MARLSTONE_TEST_WEB", str(tmp_path / "web"))
    spark.conf.set("spark.executorEnv.MARLSTONE_TEST_WEB", str(tmp_path / "web"))
    out, transport = str(tmp_path / "out"), ("--engine", "native", "--transport", "tests.test_listing:get")
    web = Web(tmp_path / "web", 45)
    monkeypatch.setattr("tests.test_listing.get", web.get)  # pickled with its folder, as executors have another environment
    assert cli.main(["collect", "--output-dir", out, *transport, "--archive", "--archive-url", SITE, "--all-pages", "--requests-per-second", "1000"], spark) == 0
    assert "total_articles: 45" in capsys.readouterr().out and f"{SITE}?page=3" in web.asked()
    assert Catalog(spark, out).resume_page(SITE) == 5
    assert cli.main(["discover-archive", *transport, "--archive-url", SITE, "--pages", "1"], spark) == 0
    assert capsys.readouterr().out.splitlines() == [f"{A}ncomms{k}" for k in range(20)]
    for argv in (["collect", "--output-dir", out, "--archive"], ["discover-archive", "--archive-url", SITE], ["discover-site", *transport, "--listings", "x"]):
        with pytest.raises(SystemExit):
            cli.main(argv, spark)
    assert json.loads(json.dumps(Catalog(spark, out).stats()))["total_articles"] == 45
