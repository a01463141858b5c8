"""Sitemaps as files, tables over pages, works looked up in rounds, and the rate of all tasks."""

import gzip

import pytest
from pyspark.sql import functions as F

from marlstone import cli
from marlstone.operators import bibliography, tables
from marlstone.plans.collect import crawl_sitemap
from marlstone.sources import clients, providers, sitemaps

A = "https://www.nature.com/articles/"
NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'


def test_sitemap_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text(f"<?xml version='1.0'?><urlset {NS}>" + "".join(f"<url><loc> {A}ncomms{i}?a=1&amp;b </loc><priority>1</priority></url>" for i in range(5000)) + "</urlset>")
    (tmp_path / "b.xml.gz").write_bytes(gzip.compress(f"<sitemapindex {NS}><sitemap><loc>x</loc></sitemap><sitemap><lastmod>1</lastmod></sitemap></sitemapindex>".encode()))
    (tmp_path / "c.xml").write_text("<urlset><url><loc>one</loc></url><url><loc>broken</lo></url><url><loc>two</loc></url></urlset>")
    (tmp_path / "d.xml").write_text("<html>no sitemap</html>")
    rows = [(r["file"].rsplit("/", 1)[1], r["kind"], r["dst"], r["broken"]) for r in sitemaps.entries(spark, str(tmp_path)).orderBy("file", "at").collect()]
    assert [r[2] for r in rows if r[0] == "a.xml"] == [f"{A}ncomms{i}?a=1&b" for i in range(5000)]
    assert [r[1:3] for r in rows if r[0] == "b.xml.gz"] == [("index", "x"), ("index", None)]
    own = [r for r in rows if r[0] == "c.xml"]
    assert "one" in [r[2] for r in own] and any(r[2] is None and "broken" in (r[3] or "") for r in own)
    assert not [r for r in rows if r[0] == "d.xml"]


class Maps:
    """Sitemaps by address: the root names one twice, itself, and one that isn't there."""

    def __init__(self, folder):
        self.folder = str(folder)

    def get(self, url, headers):
        with open(f"{self.folder}/asked", "a") as f:
            f.write(url + "\n")
        loc = lambda tag, *xs: "".join(f"<{tag}><loc>{x}</loc></{tag}>" for x in xs)
        pages = {
            "http://s/root": f"<sitemapindex {NS}>{loc('sitemap', 'http://s/1', 'http://s/1', 'http://s/root', 'http://s/gone', 'http://s/2')}</sitemapindex>",
            "http://s/1": f"<urlset {NS}>{loc('url', A + 'ncomms2', A + 'ncomms1', 'http://other')}</urlset>",
            "http://s/2": f"<sitemapindex {NS}>{loc('sitemap', 'http://s/3')}</sitemapindex>",
            "http://s/3": f"<urlset {NS}>{loc('url', A + 'ncomms1/', A + 'ncomms3')}</urlset>",
        }
        body = pages.get(url)
        return (404, b"") if body is None else (200, gzip.compress(body.encode()) if url.endswith("1") else body.encode())


def test_sitemaps_through_an_engine(spark, tmp_path, capsys, monkeypatch):
    maps, events = Maps(tmp_path), []
    client = clients.client("native", maps.get)
    got = crawl_sitemap(spark, client, "http://s/root", on_progress=events.append).orderBy("ord").collect()
    assert [r["url"] for r in got] == [f"{A}ncomms{k}" for k in (2, 1, 3)] and [r["ord"] for r in got] == [0, 1, 2]
    assert [e["sitemap"] for e in events] == ["http://s/gone"]
    assert sorted((tmp_path / "asked").read_text().split()) == ["http://s/1", "http://s/2", "http://s/3", "http://s/gone", "http://s/root"]  # each once
    assert crawl_sitemap(spark, client, "http://s/gone").count() == 0
    monkeypatch.setattr("tests.test_more.transport", maps.get, raising=False)
    assert cli.main(["discover-sitemap", "--engine", "native", "--transport", "tests.test_more:transport", "--sitemap-url", "http://s/1"], spark) == 0
    assert capsys.readouterr().out.split() == [f"{A}ncomms2", f"{A}ncomms1"]
    with pytest.raises(SystemExit):
        cli.main(["discover-sitemap", "--sitemap-url", "http://s/1"], spark)


def test_table_grids():
    head = "<tr><th rowspan=2>a</th><th colspan=2>b</th></tr><tr><th>c</th><th>d</th></tr>"
    first, more = tables.Table(f"<p>t</p><table><thead>{head}</thead><tr><td>1</td><td>2 &lt; 3</td><td><b>x</b></td></tr></table>"), tables.Table(f"<TABLE>{head}<TR><TD colspan=3>4<table><tr><td>in</td></tr></table></TD></TR></TABLE>")
    assert first.width == more.width == 3 and first.headed == 2 and more.header_of(first) == 2
    first.add(more)
    assert first.html() == '<table><tr><th rowspan="2">a</th><th colspan="2">b</th></tr><tr><th>c</th><th>d</th></tr><tr><td>1</td><td>2 &lt; 3</td><td><b>x</b></td></tr><tr><td colspan="3">4<table><tr><td>in</td></tr></table></td></tr></table>'
    deep = tables.Table("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>")
    assert deep.width == 2 and tables.Table("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>d</td></tr></table>").header_of(deep) == 0  # the first row isn't one by itself
    assert tables.Table(None).width == tables.Table("no table").width == tables.Table("<table></table>").width == 0


def test_tables_over_pages(spark):
    one = lambda *cells: "<table><tr><td>h1</td><td>h2</td></tr>" + "".join(f"<tr><td>{x}</td><td>y</td></tr>" for x in cells) + "</table>"
    rows = [
        ("a", 0, 0, "text", "t"), ("a", 0, 1, "table", one(1)), ("a", 1, 0, "table", one(2)), ("a", 2, 0, "table", one(3)), ("a", 2, 1, "text", "u"), ("a", 2, 2, "table", one(4)), ("a", 2, 9, "footer", "page 3"), ("a", 3, 0, "table", one(5)),
        ("b", 0, 0, "table", one(1)), ("b", 2, 0, "table", one(2)), ("b", 3, 0, "table", "<table><tr><td>only</td></tr></table>"), ("b", 4, 0, "table", "plain"), ("b", 5, 0, "table", None),
    ]
    df = spark.createDataFrame(rows, "doc string, page_idx int, index int, type string, text string").withColumn("first", F.lit("clash")).repartition(3)
    made = tables.joined_tables(df)
    assert made.columns == df.columns
    got = sorted((r[0], r[1], r[2], r[4]) for r in made.collect() if r["type"] == "table" and r[4])
    assert got == [("a", 0, 1, one(1, 2, 3)), ("a", 2, 2, one(4, 5)), ("b", 0, 0, one(1)), ("b", 2, 0, one(2)), ("b", 3, 0, "<table><tr><td>only</td></tr></table>"), ("b", 4, 0, "plain")]
    assert made.count() == len(rows) - 3 and tables.joined_tables(df.limit(0)).count() == 0


def test_works_in_rounds(spark, tmp_path):
    log, waits = f"{tmp_path}/asked", []

    def lookup(doi, retry):
        with open(log, "a") as f:
            f.write(f"{doi}{retry} ")
        if doi == "gone":
            return None
        if doi == "late" and retry < 2:
            raise OSError("busy")
        if doi == "never":
            raise OSError("down")
        return {"title": [doi], "is-referenced-by-count": 3, "reference": [{"DOI": "r"}], "other": {}}

    dois = spark.createDataFrame([("now",), ("late",), ("gone",), ("never",), ("now",), (None,)], "doi string")
    works, dead = bibliography.looked_up(dois, lookup, gap=0.5, sleep=waits.append)
    assert sorted((r["doi"], r["tries"], r["work"]["title"], r["work"]["is_referenced_by_count"], r["work"]["reference"][0]["doi"]) for r in works.collect()) == [("late", 3, ["late"], 3, "r"), ("now", 1, ["now"], 3, "r")]
    assert sorted(map(tuple, dead.collect())) == [("gone", "no such work", 3), ("never", "down", 3)]
    assert waits == [0.5, 0.5] and sorted(open(log).read().split()) == sorted(["now0", *[f"{d}{k}" for d in ("late", "gone", "never") for k in range(3)]])
    waits.clear()
    assert bibliography.looked_up(dois.filter("doi = 'now'"), lookup, sleep=waits.append)[1].count() == 0 and not waits
    assert bibliography.looked_up(dois.limit(0), lookup)[0].count() == 0


def test_slots_keep_the_rate_of_all_tasks():
    """Four tasks, one of them late, one run twice: no two requests come closer than the rate."""
    times = []
    for task, start, n in ((0, 100.0, 20), (1, 107.3, 20), (2, 100.0, 9), (2, 140.04, 11), (3, 100.0, 20)):
        now = [start]
        slots = providers.Slots(2.0, task, 4, began=100.0, clock=lambda now=now: now[0], sleep=lambda s, now=now: now.__setitem__(0, now[0] + s))
        for i in range(n):
            slots.wait()
            times.append(now[0])
            now[0] += 0.05 if i % 5 else 3.3  # some requests take longer
    times.sort()
    assert all(b - a > 0.4999 for a, b in zip(times, times[1:])) and len(times) == 80
    free = providers.Slots(0.0, clock=lambda: 1 / 0)
    free.wait()


def test_first_of_a_key_takes_rows_as_they_are():
    """No frame is made for a key: its rows pass, and the smallest, nulls last, is the first."""
    from types import SimpleNamespace

    from pyspark.sql import Row

    from marlstone.streaming.seen import _First

    seen: list = []
    made = _First(["n"], ["n", "url", "new"])
    made.seen = SimpleNamespace(exists=lambda: bool(seen), update=seen.append)
    rows = [Row(n=n, url="u") for n in (None, 3, 1, 2, 1)]
    got = [tuple(r) for r in made.handleInputRows(("u",), iter(rows), None)]
    assert sorted(got, key=repr) == sorted([(None, "u", False), (3, "u", False), (1, "u", True), (2, "u", False), (1, "u", False)], key=repr)
    assert [tuple(r) for r in made.handleInputRows(("u",), iter(rows[:1]), None)] == [(None, "u", False)]


def test_a_request_reads_a_part_of_the_same_size(spark):
    """Parts grow in number with the table; requests are dealt to all tasks, few as their bytes are."""
    import os

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from marlstone.plans.round_trips import _Web

    n = 20 * _Web.rows
    web = _Web.of(spark.range(n).select(F.concat(F.lit("u"), "id").alias("url"), F.lit(200).alias("status"), F.col("id").cast("string").alias("body")))
    files = [os.path.join(d, f) for d, _, fs in os.walk(web.folder.removeprefix("file:")) for f in fs if f.endswith(".parquet")]
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert sum(sizes) == n and max(sizes) < 2 * _Web.rows
    assert web("u7") == (200, "7") and web("none") == (404, "")
    works, _ = bibliography.looked_up(spark.range(40).select(F.concat(F.lit("u"), "id").alias("doi")), lambda doi, retry: {"title": [str(os.getpid())]}, gap=0.0)
    assert works.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and works.count() == 40
