import io
import json
import random
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from marlstone.functions import html
from marlstone.operators import bibliography, blocks, catalog, components, dedupe, frontier, tasks
from marlstone.plans.collect import Catalog, Collector, discover_sitemap
from marlstone.sources import clients, files, providers
from marlstone.streaming import collect

A = "https://www.nature.com/articles/"


def sequential(rows):
    kept, owner = [], {}
    for i, keys in sorted(rows):
        if not any(k in owner for k in keys):
            kept.append(i)
            for k in keys:
                owner[k] = i
    return {i: min((owner[k] for k in keys if k in owner), default=i) for i, keys in rows}


@pytest.mark.parametrize("seed", range(3))
def test_greedy_dedupe_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [f"k{rng.randrange(40)}" for _ in range(rng.randrange(0, 4))]) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, keys array<string>")
    assert dict(map(tuple, dedupe.greedy_leaders(df, "id", "keys").collect())) == sequential(rows)


def test_greedy_dedupe_of_long_chains(spark):
    """Chains of any length end exactly: by parity, by a walk of their component, or by rounds."""
    chain = [(i, [f"k{i}", f"k{i + 1}"]) for i in range(10)]  # each conflicts with the next
    df = spark.createDataFrame(chain, "id int, keys array<string>")
    assert dict(map(tuple, dedupe.greedy_leaders(df, "id", "keys").collect())) == sequential(chain)
    n = 100_000
    long = spark.range(n).select(F.col("id"), F.array(F.concat(F.lit("k"), F.col("id").cast("string")), F.concat(F.lit("k"), (F.col("id") + 1).cast("string"))).alias("keys"))
    got = dedupe.greedy_leaders(long, "id", "keys").agg(F.count(F.lit(1)), F.count_if(F.expr("leader = id - id % 2"))).first()
    assert tuple(got) == (n, n)  # of each two neighbours the even one leads
    wide = [(i, [f"k{i + j}" for j in range(3)]) for i in range(40)] + [(100 + i, ["one"]) for i in range(30)]  # each conflicts with the next two
    df = spark.createDataFrame(wide, "id int, keys array<string>")
    for alone in (1000, 0):
        assert dict(map(tuple, dedupe.greedy_leaders(df, "id", "keys", alone=alone).collect())) == sequential(wide)


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 300) if i % 60 != 59] + [(1000 + rng.randrange(40), 1000 + rng.randrange(40)) for _ in range(30)] + [(7, 7)]
    root = {x: x for pair in links for x in pair}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a int, b int")).collect()))
    assert got == {x: top(x) for x in linked}
    assert components.components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_resume_pages_is_the_mex(spark):
    rng = random.Random(1)
    rows = [(a, rng.randrange(1, 9)) for a in "abcdef" for _ in range(rng.randrange(1, 9))]
    got = dict(map(tuple, catalog.resume_pages(spark.createDataFrame(rows, "archive_url string, page_number int")).collect()))
    assert got == {a: next(p for p in range(1, 20) if (a, p) not in rows) for a in {r[0] for r in rows}}


def test_chunks_q18(spark):
    for n, batches in ((0, 0), (6, 2), (7, 3)):
        got = tasks.chunked(spark.range(n).toDF("id").repartition(3), ["id"], 3).collect()
        assert sorted((r["id"], r["batch"]) for r in got) == [(i, i // 3) for i in range(n)] and len({r["batch"] for r in got}) == batches


def test_zip_members_stay_inside(spark):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name in ("ok.txt", "dir/in.json", "../out.txt", "/abs.txt", "a/../../b", "a/../c"):
            z.writestr(name, name)
    rows = spark.createDataFrame([(data.getvalue(),), (b"no zip",), (None,)], "z binary").select(tasks.unzipped(F.col("z")).alias("m")).collect()
    assert [m["name"] for m in rows[0]["m"]] == ["ok.txt", "dir/in.json", "c"] and rows[1]["m"] == rows[2]["m"] == []


class Service:
    """A parsing service that runs on its caller's clock: the n-th poll finds the n-th state of each file."""

    def __init__(self, states, broken=(), upload_fails=0, poll_fails=0):
        self.states, self.broken, self.left = states, broken, {"upload": upload_fails, "poll": poll_fails}
        self.calls, self.now = [], 0.0

    def fails(self, what):
        self.calls.append(what)
        self.left[what] -= 1
        if self.left[what] >= 0:
            raise OSError(f"{what} failed")

    def upload(self, contents):
        self.fails("upload")
        return "b1"

    def poll(self, batch):
        self.fails("poll")
        n = self.calls.count("poll") - 1
        return {f: (s[min(n, len(s) - 1)], f, None if s[min(n, len(s) - 1)] != "failed" else "bad pdf") for f, s in self.states.items()}

    def download(self, url):
        if url in self.broken:
            raise OSError("gone")
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            z.writestr("x1_origin.pdf", b"%PDF")
            z.writestr("full.md", url)
        return data.getvalue()

    def clock(self):
        return self.now

    def sleep(self, seconds):
        self.calls.append(f"sleep {seconds:g}")
        self.now += seconds


def parsed(spark, service, names, **how):
    rows = spark.createDataFrame([(n, b"x") for n in names], "file string, content binary")
    return tasks.parse_documents(rows, service, clock=service.clock, sleep=service.sleep, **how)


def test_parse_counts_a_file_once_q19(spark):
    states = {"f0.pdf": ["pending", "done"], "f1": ["failed"], "f2": ["running", "running", "done"], "f3": ["done"]}
    got = parsed(spark, Service(states, broken=["f2"], poll_fails=1, upload_fails=2), ["f0.pdf", "f1", "f2", "f3", "f4"], settings=tasks.Settings(poll_timeout=40.0))
    assert tasks.run_summary(got).first().asDict() == {"total": 5, "successful": 2, "failed": 3}
    assert {(r["file"], r["phase"], r["error"]) for r in tasks.run_errors(got).collect()} == {("f1", "poll", "bad pdf"), ("f2", "download", "gone"), ("f4", "poll", "no end after 40 s")}
    members = {(r["stem"], r["name"]): bytes(r["content"]) for r in tasks.result_members(got).collect()}
    assert members == {("f0", "f0_origin.pdf"): b"%PDF", ("f0", "full.md"): b"f0.pdf", ("f3", "f3_origin.pdf"): b"%PDF", ("f3", "full.md"): b"f3"}
    assert dict(map(tuple, tasks.processed(got).collect())) == {"f0.pdf": True, "f1": False, "f2": False, "f3": True, "f4": False}


def test_parse_polls_without_uploading_again():
    """The loop itself, outside Spark, where its calls can be seen."""
    service = Service({"a": ["pending"]}, poll_fails=2)
    waits = []
    assert tasks.retried(lambda: service.upload({}), 3, lambda k: 2.0**k, waits.append) == ("b1", None) and waits == []
    again = Service({}, upload_fails=5)
    assert tasks.retried(lambda: again.upload({}), 3, lambda k: 2.0**k, waits.append) == (None, "upload failed") and waits == [2.0, 4.0]


def test_parse_goes_on_from_known_files(spark):
    known = spark.createDataFrame([("f0", "b0", "f0")], "file string, batch_id string, url string")
    got = {r["file"]: r for r in parsed(spark, Service({}, upload_fails=9), ["f0", "f1"], known=known).collect()}
    assert got["f0"]["error"] is None and got["f0"]["batch_id"] == "b0" and (got["f1"]["phase"], got["f1"]["error"]) == ("upload", "upload failed")


def test_middle(spark):
    blocks_ = spark.createDataFrame([(1, 0, 2, "text", "b", None), (1, 0, 1, "title", "a", 1), (1, 0, 3, "table", "t1", None), (1, 0, 4, "discarded", "no", None), (1, 1, 1, "table", "t2", None), (1, 1, 2, "text", "c", None), (1, 3, 1, "table", "t3", None)], "doc int, page_idx int, index int, type string, text string, level int")
    pages = spark.createDataFrame([(1, i, 600, 800) for i in range(4)], "doc int, page_idx int, width int, height int")
    made = json.loads(blocks.middle(blocks.page_infos(blocks_, pages)).first()["middle"])
    assert [[b["text"] for b in p["para_blocks"]] for p in made["pdf_info"]] == [["a", "b", "t1\nt2"], ["c"], [], ["t3"]]
    assert [[b["text"] for b in p["discarded_blocks"]] for p in made["pdf_info"]] == [["no"], [], [], []] and made["pdf_info"][2]["page_size"] == [600, 800]


def test_provided_levels(spark):
    rows = spark.createDataFrame([(d, i, f"t{i}", 9.0, 1) for d in (1, 2, 3) for i in range(2)], "doc int, ordinal int, text string, height double, page_number int")
    tries = {}

    def ask(titles):
        tries[len(tries)] = 1
        if len(tries) < 2:
            raise OSError("busy")
        return "<think>{</think> ```{'0': 1, 1: '2',}```" if len(tries) < 6 else "{0: 1}"

    got = blocks.provided_levels(rows.filter("doc = 1"), ask)
    assert sorted(map(tuple, got.collect())) == [(1, 0, 1), (1, 1, 2)]
    assert blocks.provided_levels(rows, lambda titles: "no").count() == 0
    assert blocks.with_levels(rows, got).filter("level is not null").count() == 2
    assert [r["markdown"] for r in blocks.RENDERERS["pipeline"](spark.createDataFrame([(1, 0, 0, "title", "T", 3)], "doc int, page_idx int, index int, type string, text string, level int")).collect()] == ["# T"]


def test_files_and_logs(spark, tmp_path):
    (tmp_path / "log.json").write_text('[{"batch_id": "b", "file_name": "f", "processed": true}, {"file_name": "g"}]')
    assert [(r["file_name"], r["processed"]) for r in files.read_task_log(spark, str(tmp_path / "log.json")).orderBy("file_name").collect()] == [("f", True), ("g", None)]
    files.write_list(spark.createDataFrame([("b",), (None,), ("a",)], "doi string"), "doi", str(tmp_path / "ok"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "ok")).collect()] == ["a", "b"]
    files.write_one_json(spark.createDataFrame([(1, None)], "total int, error string"), str(tmp_path / "sum"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "sum")).collect()] == ['{"total":1,"error":null}']
    found = spark.createDataFrame([("file:/d/a.pdf", 3), ("file:/d/b.pdf", 0)], "path string, length long")
    wanted = spark.createDataFrame([("/d/a.pdf",), ("/d/b.pdf",), ("/d/c.pdf",), ("/d/a.txt",)], "path string")
    assert sorted(map(tuple, files.validated(found, wanted).collect())) == [("/d/a.pdf", True, None), ("/d/a.txt", False, "not a PDF"), ("/d/b.pdf", False, "empty"), ("/d/c.pdf", False, "missing")]
    a, b = spark.createDataFrame([(5, "x"), (1, "y"), (7, "z")], "n int, l string"), spark.createDataFrame([(30, "p"), (10, "q")], "n int, r string")
    assert sorted(map(tuple, tasks.zipped(a, b, "n").collect())) == [(0, "y", "q"), (1, "x", "p")]
    assert files.records_or_log(None, a) is a and files.records_or_log(a.limit(0), b) is b and files.records_or_log(a, b) is a


def test_references_stand_missing_fields_q22(spark):
    kind = "doi string, work struct<reference: array<struct<doi:string,title:string,author:string,container_title:string,issued:array<array<int>>>>>"
    df = spark.createDataFrame([("d", ([("r", "T", None, None, [[2020]]), (None, None, None, None, None)],)), ("e", (None,))], kind)
    assert [tuple(r) for r in bibliography.references(df).collect()] == [("d", 0, "r", "T", None, None, 2020), ("d", 1, None, None, None, None, None)]


def test_levels():
    assert blocks.parsed_levels("<think>{1:1}</think> {0: 1, '1':2,}", 2) == {0: 1, 1: 2}
    assert blocks.parsed_levels("{0:1}", 2) is None and blocks.parsed_levels("nothing", 0) is None and blocks.parsed_levels(None, 1) is None


def test_rule_levels_never_skip(spark):
    df = spark.createDataFrame([(1, i, h) for i, h in enumerate([10, 30, 20, 10, 5, 1, 30])], "doc int, ordinal int, height int")
    got = [r["level"] for r in blocks.rule_levels(df).orderBy("ordinal").collect()]
    assert got == [1, 1, 2, 3, 4, 4, 1]


def test_closure_guards(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "src string, dst string")
    roots = spark.createDataFrame([("a",)], "node string")
    assert dict(map(tuple, frontier.closure(roots, edges).collect())) == {"a": 0, "b": 1, "c": 2}
    with pytest.raises(ValueError):
        frontier.closure(roots, edges, most_levels=1)


def test_gate():
    time, slept = [0.0], []
    gate = providers.Gate(2.0, clock=lambda: time[0], sleep=slept.append)
    gate.wait()
    gate.wait()
    time[0] = 5.0
    gate.wait()
    assert slept == [0.5]


def test_listing_pages(spark):
    pages = {1: [f"{A}ncomms{i}" for i in range(20)], 2: [f"{A}ncomms{i}" for i in (3, 40)], 3: []}
    asked = []

    def page(archive, n):
        asked.append(n)
        return pages.get(n, []) if asked.count(n) == 1 else [f"{A}ncomms41"]  # a second look finds another: Q30

    got = [r.asDict() for r in providers.listing_pages(spark, "x", page).orderBy("page_number").collect()]
    assert asked == [1, 2, 2, 3] and [len(r["page_urls"]) for r in got] == [20, 3, 0] and [len(r["new_urls"]) for r in got] == [20, 2, 0]
    assert len(providers.listing_pages(spark, "x", lambda a, n: pages[n], max_pages=1).collect()) == 1


def scraped(i, **more):
    return {"markdown": f"# Title {i}\n\nAnn\n## Abstract\nabout {i}"} | more


def test_collected_files(spark, tmp_path):
    """Markdown, PDFs, JSON and the slim log, with the paths; a PDF that can't be had loses nothing but itself."""
    pdf_url = "https://static-content.springer.com/x/p1.pdf"
    pages = {A + "ncomms1": scraped(1) | {"markdown": scraped(1)["markdown"] + f"\n[Peer Review File]({pdf_url})\n[Download PDF]({A}ncomms1.pdf)"}, A + "ncomms2": scraped(2, metadata={"title": "Two"})}
    contents = {pdf_url: b"%PDF-1\n\x00\xff", A + "ncomms1.pdf": b"%PDF-2"}
    collector = Collector(spark, str(tmp_path), clients.TableClient(pages, contents=contents), partitions=2, per_second=1000.0)
    got = {r["slug"]: r for r in collector.collect_urls(files.urls_from_list(spark, list(pages))).collect()}
    one, two = got["ncomms1"], got["ncomms2"]
    read = lambda p: (tmp_path / p).read_bytes()
    assert read("markdown/ncomms1.md").decode() == pages[A + "ncomms1"]["markdown"] and one["markdown_path"].endswith("markdown/ncomms1.md")
    assert read("article_pdfs/ncomms1.pdf") == b"%PDF-2" and read("peer_review_pdfs/ncomms1.pdf") == contents[pdf_url] and one["peer_review_pdf_path"].endswith("peer_review_pdfs/ncomms1.pdf")
    assert two["article_pdf_url"] and two["article_pdf_path"] is None and two["record_path"].endswith("records/ncomms2.json")
    assert json.loads(read("records/ncomms1.json"))["article_pdf_path"] == one["article_pdf_path"]
    assert [(r["slug"], r["kind"]) for r in collector.catalog.log("assets", "").filter("error is not null").collect()] == [("ncomms2", "article_pdf_path")]
    assert {r["slug"]: r["record_path"] for r in files.records_from_jsonl(spark, f"{tmp_path}/articles.jsonl").collect()} == {s: r["record_path"] for s, r in got.items()}
    other = Collector(spark, str(tmp_path / "x"), clients.TableClient(pages, contents=contents))
    assert {r["peer_review_pdf_path"] for r in other.collect_urls(files.urls_from_list(spark, list(pages)), peer_reviews=False).collect()} == {None}


def test_engines(spark):
    class Answer:
        def __init__(self, **fields):
            self.fields = fields

        def model_dump(self):
            return self.fields

    calls = []

    def call(method, arguments):
        calls.append((method, arguments))
        return Answer(data={"web": [Answer(url=A + "ncomms1?x"), {"url": A + "ncomms2"}, {"url": "http://other"}, {"title": "none"}, A + "ncomms1", A + "ncomms3"]}) if method == "search" else Answer(markdown="m", rawHtml="<p>", links=None, metadata={"a": ["x", "y"], "b": None})

    service = clients.client("service", call)
    assert [(r["url"]) for r in providers.searched(spark, service, "q", 2).orderBy("ord").collect()] == [A + "ncomms1", A + "ncomms2"]
    assert service.article("u") == {"markdown": "m", "html": None, "raw_html": "<p>", "links": None, "metadata": {"a": "x; y"}}
    service.listing("u", 2)
    assert calls[-1][1]["actions"][0]["milliseconds"] == 5000
    assert clients.found_urls({"web": []}) == clients.found_urls(None) == [] and clients.found_urls({"web": ["u"]}) == ["u"]
    pages = {"u": (200, "<title>é</title>".encode()), "gone": (404, b""), "bad": (500, b"")}
    native = clients.client("native", lambda url, headers: pages[url])
    assert native.article("u") == {"html": "<title>é</title>"} and native.listing("gone") == {} and native.content("u") == pages["u"][1]
    for f in (lambda: native.article("gone"), lambda: native.listing("bad"), lambda: native.search("q", 1), lambda: clients.client("other", call)):
        with pytest.raises((LookupError, OSError, NotImplementedError, ValueError)):
            f()
    asked = []

    def page(archive, n):
        asked.append(n)
        if n > 1:
            raise clients.NotThere(n)
        return ["a"] * 20

    assert [p[2] for p in providers.iter_pages("x", page)] == [["a"], []] and asked == [1, 1, 2]
    assert clients.landing_html(clients.TableClient(contents={"https://doi.org/d": b"page"}), "d") == "page" and clients.landing_html(clients.TableClient(), "d") is None


def test_rates_are_shared(spark):
    began = time.monotonic()
    got = providers.downloaded(spark.createDataFrame([(f"u{i}",) for i in range(8)], "url string"), lambda url: url.encode(), partitions=2, per_second=8.0).collect()
    assert len(got) == 8 and time.monotonic() - began > 0.6
    with pytest.raises(ValueError):
        providers.downloaded(spark.range(1).selectExpr("'u' as url"), str.encode, per_second=1.0)


def test_collect(spark, tmp_path):
    store = {A + f"ncomms{i}": scraped(i) for i in range(6)} | {A + "ncomms9": scraped(1)}  # 9 has the title of 1
    collector = Collector(spark, str(tmp_path), providers.TableFetcher(store))
    assert collector.stats()["total_articles"] == 0  # Q17
    first = collector.collect_urls(files.urls_from_list(spark, [A + "ncomms1?x", A + "ncomms9", A + "ncomms1", A + "ncomms404", "http://other"]))
    assert [r["slug"] for r in first.collect()] == ["ncomms1"]
    stats = collector.stats()
    assert (stats["total_articles"], stats["cached_urls"], stats["success_urls"], stats["failed_urls"]) == (1, 3, 2, 1)
    assert [r["url"] for r in collector.catalog.failed().collect()] == [A + "ncomms404"]
    second = collector.collect_urls(files.urls_from_list(spark, [A + "ncomms9", A + "ncomms2", A + "ncomms404"]))
    assert sorted(r["slug"] for r in second.collect()) == ["ncomms1", "ncomms2"] and collector.stats()["total_articles"] == 2
    store[A + "ncomms404"] = scraped(404)
    later = Collector(spark, str(tmp_path), providers.TableFetcher(store))
    assert later.collect_urls(files.urls_from_list(spark, [A + "ncomms404"]), retry_failed=False).count() == 0
    assert later.collect_urls(files.urls_from_list(spark, [A + "ncomms404"])).count() == 1
    assert later.stats()["failed_urls"] == 0


def test_collect_archive_resumes_and_fills_gaps(spark, tmp_path):
    store = {A + f"ncomms{i}": scraped(i) for i in range(5)}
    pages = {1: [A + "ncomms0", A + "ncomms1"], 2: [A + "ncomms2"]}
    page = lambda archive, n: pages.get(n, [])
    events = []
    collector = Collector(spark, str(tmp_path), providers.TableFetcher(store), on_progress=events.append)
    assert collector.collect_archive("arch", page, max_pages=None).count() == 3
    assert [e["cumulative_discovered"] for e in events] == [2, 3, 3]
    assert Catalog(spark, str(tmp_path)).resume_page("arch") == 4  # the empty page counts: Q13
    pages[1].append(A + "ncomms4")
    assert collector.collect_archive("arch", page, max_pages=None).count() == 0
    assert collector.fill_gaps_archive("arch", page).count() == 4 and collector.stats()["total_articles"] == 4


def test_sitemap(spark):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    docs = [("root", f"<sitemapindex {ns}><sitemap><loc>m1</loc></sitemap><sitemap><loc>m2</loc></sitemap></sitemapindex>")]
    docs += [(f"m{i}", f"<urlset {ns}><url><loc>{A}ncomms{i}</loc></url><url><loc>{A}ncomms1</loc></url><url><loc>http://no</loc></url></urlset>") for i in (1, 2)]
    got = discover_sitemap(spark.createDataFrame(docs, "url string, xml string"), "root")
    assert [(r["url"], r["ord"]) for r in got.orderBy("ord").collect()] == [(A + "ncomms1", 0), (A + "ncomms2", 1)]


def test_files(spark, tmp_path, monkeypatch):
    (tmp_path / "urls.txt").write_text("# c\n http://a \n\nhttp://b\n")
    assert [r["url"] for r in files.urls_from_file(spark, str(tmp_path / "urls.txt")).orderBy("ord").collect()] == ["http://a", "http://b"]
    (tmp_path / "log.jsonl").write_text('{"slug":"a","title":"old"}\n\n{"title":"no slug"}\n[1]\n{"slug":"a","title":"new","extra":1}\n')
    got = files.records_from_jsonl(spark, str(tmp_path / "log.jsonl")).collect()
    assert [(r["slug"], r["title"], r["doi"]) for r in got] == [("a", "new", None)]
    for p in ("p/x.pdf", "p/sub/x.PDF", "p/sub/y.pdf", "p/z.txt"):
        (tmp_path / p).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / p).write_bytes(b"%PDF")
    found = files.pdf_files(spark, str(tmp_path / "p"))
    assert sorted(r["name"] for r in found.collect()) == ["x.PDF", "x.pdf", "y.pdf"]
    assert [r["name"] for r in files.pdf_files(spark, str(tmp_path / "p"), recursive=False).collect()] == ["x.pdf"]  # Q21
    rows = spark.createDataFrame([("s1.md", "body é\n".encode()), ("s2.bin", bytes(range(256))), ("../out", b"x"), (None, b"y"), ("s3", None)], "name string, content binary")
    written = {r["name"]: r for r in files.write_blobs(rows, str(tmp_path / "blobs"), "name", "content").collect()}
    assert sorted(p.name for p in (tmp_path / "blobs").iterdir()) == ["s1.md", "s2.bin"] and (tmp_path / "blobs" / "s2.bin").read_bytes() == bytes(range(256))
    assert written["s1.md"]["error"] is None and written["../out"]["error"] == written[None]["error"] == "not a file name" and written["s3"]["error"] == "no content"
    files.write_blobs(spark.createDataFrame([("s1.md", "new")], "name string, content string"), str(tmp_path / "blobs"), "name", "content", replace=False)
    assert (tmp_path / "blobs" / "s1.md").read_text() == "body é\n"
    files.write_blobs(spark.createDataFrame([("s1.md", "new")], "name string, content string"), str(tmp_path / "blobs"), "name", "content")
    assert (tmp_path / "blobs" / "s1.md").read_text() == "new"
    for start in ("file:", "file://"):
        files.write_blobs(spark.createDataFrame([(f"in/{len(start)}", start)], "name string, content string"), f"{start}{tmp_path}/uri", "name", "content", nested=True)
        assert (tmp_path / "uri" / "in" / f"{len(start)}").read_text() == start
    monkeypatch.chdir(tmp_path)
    assert files.write_blobs(spark.createDataFrame([("x", "y")], "name string, content string"), "plain", "name", "content").first()["path"] == f"{tmp_path}/plain/x"


def test_appended_lines(spark, tmp_path):
    """The last append of a slug counts, whatever the size of its file; and the last line in it."""
    path = str(tmp_path / "log.jsonl")
    files.append_jsonl(spark.createDataFrame([(0, "a", "old " * 500), (1, "b", "one"), (2, "b", "two")], "n int, slug string, title string").repartition(3), path, ["n"])
    files.append_jsonl(spark.createDataFrame([(0, "a", "new")], "n int, slug string, title string"), path, ["n"])
    assert sorted((r["slug"], r["title"]) for r in files.records_from_jsonl(spark, path).collect()) == [("a", "new"), ("b", "two")]
    (tmp_path / "dois").mkdir()
    (tmp_path / "dois" / "2.txt").write_text("d3\n\n")
    (tmp_path / "dois" / "1.txt").write_text("d1\n d2\n")
    assert [(r["ord"], r["doi"]) for r in files.doi_list(spark, str(tmp_path / "dois")).orderBy("ord").collect()] == [(0, "d1"), (1, "d2"), (2, "d3"), (3, "")]


def test_streams_that_fill_gaps_twice(spark, tmp_path):
    """Each run of a gap filler keeps its rows: the first finds page 3, the second page 4."""
    kind = spark.createDataFrame([], "page_id int, url string").schema
    made = lambda n: spark.createDataFrame([(n, f"http://u{n}"), (n + 10, "http://u0/")], kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    made(1)
    told = []
    assert collect.collect_pages(spark, f"{tmp_path}/in", kind, f"{tmp_path}/out", f"{tmp_path}/c0", on_batch=lambda n, rows: told.append((n, rows))) == 1 and told == [(0, 2)]
    for n in (3, 4):
        made(n)
        collect.fill_gaps(spark, f"{tmp_path}/in", kind, f"{tmp_path}/out", f"{tmp_path}/c{n}")
    got = sorted((r["url"], r["page_id"]) for r in spark.read.parquet(f"{tmp_path}/out").select("url", "page_id").collect())
    assert got == [("http://u0", 11), ("http://u1", 1), ("http://u3", 3), ("http://u4", 4)]


def test_polls_over_several_batches(spark, tmp_path):
    """A file's end counts once; a file without one times out when time has gone on, and not again."""
    from datetime import datetime

    from marlstone.streaming.polls import final_states

    at = lambda minute: datetime(2024, 1, 1, 0, minute)
    batches = [[("a", "running", at(0), 1), ("b", "running", at(0), 2), ("c", "done", at(1), 3)], [("a", "done", at(3), 4), ("c", "failed", at(4), 5), ("d", "running", at(20), 6)], [("b", "done", at(21), 7), ("e", "done", at(40), 8)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "file string, state string, ts timestamp, ord long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = final_states(spark.readStream.schema("file string, state string, ts timestamp, ord long").parquet(f"{tmp_path}/in"))
        stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").option("path", f"{tmp_path}/out").trigger(availableNow=True).start().awaitTermination()
    got = sorted((r["file"], r["state"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("a", "done"), ("b", "timeout"), ("c", "done"), ("d", "timeout"), ("e", "done")]


def test_polls_forget_files_by_the_clock(spark, tmp_path):
    """Timeouts come without a further report, and state goes when its time is over."""
    from datetime import datetime

    from marlstone.streaming.polls import final_states

    kind, ended = "file string, state string, ts timestamp, ord long", []
    spark.createDataFrame([(f, s, datetime(2024, 1, 1), i) for i, (f, s) in enumerate([("a", "running"), ("b", "done"), ("b", "failed"), ("c", "pending")])], kind).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = final_states(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), timeout_s=1, keep_s=2, wall_clock=True)
    query = stream.writeStream.foreachBatch(lambda batch, n: ended.extend((r["file"], r["state"]) for r in batch.collect())).option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="200 milliseconds").start()
    most, began = 0, time.monotonic()
    try:
        while time.monotonic() - began < 90:
            rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
            most = max([most, *rows])
            if most and rows[-1] == 0:
                break
            time.sleep(0.3)
    finally:
        query.stop()
    assert sorted(ended) == [("a", "timeout"), ("b", "done"), ("c", "timeout")] and most >= 3 and rows[-1] == 0


def test_polls_forget_files_by_their_own_time(spark, tmp_path):
    from datetime import datetime

    from marlstone.streaming.polls import final_states

    kind, left = "file string, state string, ts timestamp, ord long", []
    for k, rows in enumerate([[("a", "done", datetime(2024, 1, 1), 1), ("b", "running", datetime(2024, 1, 1), 2)], [("z", "done", datetime(2024, 1, 9), 3)], [("z", "done", datetime(2024, 1, 20), 4)]]):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = final_states(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), timeout_s=60, keep_s=3600)
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").option("path", f"{tmp_path}/out").trigger(availableNow=True).start()
        query.awaitTermination()
        left.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sorted((r["file"], r["state"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [("a", "done"), ("b", "timeout"), ("z", "done")]
    assert left[0] > 0 and left[-1] == 0  # all are forgotten when time has gone on


def test_listing_source(spark):
    spark.dataSource.register(providers.ListingSource)
    rows = spark.read.format("listing").option("archive", "x").option("last", 3).option("page_size", 1).option("pages", "tests.test_operators:listed").load()
    assert sorted((r["page_number"], r["urls"]) for r in rows.collect()) == [(1, ["x1"]), (2, ["x2"]), (3, ["x3"])]


    pages = spark.createDataFrame([("x", n, ["u"] if n not in (3, 5) else []) for n in range(1, 7)] + [("y", 1, ["u"])], "archive_url string, page_number int, urls array<string>")
    assert sorted((r[0], r[1]) for r in providers.until_empty(pages).collect()) == [("x", 1), ("x", 2), ("x", 3), ("y", 1)]


def listed(archive, page):
    return [f"{archive}{page}"]


def test_flat_html_matches_parser(spark):
    df = spark.createDataFrame([('<title> a </title><a href="/x">1</a>',)], "h string")
    assert df.select(html.plain_title(F.col("h")), html.plain_links(F.col("h"))).first()[:] == ("a", ["/x"])
