"""The commands, over files."""

import io
import json
import zipfile

import pytest

from marlstone import cli

A = "https://www.nature.com/articles/"


def lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


class Service:
    def __init__(self, settings):
        self.settings = settings

    def upload(self, contents):
        return "b"

    def poll(self, batch):
        return {"a.pdf": ("done", "a", None), "b.pdf": ("failed", None, "bad")}

    def download(self, url):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            z.writestr("full.md", "text")
        return data.getvalue()


@pytest.fixture
def run(spark, capsys):
    def go(*argv):
        code = cli.main([*map(str, argv)], spark)
        return code, capsys.readouterr().out.splitlines()

    return go


def test_search_and_collect(run, tmp_path):
    scrapes = lines(tmp_path / "s.jsonl", [{"url": f"{A}ncomms{i}", "markdown": f"# T{i}\n\nx", "metadata": {"title": f"T{i}"}} for i in range(4)])
    searches = lines(tmp_path / "q.jsonl", [{"query": "q", "ord": i, "url": f"{A}ncomms{i}?a"} for i in (2, 0, 3)])
    (tmp_path / "pdfs").mkdir()
    (tmp_path / "pdfs" / "ncomms0.pdf").write_bytes(b"%PDF-0")
    common = ("--scrapes", scrapes, "--searches", searches)
    assert run("discover", *common, "--query", "q", "--limit", 2) == (0, [f"{A}ncomms0", f"{A}ncomms2"])
    code, out = run("collect", *common, "--pdfs", tmp_path / "pdfs", "--output-dir", tmp_path / "out", "--query", "q", "--limit", 2, "--url", f"{A}ncomms1", "--url", f"{A}ncomms9", "--print-records")
    records = [json.loads(x) for x in out if x.startswith("{")]
    assert code == 0 and sorted(r["slug"] for r in records) == ["ncomms0", "ncomms1", "ncomms2"] and "failed_urls: 1" in out
    assert (tmp_path / "out" / "article_pdfs" / "ncomms0.pdf").read_bytes() == b"%PDF-0"
    assert json.loads(run("stats", "--output-dir", tmp_path / "out", "--json")[1][0])["total_articles"] == 3
    with pytest.raises(SystemExit):
        run("discover", "--engine", "native", "--query", "q")


def test_discover_listings(run, tmp_path):
    listings = lines(tmp_path / "l.jsonl", [{"archive_url": a, "page_number": n, "urls": [f"{a}{n}{i}" for i in range(2)]} for a in ("x", "y") for n in (1, 2)])
    assert run("discover-archive", "--listings", listings, "--archive-url", "x", "--all-pages")[1] == ["x10", "x11", "x20", "x21"]
    assert run("discover-site", "--listings", listings, "--archive-url", "y", "--archive-url", "x", "--pages", 1)[1] == ["y10", "y11", "x10", "x11"]


def test_parse(run, tmp_path):
    for name in ("a.pdf", "sub/b.pdf", "sub/a.pdf"):
        (tmp_path / "d" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "d" / name).write_bytes(b"%PDF")
    where = ("--data-dir", tmp_path / "d", "--output-dir", tmp_path / "o", "--service", "tests.test_cli:Service")
    code, out = run("parse", "--all", "--save-summary", *where)
    summary = json.loads(out[-1])
    assert code == 0 and (summary["total"], summary["successful"], summary["errors"]) == (2, 1, [{"file": "b.pdf", "phase": "poll", "error": "bad"}])
    assert (tmp_path / "o" / "a" / "full.md").read_text() == "text"
    assert run("parse", "--all", "--fail-on-error", *where)[0] == 1 and run("parse", *where)[0] == 1
    assert run("parse", "--all", "--no-recursive", "--data-dir", tmp_path / "d") == (0, [f"file:{tmp_path}/d/a.pdf"])


def test_papers_and_render(run, tmp_path):
    (tmp_path / "dois.txt").write_text("d2\n\nd1\n")
    works = lines(tmp_path / "w.jsonl", [{"doi": "d1", "title": "T", "journal": ["J"], "citations": 3}])
    out = run("papers", "--dois", "d1", "--doi-list", tmp_path / "dois.txt", "--works", works, "--output-dir", tmp_path / "o")[1]
    assert [(r["doi"], r["citations"]) for r in map(json.loads, out)] == [("d1", 3), ("d2", None)]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x.pdf").write_bytes(b"%PDF-1 << /Title (A title) >>")
    assert json.loads(run("papers", "--metadata", "--pdf-dir", tmp_path / "p")[1][0])["title"] == "A title"
    blocks = lines(tmp_path / "b.jsonl", [{"doc": d, "page_idx": 0, "index": i, "type": "title" if i == 0 else "text", "text": f"{d}{i}", "level": 2} for d in ("s1", "s2", "s3") for i in range(2)])
    code, out = run("render", "--blocks", blocks, "--start", 1, "--end", 3, "--output-dir", tmp_path / "r")
    assert code == 0 and sorted(p.name for p in (tmp_path / "r").iterdir()) == ["s2.md", "s3.md"] and (tmp_path / "r" / "s2.md").read_text() == "## s20\n\ns21"
