import hashlib
import random
import re
import uuid
import zlib
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from marlstone.functions import extract, html, ids, pdf, text, urls
from marlstone.operators import records
from marlstone.sources import files


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.select("i", make(F.col("x")).alias("v")).orderBy("i").select("v").collect()]


TEXTS = [None, "", "  \n\t", "a  b c", " x\ty z ", "One; two,, three ;", " ; , ", "É ÀB\x1cq", "l1\r\nl2\n\nl3\x0bl4\x85l5\n", "a\n"]


def test_text_helpers_equal_python(spark):
    assert column(spark, TEXTS, text.strip) == [t and t.strip() for t in TEXTS]
    assert column(spark, TEXTS, text.word_count) == [len((t or "").split()) for t in TEXTS]
    assert column(spark, TEXTS, text.text_key) == [" ".join((t or "").lower().split()) or None for t in TEXTS]
    whole = [t for t in TEXTS if t]
    assert column(spark, whole, text.lines) == [t.splitlines() for t in whole]
    assert column(spark, ["a; b,,c ", " ; ", "", None], text.string_list) == [["a", "b", "c"], [";"], [], []]
    assert column(spark, [["a ", "", None], None], text.clean_list, "array<string>") == [["a"], []]


#: Worked out by hand: an address, without query and fragment, without fragment, of 2024, first and third page, slug.
ADDRESSES = [
    ("https://www.nature.com/articles/ncomms123?x=1#top", "https://www.nature.com/articles/ncomms123", "https://www.nature.com/articles/ncomms123?x=1", "https://www.nature.com/articles/ncomms123?x=1&year=2024", "https://www.nature.com/articles/ncomms123?x=1", "https://www.nature.com/articles/ncomms123?x=1&page=3", "ncomms123"),
    (" HTTPS://Host.org/A/b/?page=2&type=article ", "https://Host.org/A/b", "https://Host.org/A/b/?page=2&type=article", "https://Host.org/A/b/?page=2&type=article&year=2024", "https://Host.org/A/b/?type=article", "https://Host.org/A/b/?page=3&type=article", "b"),
    ("http://h.org", "http://h.org", "http://h.org", "http://h.org?year=2024", "http://h.org", "http://h.org?page=3", "h.org"),
    ("http://h.org/?", "http://h.org", "http://h.org", "http://h.org?year=2024", "http://h.org", "http://h.org?page=3", "h.org"),
    ("http://h.org/p;v=1/?a=1&a=2&b=#f", "http://h.org/p;v=1", "http://h.org/p;v=1/?a=1&a=2&b=", "http://h.org/p;v=1/?a=2&b=&year=2024", "http://h.org/p;v=1/?a=2&b=", "http://h.org/p;v=1/?a=2&b=&page=3", "p;v=1"),
    ("https://h.org/ncomms/research-articles?type=article", "https://h.org/ncomms/research-articles", "https://h.org/ncomms/research-articles?type=article", "https://h.org/ncomms/research-articles?type=article&year=2024", "https://h.org/ncomms/research-articles?type=article", "https://h.org/ncomms/research-articles?type=article&page=3&searchType=journalSearch&sort=PubDate", "research-articles"),
    ("https://h.org/research-articles?type=article&sort=x&page=9", "https://h.org/research-articles", "https://h.org/research-articles?type=article&sort=x&page=9", "https://h.org/research-articles?type=article&sort=x&page=9&year=2024", "https://h.org/research-articles?type=article&sort=x", "https://h.org/research-articles?type=article&sort=x&page=3&searchType=journalSearch", "research-articles"),
    ("http://h.org/a%20b?q=a+b%2Fc&empty=&~t=*", "http://h.org/a%20b", "http://h.org/a%20b?q=a+b%2Fc&empty=&~t=*", "http://h.org/a%20b?q=a+b%2Fc&empty=&~t=%2A&year=2024", "http://h.org/a%20b?q=a+b%2Fc&empty=&~t=%2A", "http://h.org/a%20b?q=a+b%2Fc&empty=&~t=%2A&page=3", "a%20b"),
]


def test_addresses(spark):
    given, plain, listing, dated, first, third, slugs = map(list, zip(*ADDRESSES, strict=True))
    assert column(spark, given, urls.normalize_article_url) == plain
    assert column(spark, given, urls.normalize_listing_url) == listing
    assert column(spark, given, lambda x: urls.listing_url_with_year(x, F.lit(2024))) == dated
    assert column(spark, given, lambda x: urls.archive_page_url(x, F.lit(1))) == first
    assert column(spark, given, lambda x: urls.archive_page_url(x, F.lit(3))) == third
    assert column(spark, given, urls.slug_from_url) == slugs
    assert column(spark, plain, urls.normalize_article_url) == plain


@pytest.mark.parametrize("base", ["http://h.org/a/b?x=1#f", "http://h.org", "https://h.org/dir/"])
def test_resolve_equals_urljoin(spark, base):
    hrefs = ["http://o.org/x", "//o.org/y", "/z?k", "rel/page", "./rel", "?q=2", "#frag", "", "mailto:a@b.c"]
    assert column(spark, hrefs, lambda x: urls.resolve(F.lit(base), x)) == [urljoin(base, h) for h in hrefs]


def test_article_predicate_q1(spark):
    given = ["https://www.nature.com/articles/s41467-026-12345-a?x", "https://www.nature.com/articles/ncomms12.pdf", "https://www.nature.com/articles/other", None]
    assert column(spark, given, urls.is_article_url) == [True, False, False, False]
    assert column(spark, given, lambda x: urls.is_article_url(x, strict=False)) == [True, True, False, False]


def test_content_uuid(spark):
    given = ["", "abc", "é" * 100]
    assert column(spark, given, ids.content_uuid) == [str(uuid.uuid5(uuid.NAMESPACE_OID, hashlib.sha256(t.encode()).hexdigest())) for t in given]
    assert column(spark, ["/a/b.tar.gz", "c.pdf", "/x/.hidden", "noext"], ids.stem) == ["b.tar", "c", ".hidden", "noext"]


MARKDOWN = """# A title

Ann One, Bob Two & Cy Three
Received: 1 March 2020
Accepted: 2 April 2021
Published: 3 May 2022
## Abstract
First part.

  second part
## Methods
See 10.1038/ncomms77 and [Download PDF](https://www.nature.com/articles/ncomms5.pdf)
[Peer Review File](https://x.org/review.PDF)
## References
1. One
[2] Two
not counted
## More
3. Three"""


def scrape(spark, **fields):
    kinds = {"url": "string", "markdown": "string", "html": "string", "links": "array<string>", "metadata": "map<string,string>"}
    given = {"url": "https://www.nature.com/articles/ncomms5?x", "markdown": MARKDOWN, "html": None, "links": None, "metadata": None} | fields
    return spark.createDataFrame([tuple(given[k] for k in kinds)], ", ".join(f"{k} {v}" for k, v in kinds.items()))


def test_record(spark):
    r = records.records(scrape(spark)).first().asDict(recursive=True)
    assert (r["slug"], r["title"], r["doi"], r["abstract"], r["published_date"]) == ("ncomms5", "A title", "10.1038/ncomms77", "First part. second part", "3 May 2022")
    assert r["article_pdf_url"] == "https://www.nature.com/articles/ncomms5.pdf" and r["peer_review_pdf_url"] == "https://x.org/review.PDF"
    d = r["detailed_metadata"]
    assert d["authors"] == ["Ann One", "Bob Two", "Cy Three"] and d["section_headings"] == ["Abstract", "Methods", "References", "More"]
    assert d["content_stats"] == {"body_markdown_chars": len(MARKDOWN), "body_markdown_words": len(MARKDOWN.split()), "abstract_chars": 23, "abstract_words": 4, "section_count": 4, "reference_count": 2}
    assert d["dates"] == {"received": "1 March 2020", "accepted": "2 April 2021", "published": "3 May 2022"}
    assert d["source"] == "native"  # Q6
    bare = records.records(scrape(spark, markdown=None, metadata={"title": " T | Nature Communications ", "keywords": "a;b", "author": " "})).first()
    assert (bare["title"], bare["doi"], bare["article_pdf_url"], bare["body_markdown"], bare["abstract"]) == ("T", "10.1038/ncomms5", "https://www.nature.com/articles/ncomms5.pdf", None, None)
    assert bare["detailed_metadata"]["keywords"] == ["a", "b"] and bare["detailed_metadata"]["authors"] == []
    assert bare["detailed_metadata"]["raw_metadata_keys"] == ["author", "keywords", "title"]


def test_listing_urls(spark):
    a = "https://www.nature.com/articles/"
    df = scrape(spark, links=["/articles/ncomms1", a + "other", None, a + "ncomms1#x"], markdown=f"[x]({a}ncomms2?y) {a}ncomms3", html=f'<a href="{a}ncomms4">{a}ncomms2')
    got = df.select(extract.listing_urls(F.col("links"), F.col("markdown"), F.col("html"), F.col("html"), F.lit("https://www.nature.com/list"))).first()[0]
    assert got == [a + f"ncomms{i}" for i in (1, 2, 3, 4)]


PAGE = """<html><head><title> T &amp; U </title><meta name="citation_author" content="A"><meta name="citation_author" content=" B ">
<meta property="og:title" content="og"></head><body><h1 class="c-article-title">Head <b>bold</h1>
<ul class="c-article-author-list"><li>Ann</li><li>Bob</li></ul>
<section class="c-article-section" aria-labelledby="abstract-1"><h2>Abstract</h2><div class="c-article-section__content"><p>Sum <i>mary</i></p></div></section>
<section class="c-article-section"><h2>Intro</h2><p>One</p><p>Two</p></section>
<div data-test="supp-item"><h3>Other</h3><a href="/o.pdf" data-track-label="x">o</a></div>
<div data-test="supp-item"><h3>Transparent Peer Review file</h3><a href="https://s.org/p.PDF">p</a></div>
<a href="/x">x</a><a href=" http://y.org ">y</a><a href="/x">again</a><a href="rel">r</a><script>var a = "<a href='/no'>";</script></body>"""


def test_html(spark):
    assert column(spark, [PAGE, "", None], html.html_links) == [["https://www.nature.com/o.pdf", "https://s.org/p.PDF", "https://www.nature.com/x", "http://y.org"], [], None]
    assert column(spark, [PAGE, "<title></title>", None], html.html_title) == ["T & U", None, None]
    assert column(spark, [PAGE, ""], html.html_review) == ["https://s.org/p.PDF", None]
    meta = column(spark, [PAGE], lambda x: html.html_meta(x, F.lit("u")))[0]
    assert meta == {"title": ["T & U"], "citation_author": ["A", "B"], "og_title": ["og"], "url": ["u"]}  # Q7
    markdown = column(spark, [PAGE, "<main>only <p>main</main>", ""], html.html_markdown)
    assert markdown[0] == "# Head bold Ann Bob Abstract Sum mary Intro One Two Other o Transparent Peer Review file p x y again r" or markdown[0].startswith("# Head bold")
    assert "## Intro\n\nOne\nTwo" in markdown[0] and "## Abstract\n\nSum\nmary" in markdown[0]
    assert markdown[1:] == ["only\nmain", ""]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("s", "HTTP://U", None, "", "P", " My  Title", None)], "a string, b string, c string, d string, e string, f string, g string")
    assert df.select(ids.duplicate_keys(*[F.col(x) for x in "abcdefg"])).first()[0] == ["slug:s", "url:http://u", "peer_review_pdf:p", "title:my title"]


def test_pdf_information():
    data = rb"%PDF-1.4 1 0 obj << /Title (A \(small\) title \\ \101) /Author <FEFF00C90061> /Keywords (a (b) c) /Subject (open >> endobj"
    assert pdf.information(data) == {"Title": "A (small) title \\ A", "Author": "\u00c9a", "Keywords": "a (b) c"}
    assert pdf.information(b"no pdf /Title (x)") == pdf.information(b"") == pdf.information(None) == {}


@pytest.mark.parametrize("href", ["../x", "a/../b", "./a/./b", "../../../x", "/a/../b/./c", "..", "a/..", "g;x=1/../y"])
def test_dots_in_addresses(spark, href):
    base = "http://a.org/b/c/d;p?q"
    assert column(spark, [href], lambda x: urls.resolve(F.lit(base), x)) == [urljoin(base, href)]


def test_markdown_of_made_pages():
    """T23, worked out by hand."""
    said = lambda page: html.page_markdown(html.parsed(page))
    authors = '<ul class="c-article-author-list"><li>Ann <b>Lee</b></li><li>Bo</li></ul>'
    abstract = '<section class="c-article-section" aria-labelledby="abstract-1"><h2>Abstract</h2><p class="c-article-section__content">sum</p></section>'
    inner = '<section class="c-article-section"><h2>In</h2><h3>Not this</h3><p>a <i>b</i></p><script>no()</script><section class="c-article-section"><h3>Deep</h3><ul><li>c</li><li> </li></ul></section></section>'
    assert said(f"<h1>T</h1><h1>U</h1>{authors}{abstract}{inner}") == "# T\n\nAnn Lee, Bo\n\n## Abstract\n\nsum\n\n## Abstract\n\nsum\n\n## In\n\na b\nc\n\n## Deep\n\nc"
    assert said("<main><h1>T</h1><p>x</p><p>y</p></main>") == "# T\n\nT\nx\ny"
    assert said('<h1>T</h1><div class="c-article-section__content">one<br>two</div><main>no</main>') == "# T\n\n## Abstract\n\none\ntwo"
    assert said('<span class="c-article-section__content">not a div</span><main>m</main>') == "m"
    assert said(f"<h1></h1>{authors}<p>outside</p>") == "# \n\nAnn Lee, Bo" and said("") == said("<p>x</p>") == ""
    assert said('<section class="c-article-section"><p>no heading</p></section><section class="c-article-section"><h2></h2><h2>second</h2></section>') == "no heading"


def made_pdf(info, compressed=True, predictor=False, encrypt=False, newer=None):
    """A PDF of version 1.5 with its information dictionary in a compressed stream of objects and
    a compressed table, or with plain ones; ``newer`` is a later dictionary, appended."""
    out, offsets = bytearray(b"%PDF-1.5\n%\xe2\xe3\n" + b"x" * 5000 + b"\n"), {}
    crypt = b" /Encrypt 9 0 R" if encrypt else b""

    def add(number, body):
        offsets[number] = len(out)
        out.extend(b"%d 0 obj\n%s\nendobj\n" % (number, body))

    if not compressed:
        add(3, info)
        table = len(out)
        out.extend(b"xref\n0 1\n0000000000 65535 f \n3 1\n%010d 00000 n \ntrailer\n<< /Size 4 /Info 3 0 R%s >>\nstartxref\n%d\n%%%%EOF" % (offsets[3], crypt, table))
        if newer:
            add(3, newer)
            later = len(out)
            out.extend(b"xref\n3 1\n%010d 00000 n \ntrailer\n<< /Size 4 /Info 3 0 R /Prev %d >>\nstartxref\n%d\n%%%%EOF" % (offsets[3], table, later))
        return bytes(out)
    objects = b"<< /Type /Catalog >>"
    head = b"1 0 3 %d " % (len(objects) + 1)
    packed = zlib.compress(head + objects + b" " + info)
    add(2, b"<< /Type /ObjStm /N 2 /First %d /Filter /FlateDecode /Length 5 0 R >>\nstream\n%s\nendstream" % (len(head), packed))
    add(5, b"%d" % len(packed))
    rows = [b"\x00\x00\x00\x00\x00", b"\x02\x00\x00\x02\x00", b"\x01" + offsets[2].to_bytes(3, "big") + b"\x00", b"\x02\x00\x00\x02\x01", b"\x00" * 5, b"\x01" + offsets[5].to_bytes(3, "big") + b"\x00"]
    body, how = b"".join(rows), b""
    if predictor:
        body, above, how = b"", bytes(5), b" /DecodeParms << /Predictor 12 /Columns 5 >>"
        for row in rows:
            body += b"\x02" + bytes((x - y) & 255 for x, y in zip(row, above, strict=True))
            above = row
    raw, table = zlib.compress(body), len(out)
    add(7, b"<< /Type /XRef /Size 6 /W [1 3 1] /Info 3 0 R%s%s /Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream" % (crypt, how, len(raw), raw))
    return bytes(out) + b"startxref\n%d\n%%%%EOF\n" % table


def test_compressed_pdfs(tmp_path, spark):
    info = b"<< /Title (A \\(title\\) \\351) /Author <FEFF00C9> /Kids [ 1 0 R (x) << /Title (no) >> ] /Producer 4 0 R /Subject (\xef\xbb\xbf\xc3\xa9) >>"
    want = {"Title": "A (title) \u00e9", "Author": "\u00c9", "Subject": "\u00e9"}
    for how in ({}, {"predictor": True}, {"compressed": False}):
        assert pdf.information(made_pdf(info, **how)) == want
        assert pdf.information(made_pdf(info, **how, encrypt=True)) == {pdf.ENCRYPTED: "true"}
    assert pdf.information(made_pdf(info, compressed=False, newer=b"<< /Title (newer) >>")) == {"Title": "newer"}
    whole = made_pdf(info)
    damaged = re.sub(rb"startxref.*", b"startxref\n99999999\n", whole, flags=re.S)
    assert pdf.information(damaged) == {} and pdf.information(damaged + b"<< /Title (found) >>") == {"Title": "found"}
    rng = random.Random(1)
    for _ in range(300):  # whatever is broken, nothing is raised
        broken = bytearray(whole)
        for _ in range(5):
            broken[rng.randrange(len(broken) - 300, len(broken))] = rng.randrange(256)
        assert isinstance(pdf.information(bytes(broken)), dict)
    paths = []
    for i, data in enumerate((whole, made_pdf(info, encrypt=True), b"no PDF")):
        (tmp_path / f"{i}.pdf").write_bytes(data)
        paths.append((f"file:{tmp_path}/{i}.pdf",))
    got = spark.createDataFrame([*paths, (f"file:{tmp_path}/none.pdf",)], "path string").select(files.pdf_info_at(F.col("path")).alias("i")).collect()
    assert [r["i"] for r in got] == [want, {pdf.ENCRYPTED: "true"}, {}, None]


def test_few_bytes_of_a_pdf_are_read():
    class Counted(pdf.Source):
        n = 0

        def read(self, at, n):
            got = super().read(at, n)
            self.n += len(got)
            return got

    whole = b"%PDF-1.5\n" + b"z" * 2_000_000 + b"\n"
    moved = made_pdf(b"<< /Title (t) >>", compressed=False)
    at = len(whole)
    moved = whole + re.sub(rb"(\d{10}) 00000 n", lambda m: b"%010d 00000 n" % (int(m[1]) + at), moved)
    moved = re.sub(rb"startxref\n(\d+)", lambda m: b"startxref\n%d" % (int(m[1]) + at), moved)
    source = Counted(moved)
    assert pdf.information(source) == {"Title": "t"} and source.n < 40_000
