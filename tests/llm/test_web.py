import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from arealis.llm import html_extract, warc

PAGES = "page_id long, url string, html string, host string, text string, payload string, codes int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "t", "p", 1) for r in rows], PAGES)


LONG = "<p>" + "ü" * 100 + "</p>"
ROWS = [
    (1, "http://a.example/1", LONG),
    (2, "http://a.example/2 x\r\ny", LONG),
    (3, None, LONG),
    (4, "http://b.example/", "short"),
    (5, "http://b.example/", "short"),
    (6, "", None),
    (7, "http://b.example/7", ""),
    (8, "http://b.example/8", "WARC/1.1\r\nnot a record\r\n\r\n\x1f\x8b\x08" * 20),
    (8, "http://b.example/8", "WARC/1.1\r\nnot a record\r\n\r\n\x1f\x8b\x08" * 20),
    (None, "http://c.example/", LONG),
    (9, "http://b.example/9", "x" * 300_000),
]


@pytest.mark.parametrize("compressed", [True, False])
def test_round_trip(spark, compressed):
    df = pages(spark, ROWS)
    read = warc.read_warc(spark, warc.write_warc(df, compressed=compressed)).cache()
    assert warc.gaps(read).count() == 0
    rows = warc.records(read).collect()
    assert len(rows) == len(ROWS)
    source = {k: (h or "").encode() for k, _, h in ROWS}
    for r in rows:
        body = source[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        again = r.page_id in (2, 3, None)
        assert (r.record_type, r.refers_to) == (("revisit", 1) if again else ("response", None))
        assert r.payload is None if again else bytes(r.payload) == body


def test_nothing(spark):
    path = warc.write_warc(pages(spark, []))
    assert warc.read_warc(spark, path).count() == 0
    assert html_extract.extract_pages(pages(spark, [])).count() == 0


def archive(n, compressed):
    records = [warc._record(i, f"http://x/{i}", f"body {i} ".encode() * 40, hashlib.sha256(f"body {i} ".encode() * 40).hexdigest(), None) for i in range(n)]
    return [gzip.compress(r, mtime=0) if compressed else r for r in records]


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_recovers_what_is_whole(compressed):
    parts = archive(30, compressed)
    rng = random.Random(5)
    hurt = {3, 4, 11, 29}
    data, spans = b"", {}
    for i, part in enumerate(parts):
        if i in hurt:
            k = rng.randrange(len(part) // 3, len(part) - 30)
            part = part[:k] + bytes(20) + part[k + 20 :] if i != 29 else part[:k]
        spans[i] = (len(data), len(data) + len(part))
        data += part + (b"rubbish" if i == 20 else b"")
    found = list(warc.salvage(data))
    bodies = [f["block"].split(b"\r\n\r\n", 1)[1] for _, f, reason in found if reason is None]
    assert bodies == [f"body {i} ".encode() * 40 for i in range(30) if i not in hurt]
    lost = [(a, b) for a, b, reason in found if reason is not None]
    want = [(spans[3][0], spans[4][1]), spans[11], (spans[20][1], spans[20][1] + 7), spans[29]]
    covered = sorted(x for a, b in lost for x in range(a, b))
    assert covered == sorted(x for a, b in want for x in range(a, b))


def test_salvage_of_mixed_and_empty_bytes():
    plain, packed = archive(2, False), archive(2, True)
    found = list(warc.salvage(plain[0] + packed[0] + plain[1] + packed[1]))
    assert [reason for _, _, reason in found] == [None] * 4
    assert list(warc.salvage(b"")) == []
    assert [x[2] for x in warc.salvage(b"no archive")] == ["neither member nor version line"]


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>x";</script></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<main><article class="post"><header><h1>The  title &amp; more</h1></header><p>One <b>bold<br>two</b> three.
<p>Second &lt;tag&gt; par<ul><li>item 1<li>item 2</ul><div class="share">Share me</div><form><input value=1>Sign</form>
<blockquote>quoted</blockquote><table><tr><td>a<td>b</table><aside>side</aside><footer>foot</footer></article>
<section id="comments"><article class=comment><p>nice</p></article></section></main><footer>c</footer></body></html>"""


@pytest.mark.parametrize(
    "page,text",
    [
        (PAGE, "The title & more\nOne bold two three.\nSecond <tag> par\nitem 1\nitem 2\nquoted\na\nb"),
        ("", ""),
        ("<p>cut &am", "cut &am"),
        ("plain", "plain"),
        ("<div>a<p>b</div>c<p cl", "a\nb\nc"),
        ("<article><p><b>x.<br><p>y</article>", "x.\ny"),
        ("<b><div>" * 5000 + "deep", "deep"),
        ("<!-- never closed <p>x", ""),
        ("<p a='>'>x</p><p a=\"<p>\">y", "x\ny"),
        ("<article>" + "<p>" + "long " * 50_000 + "</article>", ("long " * 50_000).strip()),
    ],
)
def test_extract(page, text):
    assert html_extract.extract(page, set()) == text


@pytest.mark.parametrize(
    "page",
    [
        "<div class='layout no-sidebar'><article><p>story</article></div>",
        "<div id='content' class='has-sidebar'><p>story</div><div class='cookie-notice'>cookies</div>",
        "<div id='content' class='sidebar-left'><main><p>story</main></div><div class=sidebar>side</div>",
        "<article class='post comments-open'><p>story</article><section id=comments><article class=comment>much longer</article></section>",
    ],
)
def test_names_of_the_layout_do_not_hide_the_article(page):
    assert html_extract.extract(page, set()) == "story"


@pytest.mark.parametrize(
    "page,text",
    [
        ("<form id=aspnetForm><main><article><p>story</article></main></form>", "story"),
        ("<form><input value=1>Sign</form><article><p>story</article>", "story"),
        ("<section class='widget'><article><p>story</article></section>", "story"),
        ("<aside><article><p>teaser that is longer than the story</article></aside><article><p>story</article>", "story"),
        ("<article><h2 id='related-work'>Related work</h2><p>a<h2 id='social-impact'>Impact</h2><p>b</article>", "Related work\na\nImpact\nb"),
        ("<article><p id='notice-period'>Notice<section id='search-methods'><p>How</section></article>", "Notice\nHow"),
        ("<article><p>a<div class='share buttons'>Share</div><div id=comments><p>nice</div></article>", "a"),
        ("<article><p>a<div class='share-price'>5 EUR</div></article>", "a\n5 EUR"),
        ("<p>See<ul><li><a href=1>First source</a><li><a href=2>Second source</a></ul><p>for more", "See\nFirst source\nSecond source\nfor more"),
        ("<ul><li><a href=1>Home</a><li><a href=2>News</a></ul><p>story", "story"),
        ("<p id='cookie-law'>Law of cookies</p><p class='notice'>We use cookies</p>", "Law of cookies"),
    ],
)
def test_names_hide_no_prose(page, text):
    assert html_extract.extract(page, set()) == text


def test_pages_without_an_article_keep_inline_elements_headings_and_paragraphs(spark):
    """What recurs inside sentences or between paragraphs stays; boxes go, large ones on more pages only."""
    page = "<div>Buy now</div><h2>Introduction</h2><p>Page {i} is <em>not</em> about number 1; see <code>SELECT</code> in row 0.{tail}"
    rows = [(i, f"https://a.example/{i}", page.format(i=i, tail="")) for i in range(6)]
    shared = "<p>The same words on all pages.<h3>More</h3><p>Text {i}<p>Rights kept"
    rows += [(10 + i, f"https://b.example/{i}", page.format(i=i, tail=shared.format(i=i))) for i in range(6)]
    large = "<div><p>" + "many words " * 60 + "</div><p>own {i}"
    rows += [(20 + i, f"https://c.example/{i}", large.format(i=i)) for i in range(6)]
    rows += [(30 + i, f"https://d.example/{i}", large.format(i=i)) for i in range(12)]
    text = {r.page_id: r.text for r in html_extract.extract_pages(pages(spark, rows)).collect()}
    assert text[4] == "Introduction\nPage 4 is not about number 1; see SELECT in row 0."
    assert text[14] == text[4] + "\nThe same words on all pages.\nMore\nText 4"
    assert text[24] == ("many words " * 60).strip() + "\nown 4"
    assert text[34] == "own 4"


def test_templates_are_found_per_host(spark):
    """Boxes that recur on a host go, even without a name; an article's repeated prose stays."""
    box = "<div><span>Buy</span> now and here</div>"
    with_article = "<body>{b}<article><h1>T{i}</h1><p>shared passage</p>{b}<p>own {i}</p></article></body>"
    without = "<body>{b}<div><p>story number {i}</p></div><p>all rights kept</p></body>"
    rows = [(i, f"https://A.example/{i}", with_article.format(b=box, i=i)) for i in range(6)]
    rows += [(10 + i, f"https://b.example/{i}", without.format(b=box, i=i)) for i in range(6)]
    rows += [(20, "https://c.example/", with_article.format(b=box, i=20)), (21, None, None), (21, None, None)]
    got = html_extract.extract_pages(pages(spark, rows)).collect()
    assert sorted(r.page_id for r in got) == sorted(r[0] for r in rows)
    text = {r.page_id: r.text for r in got}
    assert text[3] == "T3\nshared passage\nown 3"
    assert text[12] == "story number 2"
    assert text[20] == "T20\nshared passage\nBuy now and here\nown 20"
    assert text[21] == ""
    assert all(r.n_chars == len(r.text) for r in got)


def test_shared_and_copied_articles_keep_their_prose(spark):
    """Lists and sections that articles share stay, and copies of a page are no evidence; what recurs outside goes."""
    shared = "<ul><li>shared item</ul><section><p>shared passage</section>"
    article = "<div><p>Follow us</div><article><h1>T{i}</h1>" + shared + "<div><p>Follow us</div></article>"
    rows = [(i, "https://a.example/", article.format(i=i)) for i in range(6)]
    rows += [(10 + i, "https://b.example/", "<article><div>whole story</div></article>") for i in range(6)]
    rows += [(20 + i, "https://c.example/", "<div><p>whole story</div>") for i in range(6)]
    text = {r.page_id: r.text for r in html_extract.extract_pages(pages(spark, rows)).collect()}
    assert text[3] == "T3\nshared item\nshared passage"
    assert text[12] == text[22] == "whole story"


def test_templates_do_not_depend_on_the_size_of_the_host(spark):
    """A box on five pages goes on a host of 1,500 pages as on a host of five."""
    box = "<div><span>Buy</span> now and here</div>"
    page = "<article><h1>T{i}</h1>{b}<p>own {i}</article>"
    rows = [(i, "https://a.example/", page.format(i=i, b=box if i < 5 else "")) for i in range(1500)]
    text = {r.page_id: r.text for r in html_extract.extract_pages(pages(spark, rows)).collect()}
    assert len(text) == 1500 and all(t == f"T{i}\nown {i}" for i, t in text.items())


def test_pages_table_matches_a_plain_rule(spark):
    import html
    import re

    from arealis.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    source = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in QUERIES["op4_html_extract"](spark, folder).collect():
        body = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.DOTALL)[1]
        parts = (html.unescape(re.sub(r"<[^>]*>?", "", x)) for x in re.split(r"<p>|</p>|</h1>", body))
        assert r.text == "\n".join(x for x in (" ".join(p.split()) for p in parts) if x)


def test_warc_query_counts(spark):
    from arealis.llm.queries import QUERIES

    found = QUERIES["op3_warc"](spark, "/root/testdata/sf0.001")
    assert found.count() == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert found.filter(F.col("record_type") == "response").filter("refers_to is not null").isEmpty()
