"""Main text and archive records of pages."""

import hashlib
import html
import re

from threadloom.llm import pages as P
from threadloom.llm import warc as W

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a><li><a href=b>B</a></ul></nav>
<div class="cookie-notice">We use cookies</div>
<article class="post"><h1>Title &amp; more</h1><p>First <b>bold<br>line</b>  with
 space<p>Second &lt;tag&gt; &eacute;<div class=advert>Buy</div><ul><li>one<li>two</ul>
<script>var t="</p>";</script><form><p>Mail</p></form><aside>Side</aside>
<section class="comments"><p>Nice!</p></section></article><footer>&copy; x</footer></body></html>"""


def texts(pages):
    return P.extract_group(pages)[0]


def test_article_alone():
    assert texts([PAGE]) == ["Title & more\nFirst bold line with space\nSecond <tag> é\none\ntwo"]


def test_template_text_is_left_out_without_an_article():
    pages = [f"<body><div class=x>Same words</div><div class=y><p>Own text {i}</p><p>More {i}</p></div><p><a href=1>Link {i}</a></p></body>" for i in range(4)]
    assert texts(pages) == [f"Own text {i}\nMore {i}" for i in range(4)]
    template = P.deduce_template([P.read_page(p) for p in pages])
    assert "/body/div.y/p" in template and "/body/div.x" in template


def test_broken_markup():
    for page in ("", "<", "<p", "<a href='x", "<p>a<b>b", "<!-- open", "<script>x", "</p></p>", "a < b & c", '<p title="a>b">q</p>', "<p a=\"b>c</p>"):
        assert isinstance(texts([page])[0], str)
    assert texts(["<article>a < b &amp c</article>"]) == ["a < b & c"]


def test_pages_of_the_tables(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r.page_id: r.text for r in P.extract_pages(pages, group_pages=7).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", body)
        plain = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
        assert got[r.page_id] == "\n".join(b for b in plain if b)


def test_odd_pages(spark):
    rows = [(1, None, None), (None, "http://h/x", "<p>a</p>"), (2, "no host", ""), (2, "no host", ""), (3, "http://h/y", "<article>" + "<p>w</p>" * 30_000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url as host", "html as text", "page_id as spread")
    got = P.extract_pages(df).collect()
    assert sorted((r.page_id or 0, len(r.text)) for r in got) == [(0, 1), (1, 0), (2, 0), (2, 0), (3, 59_999)]
    assert P.extract_pages(df.limit(0)).count() == 0
    records = W.derivatives(W.responses_of(df))
    assert records.count() == 10 and W.derivatives(W.responses_of(df.limit(0))).count() == 0


def test_records_link_and_survive_a_round_trip(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").limit(30)
    responses = {r.record_id: r for r in W.responses_of(pages).collect()}
    records = W.derivatives(W.responses_of(pages)).collect()
    assert len({r.record_id for r in records}) == 2 * len(responses)
    for r in records:
        source = responses[r.refers_to]
        payload = source.block.split(b"\r\n\r\n", 1)[1]
        assert r.payload_digest == source.payload_digest == "sha1:" + hashlib.sha1(payload).hexdigest()
        assert r.block_digest == "sha1:" + hashlib.sha1(r.block).hexdigest() and r.content_length == len(r.block)
        assert [tuple(h) for h in r.headers] == [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}>", r.record_id)
    meta = {r.refers_to: r for r in records if r.warc_type == "metadata"}
    for r in records:
        if r.warc_type == "conversion":
            assert f"derived-conversion: {r.record_id}\r\n".encode() in meta[r.refers_to].block
    data = b"".join(W.record_bytes(r.asDict()) for r in records)
    back = W.parse_records(data)
    assert [(f["WARC-Record-ID"], f["WARC-Refers-To"], b) for f, b in back] == [(r.record_id, r.refers_to, bytes(r.block)) for r in records]
    assert W.serialised(W.derivatives(W.responses_of(pages))).count() == len(records)


def host_pages():
    menu = "<div class=a><p>Start of the menu</p><p>All rights are ours</p></div>"
    rows = [(i, "http://large/" + str(i), f"<body>{menu}<div class=b><p>Own text {i}</p></div></body>") for i in range(66)]
    rows.append((66, "http://large/66", "<body><table><tr><td>Another layout</td></tr></table></body>"))
    copies = [(100 + i, "http://copies/" + str(i), "<body><p>The same page</p></body>") for i in range(9)]
    return rows + copies


def test_all_pages_of_a_host_count(spark, monkeypatch):
    rows = host_pages()
    wanted = {i: "The same page" if i >= 100 else "Another layout" if i == 66 else f"Own text {i}" for i, _, _ in rows}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert {r.page_id: r.text for r in P.extract_pages(df).collect()} == wanted
    assert texts([h for _, u, h in rows if "large" in u]) == [wanted[i] for i in range(67)]
    monkeypatch.setattr(P, "SENT_ROWS", 0)
    monkeypatch.setattr(P, "COUNTED", 10)
    got = P.extract_pages(df, group_pages=2).collect()
    assert {r.page_id: r.text for r in got} == wanted and len({r.template for r in got}) == 2


def test_template_text_inside_the_article_is_left_out():
    tail = "<div class=about><p>About the author</p></div><p>Give us money</p>"
    pages = [f"<article><h1>Title {i}</h1><p>Own text {i}</p>{tail}</article>" for i in range(5)]
    pages.append("<div><p>Plain text beside it</p></div><article><div class=about><p>About the author</p></div></article>")
    assert texts(pages) == [f"Title {i}\nOwn text {i}" for i in range(5)] + ["Plain text beside it"]


def test_text_between_own_blocks_belongs_to_the_article():
    pages = [f"<article><h1>Title {i}</h1><h2>Summary</h2><p>Own text {i}</p><h2>Details</h2><p>More of {i}</p></article>" for i in range(4)]
    assert texts(pages) == [f"Title {i}\nSummary\nOwn text {i}\nDetails\nMore of {i}" for i in range(4)]


def test_an_article_with_several_addresses_is_kept():
    article = "<article><h1>The title</h1><p>The whole text of it, some words long.</p></article>"
    pages = [f"<div>visit {i}</div>{article}" for i in range(4)]
    assert texts(pages) == ["The title\nThe whole text of it, some words long."] * 4


def test_names_of_wrappers_do_not_lose_the_article():
    article = "<article><p>Own text</p><div class=sidebar>Side</div></article>"
    for page in (
        f'<div class="layout has-sidebar">{article}</div>',
        f'<div id="content" class="with-comments noSidebar">{article}</div>',
        f'<div class="sidebar-left">{article}<p>Below it</p></div>',
        '<article class="post social"><p>Own text</p><p class="share">Share</p></article>',
        '<div class="promo"><div role="main">Own text</div></div>',
        '<div class="social wrapper"><p>Own text</p><div class="sidebar">Side</div></div>',
        f'{article}<div class="related"><article><p>Another title</p></article></div>',
        f'{article}<article class="comment"><p>A comment that is longer than the article it is about</p></article>',
    ):
        assert texts([page]) == ["Own text"], page
    assert texts(["<p>Own text of the page</p><div class=related>Other</div><div class=no-js><p>More</p></div>"]) == ["Own text of the page\nMore"]


def test_http_blocks():
    block = b"HTTP/1.1 200 OK\r\nX-A: 1\r\nX-A: 2\r\nX-B: long\r\n  folded\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>\xe9</p>"
    status, headers, payload = W.split_http(block)
    assert status == "HTTP/1.1 200 OK" and headers[:3] == [("X-A", "1"), ("X-A", "2"), ("X-B", "long folded")]
    got = W._read_blocks([block, None, b"<p>no head</p>", b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=nonsense\r\n\r\n<title>t</title><p>x<br>y"])
    assert got["text"].tolist() == ["é", "", "no head", "x\ny"]
    assert payload == b"<p>\xe9</p>"
