import html
import re

import pytest
from helpers import rows

from hourgrid.llm import extraction, queries

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body class="home">
<div id="cookie-notice">We use cookies <b>ok</b></div><header><h1>Site</h1></header><div class="menu"><ul><li><a href=x>Home</a></li></ul></div>
<div class="layout"><div class="content"><h2>Real  title</h2><p>First para with <a href=q>a link</a> in it &amp; more&nbsp;text&#33;</p>
<div class="ad-box">BUY NOW</div><p>Second para
 goes<br>on &lt;here&gt;.</p><ul><li>item one</li><li><a href=z>item two</a></li></ul><blockquote>Quoted</blockquote><p>End.</p></div>
<div class=sidebar><p>Side text is long here, really long text that goes on and on and on and on and on and on</p></div>
<section id="comments"><article class="comment"><p>I liked it a lot, this is a reader comment</p></article></section></div>
<form><p>Your name</p><textarea>x</textarea></form><footer>c</footer></body></html>"""


def test_a_page_without_article():
    assert extraction.main_text(PAGE) == "\n".join([
        "Real title", "First para with a link in it & more text!", "Second para goes on <here>.", "item one", "item two", "Quoted", "End."])


def test_an_article_before_longer_text():
    long = "<div><p>" + "elsewhere " * 50 + "</p></div>"
    page = f"<body>{long}<article><header><h1>Head</h1></header><p>Short.</p><aside>no</aside><p>x</p><p>y</p><nav>a</nav><p>z</p></article>{long}</body>"
    assert extraction.main_text(page) == "Short.\nx\ny\nz" or extraction.main_text(page) == "Head\nShort.\nx\ny\nz"


LINKS = "<ul>" + "".join(f"<li><a href=x{i}>link {i}</a></li>" for i in range(5)) + "</ul>"
LINKED = "\n".join(f"link {i}" for i in range(5))


@pytest.mark.parametrize(("page", "text"), [
    ("<article><h1><a href=x>Head</a></h1><p>one</p></article>", "Head\none"),
    (f"<article><p>one</p>{LINKS}<p>two, longer</p></article>", f"one\n{LINKED}\ntwo, longer"),
    (f"<article><p>one</p>{LINKS}</article>", f"one\n{LINKED}"),
    (f"<main>{LINKS}</main><div><p>{'else ' * 50}</p></div>", LINKED),
    (f"<article><p>one</p>{LINKS}<div class=ad>x</div>{LINKS}<p>two</p></article>", f"one\n{LINKED}\n{LINKED}\ntwo"),
    ("<article><p>first</p></article><div><p>between</p></div><article><p>second, longer</p></article>", "first\nsecond, longer"),
    ("<article><p>first</p></article><article><p>second</p></article>", "first\nsecond"),
    (f"<div><p>kept</p></div>{LINKS}<div><p>menu</p></div>", "kept"),
])
def test_articles_are_kept_whole(page, text):
    assert extraction.main_text(f"<html><body>{page}</body></html>") == text


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("   ", ""), ("plain text", "plain text"), ("a < b &amp c", "a < b & c"), ("<p>a<p>b<script>x", "a\nb"), ("<!-- x -->y<!-- z", "y"),
    ("<p title='a > b'>c</p>", "c"), ("<p title=\"x>y</p>", "y"), ("<nav>only menu</nav>", ""), ("<p>&lt;b&gt;</p>", "<b>"),
    ("<article><p>one</p>", "one"), ("<nav><ul><li>m</li></ul><article><p>kept</p></article>", "kept"), ("<P>A</P><DIV>B</DIV>", "A\nB"),
    ("<table><tr><td>1</td><td>2</td></tr></table>", "1\n2"), ("<p>\x00é\U0001f600</p>", "\x00é\U0001f600"),
])
def test_small_pages(page, text):
    assert extraction.main_text(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ('<article><p class="ad">x<p>text one</p><p>text two</p></article>', "text one\ntext two"),
    ('<article><p>one</p><ul><li class="share">x<li>two<li>three</ul><p>four</p></article>', "one\ntwo\nthree\nfour"),
    ('<article><ul><li>one<li class="share">x<ul><li>x</ul></ul><p>two</p></article>', "one\ntwo"),
    ('<article><p>one</p><div class="ad">x</article><article><p>two</p></article>', "one\ntwo"),
    ('<article><div><p>one</p><div class="ad"><p>x<div>x</div>x</div></div><p>two</p></article>', "one\ntwo"),
    ('<article><div><span class="promo">x</div><p>one</p></article>', "one"),
    ('<article><dl><dt>a<dd class="share">x<dt>b<dd>c</dl></article>', "a\nb\nc"),
    ('<article><table><tr><td class="ad">x<td>a<tr class="ad"><td>x<tr><td>b</table><p>c</p></article>', "a\nb\nc"),
    ('<article><div><table><tr><td class="ad">x</div>x</td><td>a</td></tr></table></div></article>', "a"),
    ('<article><p class="ad">x<b>x</b><br>x<h2>one</h2><p>two</article>', "one\ntwo"),
    ('<article><form><select><option>x</select></form><p>one</p></article>', "one"),
    ('<div><article><p>one</p></div><p class="ad">x</article><p>out</p>', "one"),
    ("<head><title>t</title><meta name=a><p>one</p>", "one"),
])
def test_elements_without_end_tag(page, text):
    assert extraction.main_text(page) == text


PROSE = "This is a line of plain prose that goes on for a while. " * 4
OTHER = "Some other text that stands beside it for as long as this. " * 4


@pytest.mark.parametrize("page", [
    '<article class="post comments-open"><p>{}</p></article>', '<body class="single showing-comments"><p>{}</p></body>',
    '<article><div class="long-form"><p>{}</p></div></article>', '<article><section id="related-work"><p>{}</p></section></article>',
    '<article><section id="search-algorithms"><p>{}</p></section></article>', '<body class="has-sidebar"><div class="page"><p>{}</p></div></body>',
    '<div class="content-sidebar"><article><p>{}</p></article><div class="sidebar"><p>x</p></div></div>', '<main class="sidebar"><p>{}</p></main>',
    '<div class="widget"><p>{}</p></div><div><p>short</p></div>', '<div class="modal"><div class="popup"><article><p>{}</p></article></div></div>',
    '<article><h2 id="registering-forms">{}</h2></article>', '<html class="no-js menu-open"><p>{}</p></html>', '<div id="form-of-government"><p>{}</p></div>',
])
def test_names_do_not_cost_a_page_its_text(page):
    assert PROSE.strip() in extraction.main_text(page.format(PROSE)).split("\n")


@pytest.mark.parametrize("aside", [
    '<div class="comments-area"><p>{}</p></div>', '<section id="comments"><article class="comment"><p>{}</p></article></section>', '<article class="comment depth-1"><p>{}</p></article>',
    '<div class="related-posts"><p>{}</p></div>', '<div id="cookieNotice"><p>{}</p></div>', '<div class="share-bar"><p>{}</p></div>', '<div class="post-comments"><p>{}</p></div>',
    '<aside><p>{}</p></aside>', '<div role="complementary"><p>{}</p></div>', '<div class="newsletter_signup"><p>{}</p></div>', '<ul class="comment-list"><li>{}</li></ul>', '<div class="ad"><p>{}</p></div>',
    '<div class="ad-slot-3"><p>{}</p></div>', '<div class="social-links"><p>{}</p></div>', '<p class="promo">{}</p>', '<span class="promo">{}</span>', '<div hidden><p>{}</p></div>', '<div class="x widget y"><p>{}</p></div>',
])
def test_what_stands_beside_the_text_goes(aside):
    inside = f"<article><p>{PROSE}</p>{aside.format(OTHER)}<p>{PROSE}</p></article>"
    beside = f"<div><p>{PROSE}</p><p>{PROSE}</p></div>{aside.format(OTHER)}"
    for page in (inside, beside):
        assert extraction.main_text(f"<html><body>{page}</body></html>") == f"{PROSE.strip()}\n{PROSE.strip()}"


@pytest.mark.parametrize("page", [
    "<article><p>{}</p><div class=comments>{}</div></article>", "<main><p>{}</p></main><section id=comments><article>{}</article></section>",
    "<div><p>{}</p></div><div class=comments>{}</div>", "<article><p>{}</p></article><div class=related-posts><article>{}</article></div>",
])
def test_long_comments_do_not_come_back(page):
    assert extraction.main_text(page.format(PROSE, f"<p>{OTHER}</p>" * 5)) == PROSE.strip()


def test_dense_stretches_stay_without_article():
    links = "".join(f"<p><a href=x{i}>a link to something else</a></p>" for i in range(3))
    assert extraction.main_text(f"<div><p>{PROSE}</p>{links}<p>{PROSE}</p>{links}<p>short</p></div>") == f"{PROSE.strip()}\n{PROSE.strip()}"


def test_nested_names_take_time_in_proportion():
    text = extraction.main_text("<div class=ad>" * 20_000 + f"<p>{PROSE}</p>" + "</div>" * 20_000)
    assert text == PROSE.strip()


def test_open_elements_take_time_in_proportion():
    assert extraction.main_text("<article><div><p><button>" + "<x>" * 50_000 + "<hr></div></p>" * 50_000 + "</article><p>y</p>") == "y"
    assert extraction.main_text('<article><div class="ad">' + "<p>" * 100_000 + "</div><p>z</article>") == "z"


def test_long_pages_take_time_in_proportion():
    assert len(extraction.main_text("<p>" + "word " * 300_000 + "</p>")) == 300_000 * 5 - 1
    assert extraction.main_text("<div>" * 50_000 + "x" + "</div>" * 50_000) == "x"
    assert extraction.main_text("<" * 20_000).startswith("<")


def test_edge_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "t", 1), (1, "u", "<p>é</p>", "t", 1), (None, "u", "", None, None)], "page_id long, url string, html string, text string, n_chars int")
    assert rows(extraction.extracted(pages)) == [(1, "u", "é", 1), (1, None, "", 0), (None, "u", "", 0)]
    assert extraction.extracted(pages.limit(0)).columns == ["page_id", "url", "text", "n_chars"]


def test_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    want = []
    for p in pages:
        article = re.search("<article>(.*)</article>", p.html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(b for b in blocks if b)
        want.append((p.page_id, p.url, text, len(text)))
    assert rows(queries.op3_html(spark, sf_dir)) == sorted(want)
