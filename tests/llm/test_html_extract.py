import re
from html.parser import HTMLParser

import pytest

from tessera.llm.html_extract import extract, main_text

SF = "/root/testdata/sf0.001"


class Inside(HTMLParser):
    """All text of the article element, cut at p, h1 and br."""

    def __init__(self):
        super().__init__()
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.out.append("\0" if tag in ("p", "h1", "br") else "")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.out.append("\0" if tag in ("p", "h1") else "")

    def handle_data(self, data):
        if self.depth:
            self.out.append(data)


def test_given_pages(spark):
    for r in extract(spark.read.parquet(f"{SF}/pages.parquet")).join(
            spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        p = Inside()
        p.feed(r.html)
        blocks = [re.sub(r"\s+", " ", b).strip() for b in "".join(p.out).split("\0")]
        assert r.text == " ".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("  \n", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>One&nbsp;two<p>three", "One two three"),
    ("<body><nav>m</nav><div id=main><p>A long paragraph, with commas, and text.</p><p>More, of it.</p></div>"
     "<div class='sidebar'><p>Side, side, side, side, side, side.</p></div><footer>f</footer>",
     "A long paragraph, with commas, and text. More, of it."),
    ("<article><h1>T</h1><p>x <b>y</b>z<script>1<2</script></p><ul><li>i<li>j</ul><form><p>f</p></form>"
     "<section class='comments'><p>c, c, c</p></section></article>", "T x yz i j"),
    ("<div class='cookie-notice'>We use cookies</div><main><p>Body</p><aside>no</aside><pre>a\n b</pre></main>", "Body a b"),
    ("<article><p>a &lt;b&gt; &#233; &eacute; &#x41;</p><!-- <p>no</p> --></article>", "a <b> é é A"),
    ("<article><p>q < r and s > t</p></article>", "q < r and s > t"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table><div style='display:none'>h</div></article>", "1 2 3"),
    ("<article><p>" + "word " * 50_000 + "</p></article>", ("word " * 50_000).strip()),
    ("<div><a href=x>link one</a><a href=y>link two</a></div><div><p>Text that is longer, much longer.</p></div>",
     "Text that is longer, much longer."),
])
def test_cases(page, want):
    assert main_text(page) == want


LONG = "A paragraph of the article, with commas, and enough words to read like text."


@pytest.mark.parametrize("page, want", [
    # link text counts however deep it stands
    (f"<body><div><p>{LONG}</p><p>{LONG}</p></div><ul>" + "".join(
        f"<li><a href=x><span><b><i><em>Related story {i}, with a title</em></i></b></span></a></li>" for i in range(5)) + "</ul></body>",
     f"{LONG} {LONG}"),
    # a quote left open ends with its tag
    ('<article><p>x <a href="foo>bar</a> y</p><p class="c">z</p></article>', "x bar y z"),
    ('<article><p>x <a href="foo>bar</a> said "hello" to</p></article>', 'x bar said "hello" to'),
    ("<article><p title=it's>It's a 'quoted' word</p></article>", "It's a 'quoted' word"),
    ('<article><p title="a > b">x</p><p title="a < b" class=c>y</p></article>', "x y"),
    ("<article><p>x <b y <i>z</i></p></article>", "x z"),
    # a word of class or id decides alone only if no other word stands beside it
    (f"<article><p>{LONG}</p><p class='share-price'>Shares rose.</p><section id='login-guide'><p>How to log in.</p></section>"
     f"<div class='comment-free'>No remarks.</div></article>", f"{LONG} Shares rose. How to log in. No remarks."),
    (f"<article><p>{LONG}</p><div class='share-buttons'>Share it</div><div class='post-comments'><p>First, I say, no</p></div>"
     f"<div id='sidebar-left'>Side</div></article>", LONG),
    (f"<article><p>{LONG}</p><div class='share-price'><a href=x>Price list</a> <a href=y>Orders</a></div></article>", LONG),
    (f"<body><div class='cookie-policy-hint'>We use cookies, many.</div><div><p>{LONG}</p></div></body>", LONG),
])
def test_broken_and_doubtful_markup(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "x", "<b>" * 200_000 + "x", '<b "' * 150_000, "<b '" * 150_000, "<b " * 200_000, "<p>" + "<i>a</i>" * 80_000,
    "<div>a" * 60_000, "<ul>" + "<li><div>" * 60_000, "<a href=\"" + "x<y>" * 150_000, "</p>" * 150_000, "<!-- " * 120_000,
    "<div class='share-price'>a" * 25_000, "&amp" * 150_000, "<" * 600_000, "<td>" * 150_000, "<p 'a\"b>" * 60_000])
def test_time_grows_with_the_page(page):
    import time
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 12


def test_rows(spark):
    cols = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", "<p>a</p>", "x", "y")] * 2 + [(None, None, None, None, None)]
    got = extract(spark.createDataFrame(rows, cols)).collect()
    assert sorted(map(tuple, got), key=str) == [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]
    assert extract(spark.createDataFrame([], cols)).count() == 0


P = "Some text, with commas, that goes on, " + "and on " * 23 + "to its end."


@pytest.mark.parametrize("page, want", [
    (f"<div id=content><section><h2>A</h2><p>{P}</p></section><section><h2>B</h2><p>{P}</p></section></div>", f"A {P} B {P}"),
    (f"<body><div id=content><div><p>{P}</p></div><div><p>{P} {P}</p></div><div><p>Short.</p></div></div><div><a href=x>one two three</a></div>",
     f"{P} {P} {P} Short."),
    (f"<main><h1>Head</h1><article><p>{P}</p></article><article><p>Second, short.</p></article></main>", f"Head {P} Second, short."),
    (f"<div id=content><div><div><section><p>{P} {P}</p></section><section><p>{P}</p></section></div></div><section><p>Last.</p></section></div>",
     f"{P} {P} {P} Last."),
    (f"<body>{P}<br><br>{P} {P}<div>Small.</div></body>", f"{P} {P} {P} Small."),
])
def test_text_in_several_containers(page, want):
    assert main_text(page) == want
