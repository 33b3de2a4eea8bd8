import re
import time

import pytest
from conftest import SMALL

from docloom.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="single"><header>Site <b>name</b></header><nav><ul><li><a href="/x">menu</a></li></ul></nav>
<!-- <p>no</p> --><div class='ad'>buy <div>more</div> now</div><article><header><h1>Head &amp; title</h1></header>
<p><b>one <i>two</i>
 three.<br><p>caf&eacute; &#233; &lt;x&gt; 1 < 2</p><aside>side</aside><form><input name="q">ask</form>
<section id="comments"><p>first!</p><section>nested</section></section><p title="a > b">last</p></article>
<div class="cookie-notice">we use cookies</div><footer>&copy; host</footer></body></html>"""


def test_one_page():
    assert html_text.article_text(PAGE) == "Head & title\none two three.\ncafé é <x> 1 < 2\nlast"


@pytest.mark.parametrize("page", ["", "<", "<p", "<article", "a<article>b", "<nav><article>b", "<script><article>b", '<p class="x><article>b', "<!-- x", "</p></article>"])
def test_broken_pages(page):
    html_text.article_text(page)


def test_missing_end_tags():
    assert html_text.article_text("<nav>menu<article>text<p>more") == "text\nmore"


def test_table(spark):
    df = spark.read.parquet(f"{SMALL}/pages.parquet")
    pages = {r.page_id: r.html for r in df.collect()}
    got = {r.page_id: r for r in html_text.main_text(df).collect()}
    assert set(got) == set(pages)
    for i, r in got.items():
        inner = re.search(r"<article>(.*)</article>", pages[i], re.S)[1]
        lines = [html_text.html.unescape(re.sub("<[^>]*>", "", x)).strip() for x in re.split(r"<(?:/?p|br|/?h1)>", inner)]
        assert r.text == "\n".join(x for x in lines if x)
        assert r.n_chars == len(r.text)


def test_repeated_runs_of_a_host_are_boilerplate(spark):
    menu = "home news sports weather about contact"
    foot = "all rights reserved by the owner of this small site since long ago"
    rows = [(i, f"http://h.example/{i}", f"<div>{menu}</div><p>unique text number {i} of page {i * 7}</p><div>{foot} {i}</div>") for i in range(5)]
    rows += [(9, "http://other.example/", f"<div>{menu}</div><p>alone</p>"), (10, None, None), (10, None, None), (11, None, "<p>x</p>"), (None, "http://h.example", ""), (12, "http://h.example/12", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((str(r.page_id), r.text) for r in html_text.main_text(df).collect()))
    expected = [(str(i), f"unique text number {i} of page {i * 7}\n{i}") for i in range(5)]
    expected += [("9", f"{menu}\nalone"), ("10", ""), ("10", ""), ("11", "x"), ("None", ""), ("12", "")]
    assert got == sorted(expected)
    assert html_text.main_text(df.limit(0)).collect() == []


def test_the_host_decides_on_pages_with_marks_too(spark):
    menu = "home news sports weather about contact"
    rows = [(i, f"http://h.example/{i}", f"<div>{menu}</div><p>lead {i}</p><article><p>own {i}</p></article><!-- ad {i} -->") for i in range(4)]
    rows += [
        (10, "http://a.example/", "<aside><article>teaser</article></aside><div>body</div>"),
        (11, "http://b.example/", "<!-- <main> --><script>x='<article>'</script><p>body</p>"),
        (12, "http://c.example/", "<nav>menu<article>text</article><nav>foot</nav>"),
        (13, "http://d.example/", '<p data-role="main">one</p><div role="main">two</div>'),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    expected = {i: f"lead {i}\nown {i}" for i in range(4)}
    assert got == expected | {10: "body", 11: "body", 12: "text", 13: "one\ntwo"}


def test_copies_quotations_and_rare_headings_stay(spark):
    article = " ".join(f"a{i}" for i in range(40))
    quote = " ".join(f"q{i}" for i in range(14))
    menu = "home news sports weather about contact"
    rows = [(i, f"http://h.example/{i}", f"<div>{menu}</div><p>{article}</p>") for i in range(4)]
    rows += [(i, f"http://h.example/{i}", f"<div>{menu}</div><h2>Introduction</h2><p>own{i} says {quote} " + " ".join(f"w{i}_{k}" for k in range(30)) + "</p>") for i in (10, 11)]
    rows += [(i, f"http://h.example/{i}", f"<div>{menu}</div><p>page {i}</p>") for i in range(20, 26)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    assert all(got[i] == article for i in range(4))
    assert all(got[i] == f"Introduction\nown{i} says {quote} " + " ".join(f"w{i}_{k}" for k in range(30)) for i in (10, 11))
    assert all(got[i] == f"page {i}" for i in range(20, 26))


@pytest.mark.parametrize(
    "page, text",
    [
        ('<div class="layout has-sidebar"><article><p>text</p></article><div class="sidebar">s</div></div>', "text"),
        ('<form id="aspnetForm"><nav>m</nav><article><p>text</p></article><input><button>go</button></form>', "text"),
        ('<div class="search-results"><main><p>text</p></main></div>', "text"),
        ('<div class="page-with-sidebar"><p>text</p></div>', "text"),
        ('<div class="sidebar"><article><p>text</p></article></div>', "text"),
        ('<div class="right-sidebar"><p>all of the text</p><div class="ad">buy</div></div>', "all of the text"),
        ('<article><section class="related-work"><p>a</p></section><h2 id="search">b</h2><p id="comments-on-method">c</p></article>', "a\nb\nc"),
        ('<article><p>a</p><pre>x <span class="comment"># y</span></pre></article><div id="comments"><article>first, and much longer than the text</article></div>', "a\nx # y"),
        ('<main><p>text</p><div class="related"><article>t</article></div></main>', "text"),
        ('<article><p>long enough text</p><div class="ad">buy<p>now</article><p>after</p>', "long enough text\nafter"),
        ('<div class="main-nav"><div>m</div></div><p>text of the page</p><div class="post-comments">me<div>too</div></div><p>end</p>', "text of the page\nend"),
        ('<div class="cookie-notice">c</div><form>ask<p>me</p></form><p>text of the page</p>', "text of the page"),
    ],
)
def test_names_are_evidence_only(page, text):
    assert "\n".join(b.text for b in html_text.blocks(page) if not b.noise) == text


def test_headings_that_many_pages_share_stay(spark):
    menu = "<div>home</div><div>recipes</div><div>contact us</div>"
    foot = "<div>imprint</div>"
    rows = [
        (i, f"http://h.example/{i}", f"{menu}<h1>Dish {i}</h1><h2>Ingredients</h2><p>salt{i} oil{i}</p><h2>Method</h2><p>stir it {i} times</p>{foot}")
        for i in range(6)
    ]
    # a menu in the middle of the page is a long run across blocks
    links = "".join(f"<li>link {k} to page</li>" for k in range(8))
    rows += [(i, f"http://m.example/{i}", f"<p>first {i}</p><ul>{links}</ul><h2>Notes</h2><p>second {i}</p>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(r.text for r in html_text.main_text(df).collect())
    expected = [f"Dish {i}\nIngredients\nsalt{i} oil{i}\nMethod\nstir it {i} times" for i in range(6)]
    assert got == sorted(expected + [f"first {i}\nNotes\nsecond {i}" for i in range(6)])


def test_pages_without_marks_give_the_text_of_marked_ones(spark):
    """Tags and names taken away, the host's runs alone find nearly the same text."""
    menu = "".join(f"<li>section {k}</li>" for k in range(8))
    foot = " ".join(f"legal{k}" for k in range(30))
    marked, bare = [], []
    for i in range(30):
        body = "".join(f"<p>{' '.join(f'w{i * 7 + k * 3 + j}' for j in range(25))}</p>" for k in range(4))
        url = f"http://h.example/{i}"
        marked.append((i, url, f'<nav><ul>{menu}</ul></nav><article><h1>Title {i}</h1>{body}</article><footer><p>{foot}</p></footer>'))
        bare.append((i, url, f"<ul>{menu}</ul><h1>Title {i}</h1>{body}<p>{foot}</p>"))
    schema = "page_id long, url string, html string"
    one, other = ({r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, schema)).collect()} for rows in (marked, bare))
    right = sum(one[i] == other[i] for i in one)
    assert right == len(one)


def test_long_pages_and_extra_columns(spark):
    page = "<nav>a<article>b" * 20_000
    start = time.process_time()
    html_text.blocks(page)
    html_text.blocks("<div class='ad'>x" * 20_000 + "</div>" * 20_000)
    assert time.process_time() - start < 10
    long = "<article>" + "<p>word &amp; more</p>" * 30_000 + "</article>"
    df = spark.createDataFrame([(1, "http://a/", long, "x", "y")], "page_id long, url string, html string, host string, blocks string")
    (row,) = html_text.main_text(df).collect()
    assert row.text == "\n".join(["word & more"] * 30_000) and row.n_chars == len(row.text)
