import re

from vellum.llm.html import extract, main_text, style_tree

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad <p>no</p> --><div class="ad">Buy</div><header>Site</header>
<article><h1>Head &amp; more</h1><p><b>One  two.<br>three<p>Four &lt;five&gt; &eacute;</p><ul><li>a<li>b</ul>
<aside>aside</aside><form><p>in form</p></form><section class="comments"><p>reader</p></section>loose <i>text</i></article>
<footer>&copy; F</footer></body></html>"""


def test_article_only():
    assert main_text(PAGE) == "Head & more\n\nOne two. three\n\nFour <five> é\n\na\n\nb\n\nloose text"


def test_malformed():
    assert main_text("") == ""
    assert main_text("plain & text") == "plain & text"
    assert main_text("<p>a < b <p>c</div></p></article>d") == "a < b\n\nc\n\nd"
    assert main_text("<article><p>x</p><script>never closed <p>y") == "x"
    assert main_text('<p>ok</p><a href="unclosed>z') != ""
    assert main_text("<div>" * 3000 + "deep") == "deep"


def test_whole_pages_of_the_test_data(spark):
    sf = "/root/testdata/sf0.01"
    rows = extract(spark.read.parquet(f"{sf}/pages.parquet")).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    import html

    assert len(rows) == 250
    for r in rows:
        inner = source[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?p>|</?h1>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def soup(i, words):
    return f'<html><body><div class="top"><p>Home</p><p>About us</p></div><div class="body"><p>{words}</p><p>Shared line</p></div><div class="end"><p>All rights reserved</p></div></body></html>'


def test_style_tree_removes_what_pages_share(spark):
    rows = [(i, f"http://Site.example/{i}?q", soup(i, f"story number {i} about {i * 7}"), "x") for i in range(12)]
    rows += [(100, "http://other.example/", soup(0, "alone"), "x"), (101, None, soup(0, "no host"), "x"), (102, "http://[bad", None, "x"), (None, "", "", "x"), (0, rows[0][1], rows[0][2], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {}
    for r in extract(df).collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[3] == ["story number 3 about 21\n\nShared line"] and len(got[0]) == 2
    assert got[100][0].startswith("Home") and got[101][0].startswith("Home")
    assert got[102] == [""] and got[None] == [""]
    tree = style_tree(df).collect()
    assert min(r.importance for r in tree) < 0.11 and max(r.importance for r in tree) <= 1.0 + 1e-9
    assert extract(df.limit(0)).collect() == []


def test_names_of_wrappers_and_article_headers_are_no_verdict():
    wrapped = '<body><div id="page" class="layout no-sidebar has-comments"><div class="search sidebar"><article><header class="entry-header"><h1>Title</h1></header><p>Body</p></article></div><div class="related"><article>Teaser</article></div></div></body>'
    assert main_text(wrapped) == "Title\n\nBody"
    assert main_text('<div class="sidebar"><p>' + "the whole page " * 9 + '</p></div><div class="menu">Menu</div>') == ("the whole page " * 9).strip()


def test_the_style_tree_judges_named_blocks_and_those_inside_and_outside_the_article(spark):
    def page(i):
        own = f"word{i} and {i * 7}"
        return f"""<body><div class="widget">Follow us</div><div><p>lead {own}</p></div><div class="ad">buy {own}</div><article><div><p>Subscribe now</p></div>
        <section><p>text {own}</p></section><div class="notice"><p>errata {own}</p></div><div class="share">Share this</div><div class="comments">reader {own}</div></article></body>"""

    df = spark.createDataFrame([(i, f"http://site.example/{i}", page(i)) for i in range(12)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract(df).collect()}
    assert got == {i: "\n\n".join(f"{k} word{i} and {i * 7}" for k in ("lead", "text", "errata")) for i in range(12)}


def test_what_the_contract_keeps_and_drops_inside_an_article():
    assert main_text('<article><h2 id="search">Search trees</h2><p>One.</p></article>') == "Search trees\n\nOne."
    assert main_text('<article><p>One.</p><section class="related work"><h2>Related work</h2><p>Two, as <a href="#1">they</a> say.</p></section></article>') == "One.\n\nRelated work\n\nTwo, as they say."
    assert main_text('<article><p>One.</p><ul class="related"><li><a href="/1">Other page</a></li></ul></article>') == "One."
    assert main_text('<article><p>Hello <button>Subscribe now</button> there <span class="ad">Buy this</span></p></article>') == "Hello there"
    assert main_text('<article><p>a <b class="term">b</b> <i>c</i></p></article>') == "a b c"


def test_the_tree_alone_finds_unnamed_noise_on_few_and_on_many_pages(spark):
    def page(i):
        return f"<body><div><p>Home</p><p>About us</p></div><div><div><h2>Title {i}</h2><p>story {i} about {i * 7}</p><p>more of it {i}</p><p class='x'>Read <span class='k'>our app</span> too</p></div></div></body>"

    for n in (1, 3, 40):
        df = spark.createDataFrame([(i, f"http://s{n}.example/{i}", page(i)) for i in range(n)], "page_id long, url string, html string")
        with_tree, without = ({r.page_id: r.text for r in extract(df, noise).collect()} for noise in (0.3, 0.0))
        assert all("Read our app too" in t for t in without.values())
        if n > 1:
            assert with_tree == {i: f"Title {i}\n\nstory {i} about {i * 7}\n\nmore of it {i}" for i in range(n)}
        else:
            assert with_tree == without


def test_equal_pages_count_as_one(spark):
    html = "<body><article><p>only words here</p><p>and more</p></article></body>"
    df = spark.createDataFrame([(i, f"http://same.example/{i}", html) for i in range(9)], "page_id long, url string, html string")
    assert {r.text for r in extract(df).collect()} == {"only words here\n\nand more"}
