"""HTML extraction against the article of the sample pages and hand-made pages."""

import html
import re

import pytest
from pyspark.sql import functions as F

from seriesframe.llm.html_extraction import Page, extract
from seriesframe.llm.queries import QUERIES


def article(source):
    """Brute force for pages of the sample's shape: blocks of the article element."""
    inner = re.search(r"<article>(.*)</article>", source or "", re.S)
    if not inner:
        return ""
    blocks = re.split(r"</?(?:p|h1)>", inner[1])
    lines = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_query(spark, sf_dir):
    sources = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op10_html_extraction"](spark, sf_dir).collect()
    assert len(got) == len(sources)
    for r in got:
        assert r.url == sources[r.page_id].url
        assert r.text == article(sources[r.page_id].html)
        assert r.n_chars == len(r.text) > 0


def text(source):
    page = Page(source)
    return "\n".join(b[0] for b in page.blocks if b[1] == page.place)


@pytest.mark.parametrize(
    "source, want",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b &lt;i&gt;<br>c</p>d", "a\nb <i> c\nd"),
        ("<body><nav><ul><li>x</ul></nav><p>text</body>", "text"),
        ("<main><p>m</main><p>out", "m"),
        ("<header>site</header><article><header><h1>T</h1></header><p>x</article><footer>f", "T\nx"),
        ("<article><p>x</p><div class='post-comments'><p>hi</p></div><aside>s</aside><p>y</p></article>", "x\ny"),
        ('<article><p>x<span class="ad">buy <span>now</span> ok</span> z</p></article>', "x z"),
        ("<script>var a = '<p>no</p>';</script><style>p{}</style><p>yes<!-- <p>no --> now<!-- open", "yes now"),
        ("<p>one<script>never closed <p>x", "one"),
        ('<p title="a > b" class=x>quoted</p><a href="unclosed>still', "quoted\nstill"),
        ("<div id=cookie-notice>ok?</div><form><p>f</form><p>p&nbsp;&copy;&#233;&unknown; &am", "p ©é&unknown; &am"),
        ("<table><tr><td>a<td>b<tr><td>c</table>after", "a b\nc\nafter"),
        ("<ul><li>a<li>b</ul>", "a\nb"),
        ("<b>x<p>y</b>z</p>", "x\nyz"),
        ("</div></p>stray < 5 <3 x<", "stray < 5 <3 x<"),
        ("<P>UP\n\t per</P><IMG src=x>case", "UP per\ncase"),
        ("<article></article><p>not this", ""),
        ("<div>" * 3000 + "deep", "deep"),
    ],
)
def test_pages(source, want):
    assert text(source) == want


def test_template_removal(spark):
    rows = [(i, f"https://big.example/{i}", f"<body><div>Shop hours and offers</div><div><p>story {i}</p></div><p>All rights</p>") for i in range(40)]
    rows += [(100 + i, f"https://other.example/{i}", "<body><div>Shop hours and offers</div><p>tale</p>") for i in range(3)]
    rows += [(200 + i, f"//wrap.example/{i}", f"<article><p>same line</p><div>Join us today</div><p>part {i}</p></article>") for i in range(30)]
    rows += [(300, None, None), (301, None, ""), (0, "https://big.example/0", rows[0][2]), (None, "x", "<p>no id")]
    pages = spark.createDataFrame(
        [(*r, "t", "h", 1) for r in rows], "page_id long, url string, html string, text string, hash string, host int"
    ).repartition(5)
    got = extract(pages).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert all(by[i] == f"story {i}" for i in range(40))
    assert all(by[100 + i] == "Shop hours and offers\ntale" for i in range(3))
    assert all(by[200 + i] == f"same line\npart {i}" for i in range(30))
    assert by[300] == by[301] == "" and by[None] == "no id"
    assert extract(pages.filter("false")).count() == 0


@pytest.mark.parametrize(
    "source, want",
    [
        ("<main class='content with-sidebar'><p>a</main>", "a"),
        ("<article class='post category-social'><p>a</article>", "a"),
        ("<article class='post social'><p>a</article>", "a"),
        ("<div class='no-sidebar has-navbar comments-open search-result ad-free'><p>a</div>", "a"),
        ("<div class='sidebar'><main><p>a</main></div><p>b", "a"),
        ("<div class='popup'><article><header>H</header><p>a</article></div><nav>x</nav>", "H\na"),
        ("<article>s<div class=related><article>t</article></div></article>", "s"),
        ("<main>s<ol id=comments><li><article>c</article></ol></main>", "s"),
        ("<p>s<div class='social-links'>l</div><div class='ad-300x250'>l</div><div class='related-posts'>l</div>", "s"),
    ],
)
def test_marked_names(source, want):
    assert text(source) == want


def made(spark, rows):
    return {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_copies_are_no_template(spark):
    source = "<article><section><h2>Story</h2><p>long text</p></section><ul><li>a<li>b</ul></article>"
    rows = [(i, f"//copies.example/?utm={i}", source + f"<p>read {i} times") for i in range(30)]
    rows += [(100 + i, f"//copies.example/{i}", f"<article><p>other {i}</p></article>") for i in range(20)]
    by = made(spark, rows)
    assert all(by[i] == "Story\nlong text\na\nb" for i in range(30))


def test_template_of_a_section(spark):
    rows = [(i, f"//large.example/{i}", f"<article>{'<div>Autumn sale</div>' if i % 100 == 0 else ''}<p>story {i}</p></article>") for i in range(1200)]
    rows += [(2000 + i, f"//large.example/b{i}", f"<article><div>Rare note</div><p>tale {i}</p></article>") for i in range(9)]
    by = made(spark, rows)
    assert all(by[i] == f"story {i}" for i in range(1200))
    assert all(by[2000 + i] == f"Rare note\ntale {i}" for i in range(9))


def pieces(source):
    """Brute force for pages of the sample's shape: markup and lines of the menu, the advert, the article and the footer."""
    body = re.sub(r"<!--.*?-->", "", source.split("<body>")[1].removesuffix("</body></html>"), flags=re.S)
    for piece in re.split(r"(?<=</nav>)|(?=<article>)|(?<=</article>)", body):
        inner = re.sub(r"<br>", " ", re.sub(r"</?(?:b|a)(?: [^>]*)?>", "", piece))
        lines = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", inner)]
        yield piece, [x for x in lines if x]


def test_count_alone_finds_the_template(spark, sf_dir):
    """Without the lists of names, and with articles that are but a div, counting has to find what a site repeats."""
    pages = spark.read.parquet(f"{sf_dir}/../sf0.1/pages.parquet")
    rows = [(r.page_id, re.match(r"\w+://([^/]*)", r.url)[1].lower(), list(pieces(r.html))) for r in pages.collect()]
    on: dict = {}
    for _, host, parts in rows:
        for piece, _ in parts:
            on.setdefault((host, piece), set()).add(tuple(x for _, lines in parts for x in lines))
    least = 3
    want = {
        i: (
            "\n".join(x for piece, lines in parts if len(on[host, piece]) < least for x in lines),
            sum(len(on[host, piece]) >= least for piece, lines in parts if lines),
        )
        for i, host, parts in rows
    }
    assert sum(n >= 2 for _, n in want.values()) > len(want) / 4
    renamed = pages.withColumn("html", F.regexp_replace("html", r"(</?)article>", "$1div>"))
    got = {r.page_id: (r.text, r.n_template) for r in extract(renamed, least, lists=False).collect()}
    assert got == want


def test_no_line_is_lost_without_article_elements(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/../sf0.1/pages.parquet")
    renamed = pages.withColumn("html", F.regexp_replace("html", r"(</?)article>", "$1div>"))
    got = {r.page_id: r.text for r in extract(renamed, 3).collect()}
    assert got == {r.page_id: article(r.html) for r in pages.collect()}


def test_quoted_paragraphs_are_no_template(spark):
    rows = [(i, f"//q.example/{i}", f"<div>menu</div><div><h1>Weekly notes</h1><p>story {i}</p><p>As is.</p></div><script>at({i})</script>") for i in range(30)]
    rows += [(100 + i, f"//q.example/b{i}", f"<section><div>menu</div><p>tale {i}</p></section>") for i in range(5)]
    rows += [(200 + i, f"//s.example/{i}", f"<p>x{i}</p><div><script>at({i})</script>Follow us</div>") for i in range(12)]
    by = made(spark, rows)
    assert all(by[i] == f"Weekly notes\nstory {i}\nAs is." for i in range(30))
    assert all(by[100 + i] == f"menu\ntale {i}" for i in range(5))
    assert all(by[200 + i] == f"x{i}" for i in range(12))
