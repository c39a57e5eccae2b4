"""Main text of pages: the given table's articles, and layouts written by hand."""

import html
import re

import pytest

from layerframe.llm.html import blocks_of, extract_text, main_text
from layerframe.llm.queries import QUERIES
from layerframe.llm.text import table

PROSE = [
    "The harbour lies on the north side of the town and it has been used by the fishing boats of the region for more than two hundred years, "
    "as the records that are kept in the library show to all who ask for them.",
    "In the winter of that year the ice was so thick that a market was held on it, and the people who came from the villages around said "
    "that they had never seen so many stalls in one place before or since.",
    "It is not known who built the first wall, but the stones are of the same kind as those in the old church, which was pulled down when "
    "the road to the coast was made wider for the carts of the salt trade.",
]
SIDE = "<ul>" + "".join(f'<li><a href="/{i}">The next of the pages {i}</a></li>' for i in range(8)) + "</ul>"
NOTICE = "We and the partners of this site use cookies to measure how it is used and to show you the adverts that are of use to you, as is set out in the notice."


def test_query_gives_the_articles(spark, sf_dir):
    got = {r.page_id: r for r in QUERIES["op13_html_extraction"](spark, sf_dir).collect()}
    pages = table(spark, sf_dir, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        inside = re.search(r"<article>(.*?)(</article>|\Z)", p.html, re.S)[1]
        parts = re.split(r"<(?!/?b>)[^>]*>", re.sub("</?b>", "", inside))
        assert got[p.page_id].text == " ".join(" ".join(html.unescape(x) for x in parts).split())
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_surroundings_go_short_paragraphs_stay():
    page = f"""<!doctype html><html><head><title>The title</title><style>p {{}}</style><script>var a = "</p><p>{PROSE[0]}";</script></head>
    <body class="has-sidebar"><header><h1>The name of the site</h1>{SIDE}</header><nav>{SIDE}</nav>
    <div class="cookie-notice"><p>{NOTICE}</p></div><!-- <p>{PROSE[0]}</p> -->
    <main><article><header><h2>A town</h2></header><p>{PROSE[0]}<p>So it was.<p>{PROSE[1]}</p><div class="ad-slot">{NOTICE}</div>
    <form><label>Your name</label><input value="x"><button>Send it</button><p>{NOTICE}</p></form><p>{PROSE[2]}</p><p>The end.</p></article>
    <aside><p>{PROSE[0]}</p></aside><section id="comments"><article class="comment"><p>{PROSE[1]}</p></article></section></main>
    <footer><p>{PROSE[2]}</p></footer></body></html>"""
    assert main_text(page) == " ".join(["A town", PROSE[0], "So it was.", PROSE[1], PROSE[2], "The end."])


def test_pages_without_containers():
    page = f"""<body><div id="top"><a href="/">Home</a> | <a href="/a">All of the news</a></div><div>{SIDE}</div>
    <h1>A town by the sea</h1><div>{PROSE[0]}</div><div>So it was.</div><div>{PROSE[1]}</div>
    <div><a href="/x">More of this</a></div>{SIDE}<div>© 2020 The town</div></body>"""
    assert main_text(page) == " ".join(["A town by the sea", PROSE[0], "So it was.", PROSE[1]])


def test_articles_without_stop_words_or_long_blocks():
    junk = "zrk qpl vvn " * 40
    assert main_text(f"<article><p>{junk}</p><p>zrk</p></article><p>{junk}</p>") == " ".join((junk + "zrk").split())
    assert main_text("<nav>a</nav><article><p>Yes.</p></article>") == "Yes."
    chinese = "港口位于城北已经使用了两百多年" * 20
    assert main_text(f"<div>{chinese}</div>{SIDE}") == chinese


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<", ""),
        ("<article>a &lt;b&gt; &amp;amp; &#65;&#x42;&nbsp;c &eacute &copy</article>", "a <b> &amp; AB c é ©"),
        ("<article>a<b>b</b>c<br>d<i> e</i>\n\t f<p>g", "abc d e f g"),
        ("<article>1 < 2 and 3<4 > 2</article>", "1 < 2 and 3<4 > 2"),
        ("<article><p title='a > b' data-x=\"</p>\">yes</p><p class=it's>too</p></article>", "yes too"),
        ("<article>cut off <b", "cut off"),
        ("<article>cut off &am", "cut off &am"),
        ("<article>cut <!-- off", "cut"),
        ("<article>x<script>y</scripty>z", "x"),
        ("<ARTICLE><P>Upper</P></ARTICLE><NAV>menu</NAV>", "Upper"),
        ("<article><div><p>in</div></article></div></article><p>out", "in"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
        ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
        ("<article><svg><text>no</text></svg><textarea><p>no</p></textarea>yes</article>", "yes"),
        ("<article><p>see <a href='/x'>this and that</a></p></article>", "see this and that"),
    ],
)
def test_small_pages(page, want):
    assert main_text(page) == want


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + f"<article>{PROSE[0]}" + "</div>" * 20_000
    assert main_text(deep) == PROSE[0]
    unclosed = "<article>" + "<p><b>word <a href=x>" * 30_000
    assert main_text(unclosed) == " ".join(["word"] * 30_000)
    assert main_text("<" * 100_000 + "<article>x") == "x"
    assert len(blocks_of("<article>" + f"<p>{PROSE[0]}</p>" * 3_000)) == 3_000


def test_edge_rows(spark):
    rows = [(None, None, None, 1), (1, "u", "", 2), (1, "u", "<article>a</article>", 3), (1, "u", "<article>a</article>", 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int").withColumn("_page", pages_text())
    got = sorted(tuple(r) for r in extract_text(pages).where("page_id = 1").collect())
    assert got == [(1, "u", "", 0), (1, "u", "a", 1), (1, "u", "a", 1)]
    assert [tuple(r) for r in extract_text(pages).where("page_id is null").collect()] == [(None, None, "", 0)]
    assert extract_text(pages.limit(0)).count() == 0
    labelled = extract_text(pages.withColumnRenamed("html", "a.b"), keys=("page_id",), column="a.b", blocks=True).where("n_chars = 1").first()
    assert [tuple(b) for b in labelled.blocks] == [("article", "a", True)]


def pages_text():
    from pyspark.sql import functions as F

    return F.lit("<article>other</article>")
