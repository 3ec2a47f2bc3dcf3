import re

import pytest
from pyspark.sql import functions as F

from assay.llm import htmltext as H


@pytest.fixture(scope="module")
def tree(spark):
    return H.fit_tree(spark)


PAGE = """<!DOCTYPE html><html lang=en><head><title>T &amp; x</title><style>p{a:b}</style></head><body class="has-sidebar">
<header><h1>Site name of the day</h1></header><nav><ul><li><a href=/a>Home</a><li><a href="/b">About us</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site better for you and for everybody else.</div>
<article class="post"><h2>The  headline&nbsp;here</h2><p>First <b>para</b>graph of the text, with a <a href=x>link</a>&hellip;
and a second line.<br>After the break &lt;tag&gt; &#233;.<p>Short.<script>var x = "</p><p>not text</p>";</script>
<!-- <p>hidden</p> --><ul><li>One item of the list</li><li>Another item</li></ul>
<aside><p>Aside words that are many enough to look like a paragraph of the text.</p></aside>
<form><p>Subscribe to our newsletter now and get all of it by mail every day.</p><input name=a></form>
<div class="ad">Buy one of these things now, they are cheap and good and cheap.</div><blockquote>Quoted words.</blockquote></article>
<section id="comments"><h3>Comments</h3><p>I think that this article is wrong in nearly every one of its many words.</p></section>
<div class="sidebar widget"><p>Popular now</p><a href=/q>Some other article of ours</a></div>
<footer><p>Copyright of the site, all rights reserved since the beginning of time.</p></footer></body></html>"""

TEXT = """The headline here
First paragraph of the text, with a link… and a second line. After the break <tag> é.
Short.
One item of the list
Another item
Quoted words."""


def test_article_page(tree):
    assert H.main_text(PAGE, tree) == TEXT


def test_page_without_article_uses_words_and_links(tree):
    long = " ".join(["word"] * 60)
    page = f"<body><div><a href=1>One</a> <a href=2>Two</a></div><div><p>{long}<p>{long} more</div><div><a href=3>x</a></div>"
    assert H.main_text(page, tree) == f"{long}\n{long} more"


EDGES = ["", "   ", "no markup at all", "<p", "<article><p>cut off <b", "<article><p>a</p><!-- open", "<script>x", "</div></p>",
         "<article><p>q <a title='<p>'>x</a> y", '<article><p class="un>closed', "<article>" + "<div>" * 3000 + "deep",
         "<article><p>" + "long words " * 50_000, "<article>&am &xyzzy; &#x41; &#0;", "<" * 5000, "<a " * 3000]


def test_edges(spark, tree):
    rows = [(i, "u", h) for i, h in enumerate([None, *EDGES])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("Text", F.lit("clash")) \
        .withColumn("n_chars", F.lit("clash"))
    got = {r.page_id: r for r in H.extract(df, tree=tree).collect()}
    assert H.extract(df, tree=tree).columns == ["page_id", "url", "html", "text", "n_chars"]
    texts = [got[i].text for i in range(len(rows))]
    assert all(got[i].n_chars == len(t) for i, t in enumerate(texts))
    assert texts[0] == texts[1] == texts[2] == "" and texts[5] == "cut off" and texts[6] == "a"
    assert texts[9] == "q x y" and texts[11] == "deep" and texts[12] == ("long words " * 50_000).strip()
    assert texts[13].startswith("&am &xyzzy; A")
    assert H.extract(df.limit(0), tree=tree).count() == 0


def test_whole_table_equals_its_documents(spark):
    """The pages show documents: their text is the document's lines under its title."""
    from assay.llm.op5 import op5_html_text
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = op5_html_text(spark, sf).collect()
    assert len(rows) == 250
    for r in rows:
        doc = docs[int(re.search(r"://[^/]+/[a-z]+/(\d+)", r.url)[1])]
        lines = [" ".join(x.split()) for x in doc.split("\n")]
        assert r.text.split("\n")[1:] == [x for x in lines if x]


def test_self_closing_svg_and_formulas(tree):
    rest = " ".join(["word"] * 40)
    for icon in ("<svg/>", "<svg />", '<svg class="a>b" width=10 />', "<SVG data-x='1'/>", "<math/>", "<svg><path d='x'/>no</svg>",
                 "<svg width=1/>no</svg>"):
        page = f"<article><p>First {rest} {icon}and on.</p><p>Last {rest}.</p></article>"
        assert H.main_text(page, tree) == f"First {rest} and on.\nLast {rest}.", icon
    formula = "<math display='block'><semantics><mrow><mi>a</mi><mo>=</mo><mn>2</mn></mrow>" \
        "<annotation encoding='tex'>\\\\hidden</annotation></semantics></math>"
    page = f"<article><p>First {rest} {formula} and on.</p></article>"
    assert H.main_text(page, tree) == f"First {rest} a=2 and on."
    assert len(H.blocks("<svg " + "a " * 200_000)[0]) == 0


def test_layout_names_around_the_article(tree):
    body = "<h1>Headline</h1><p>" + "Words of the article that everybody reads. " * 5 + "</p>"
    text = "Headline\n" + ("Words of the article that everybody reads. " * 5).strip()
    beside = "<div class='related'><article><h2>Other</h2><p>Another article of this site with some words.</p></article></div>"
    comment = "<section id=comments><article><p>A reader wrote these words on the article above.</p></article></section>"
    for around in ("content-header-wrapper", "post tags-enabled", "banner-page", "no-menu main-menu-off"):
        page = f"<body><div class='{around}'><div><article>{body}</article></div></div>{beside}{comment}</body>"
        assert H.main_text(page, tree) == text, around
    page = f"<div class='page-header'><p>Site name and its motto of many words</p></div><main>{body}<div class='ad with-image'>" \
        "Buy one of these things now, they are cheap and good.</div></main>"
    assert H.main_text(page, tree) == text


def test_paragraph_that_is_one_link(tree):
    words = "Words of the article that everybody reads. " * 8
    page = f"<article><p>{words}</p><p><a href=/x>The whole report of the commission</a></p><p>Read it.</p></article>"
    assert H.main_text(page, tree) == f"{words.strip()}\nThe whole report of the commission\nRead it."


def test_time_grows_in_proportion(tree):
    import time
    took = []
    for n in (20_000, 80_000):
        page = "<div>" * n + "</p>" * n + "<div class=menu><main>x</main></div>" * (n // 4)
        start = time.process_time()
        H.blocks(page)
        took.append(time.process_time() - start)
    assert took[1] < 12 * took[0] + 1
