"""Main text of HTML pages: flat text blocks classified by a decision tree.

A page is read once into flat blocks: text between block-level tags, character references
decoded, white space reduced.  A block's features are its own and its neighbours' word
counts and link densities, whether it is a heading or list item, and where it stands
(inside article or main, inside a page part such as nav or footer, under an element whose
class or id names such a part, on a page that has an article at all).  A decision tree
(Spark ML) fitted on the small labelled table ``LABELLED`` decides which blocks are text.

A formula's words stand in their block, without its annotations.  Script, style and other
raw elements, comments, tags, and everything in ``head`` are never
text.  Edge cases: null html is the empty page; a page without text blocks gives an empty
string; unclosed elements end with the page, unmatched end tags are ignored, an element named after
a part such as header or tags that encloses the article element is none, a tag or comment cut off at the page's end is markup.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from assay.llm._common import append_columns

OUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

FEATURES = ("words", "links", "prev_words", "prev_links", "next_words", "next_links",
            "heading", "item", "article", "part", "named", "has_article")

#: Labelled blocks (1 text, 0 not): own words and link density, the same of the previous
#: and the next block, then the flags in the order of FEATURES.
LABELLED = """
8 0 6 1 40 0  1 0 1 0 0 1  1
9 0 0 0 55 0  1 0 1 0 0 1  1
2 0 9 0 70 0  1 0 1 0 0 1  1
55 0 9 0 60 0  0 0 1 0 0 1  1
120 0 55 0 90 0  0 0 1 0 0 1  1
90 0.05 120 0 30 0  0 0 1 0 0 1  1
30 0 90 0 1 0  0 0 1 0 0 1  1
1 0 30 0 1 0  0 0 1 0 0 1  1
1 0 1 0 80 0  0 0 1 0 0 1  1
3 0 200 0 12 0.1  0 0 1 0 0 1  1
200 0.02 3 0 6 0  0 0 1 0 0 1  1
6 0 200 0 9 0  0 1 1 0 0 1  1
9 0.1 6 0 7 0  0 1 1 0 0 1  1
14 0.3 30 0 45 0  0 0 1 0 0 1  1
25 0.2 14 0.3 5 1  0 0 1 0 0 1  1
45 0 25 0 12 0.1  0 0 1 0 0 1  1
5 0.4 45 0 60 0  0 0 1 0 0 1  1
400 0.01 5 0 8 0  0 0 1 0 0 1  1
12 0 400 0 10 0.2  0 0 1 0 0 1  1
2 1 45 0 50 0  0 0 1 0 0 1  1
9 1 60 0 6 0  0 0 1 0 0 1  1
7 1 45 0 3 0  0 0 1 0 0 1  1
12 1 80 0 1 0  0 0 1 0 0 1  1
2 0 7 1 0 0  0 0 1 0 0 1  1
4 0 9 1 30 0  0 0 1 0 0 1  1
3 0 12 1 2 0  0 0 1 0 0 1  1
3 1 30 0 60 0  0 0 1 0 0 1  1
5 0.8 70 0 45 0  0 0 1 0 0 1  1
1 1 1 1 1 1  0 1 0 1 0 1  0
1 1 0 0 1 1  0 1 0 1 0 1  0
2 1 1 1 9 0  0 1 0 1 0 1  0
9 0 1 1 8 0  0 0 0 0 1 1  0
1 0 2 0 14 0  1 0 0 0 1 1  0
2 0 7 1 14 0  1 0 0 0 1 1  0
4 0 9 1 3 0  0 0 0 0 1 1  0
3 0 2 1 0 0  0 0 1 0 1 1  0
5 0 9 1 30 0  0 0 1 0 1 1  0
3 0 9 1 0 0  0 0 0 0 0 1  0
13 0 2 1 9 0  0 0 0 0 1 1  0
40 0 8 0 12 0  0 0 0 0 1 1  0
12 0 90 0 0 0  0 0 0 1 0 1  0
60 0 1 0 0 0  0 0 0 1 0 1  0
8 0 45 0 3 1  0 0 0 1 0 1  0
3 1 12 0 2 1  0 0 0 1 0 1  0
25 0 2 0 30 0  0 0 0 0 0 1  0
5 0 30 0 0 0  0 0 0 0 0 1  0
70 0 9 0 20 0  0 0 0 0 0 1  0
9 0 0 0 14 0  1 0 0 1 0 1  0
3 1 80 0 4 1  0 1 1 0 0 1  0
2 1 60 0 3 1  0 1 1 0 0 1  0
5 1 2 1 40 0  0 1 1 0 0 1  0
4 1 3 1 2 1  0 1 1 0 0 1  0
6 1 4 1 0 0  0 1 1 0 0 1  0
6 0 12 0 60 0  1 0 0 0 0 1  0
11 0 60 0 40 0  0 0 1 0 1 1  0
50 0 11 0 45 0  0 0 1 0 1 1  0
4 1 50 0 4 1  0 1 1 0 1 1  0
20 0.1 45 0 30 0  0 0 1 0 1 1  0
2 0 90 0 35 0  1 0 1 0 1 1  0
10 0 45 0 5 0  0 0 1 1 0 1  0
5 0 10 0 120 0  0 0 1 1 0 1  0
30 0 60 0 25 0  0 0 1 1 0 1  0
3 1 30 0 3 1  0 1 1 1 0 1  0
6 1 40 0 7 1  0 1 1 1 0 1  0
35 0 2 0 50 0  0 0 0 1 1 1  0
50 0 35 0 3 1  0 0 1 1 1 1  0
45 0 6 0 60 0  0 0 0 0 0 0  1
60 0.05 45 0 80 0  0 0 0 0 0 0  1
80 0 60 0 15 0  0 0 0 0 0 0  1
15 0.1 80 0 90 0  0 0 0 0 0 0  1
90 0 15 0 4 0.5  0 0 0 0 0 0  1
70 0 60 0 1 1  0 0 0 0 0 0  1
55 0.02 90 0 0 0  0 0 0 0 0 0  1
35 0 1 1 2 1  0 0 0 0 0 0  1
100 0.1 0 0 0 0  0 0 0 0 0 0  1
18 0 25 0 30 0  0 0 0 0 0 0  1
25 0 30 0 18 0  0 1 0 0 0 0  1
7 0 3 1 60 0  1 0 0 0 0 0  1
6 0 2 1 45 0  1 0 0 0 0 0  1
12 0 90 0 70 0  0 0 0 0 0 0  1
1 1 1 1 2 1  0 1 0 0 0 0  0
2 1 1 1 1 1  0 1 0 0 0 0  0
3 0.9 2 1 40 0  0 0 0 0 0 0  0
2 1 0 0 60 0  0 0 0 0 0 0  0
4 1 2 1 80 0  0 0 0 0 0 0  0
3 1 1 1 55 0  0 1 0 0 0 0  0
6 0 3 1 0 0  0 0 0 0 0 0  0
1 1 40 0 0 0  0 0 0 0 0 0  0
2 1 30 0 45 0  0 0 0 0 0 0  0
3 1 60 0 50 0  0 0 0 0 0 0  0
5 0 2 1 3 1  0 0 0 0 0 0  0
4 0 1 1 2 1  0 0 0 0 0 0  0
8 0 5 1 4 1  0 0 0 0 0 0  0
7 0 40 0 0 0  0 0 0 0 0 0  0
6 0.8 70 0 5 1  0 0 0 0 0 0  0
5 1 6 0.8 9 0  0 0 0 0 0 0  0
9 0 5 1 2 1  0 0 0 0 0 0  0
2 0 3 1 2 1  0 0 0 0 0 0  0
30 0.7 4 1 5 1  0 0 0 0 0 0  0
40 0 60 0 5 0  0 0 0 0 1 0  0
60 0 12 0 90 0  0 0 0 0 1 0  0
12 0 70 0 0 0  0 0 0 1 0 0  0
55 0 20 0 60 0  0 0 0 1 0 0  0
2 1 1 1 1 1  0 1 0 1 0 0  0
8 0 1 1 50 0  1 0 0 1 0 0  0
"""

RAW = "script|style|noscript|template|textarea|select|svg|annotation|annotation-xml|iframe|object|canvas|audio|video"
PIECE = re.compile(
    r"<!--(?:.*?-->|.*\Z)"                                          # comment
    r"|<svg(?:\s++[^\s=>/\"']++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?+|/(?!>))*+\s*+/>"     # closes itself
    rf"|<(?P<raw>{RAW})(?=[\s/>])[^>]*(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"   # element without text
    r"|<[!?][^>]*(?:>|\Z)"                                          # doctype, instruction
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<cut>/?[a-z][^>]*)(?:>|\Z)",                             # a tag with an unclosed quote
    re.IGNORECASE | re.DOTALL)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)

#: Element kinds (fixed values of HTML).
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr "
                   "math maction menclose merror mfenced mfrac mglyph mi mlabeledtr mmultiscripts mn mo mover mpadded mphantom "
                   "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover "
                   "none semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li dt dd option".split())
CONTENT = frozenset("article main".split())
PARTS = frozenset("nav header footer aside form menu dialog button fieldset legend head title address".split())
UNNAMED = frozenset("html body main article".split())
#: A class such as has-sidebar or tags-enabled describes the page's layout, not the element.
LAYOUT = frozenset("has with no without enabled disabled".split())
#: Words of class, id and role values that name a part of the page beside the article.
PART_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup sidebar widget widgets "
    "related recommended menu nav navbar navigation navigationbar breadcrumb breadcrumbs pagination pager header masthead "
    "topbar footer foot copyright comment comments commentlist reply replies respond disqus discussion share sharing social "
    "login search searchbox form toolbar tags meta byline skip".split())
#: Those of them that stay beside the article even where they enclose an article element.
NEVER_AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr popup "
    "modal overlay newsletter subscribe subscription signup sidebar widget widgets related recommended comment comments "
    "commentlist reply replies respond disqus discussion login".split())


class Block:
    __slots__ = ("words", "links", "heading", "item", "article", "part", "named", "text")


def names(attrs: str) -> tuple[set, set]:
    """Words of an element's class, id and role, and those that name a part of the page: a
    value such as has-sidebar, with a word of layout in it, names none."""
    values = [re.findall("[a-z]+", v) for found in NAMES.findall(attrs) for v in "".join(found).lower().split()]
    words = {w for v in values for w in v}
    return words, {w for v in values if LAYOUT.isdisjoint(v) for w in v} & PART_NAMES


def blocks(html: str) -> tuple[list[Block], bool]:
    """Flat text blocks in page order, and whether the page has an article."""
    out: list[Block] = []
    stack: list[list] = []              # tag, content, part, named, named by a word that may enclose the article
    open_tags: dict[str, int] = {}      # how often each tag is on the stack
    n_content = n_part = n_named = n_around = 0
    buffer: list[str] = []
    in_link, link_text, tag_of = False, [], ""
    has_article = False

    def flush():
        text = " ".join("".join(buffer).split())
        if text:
            b = Block()
            b.text, b.words = text, text.count(" ") + 1
            b.links = min(1.0, len("".join(link_text).split()) / b.words)
            b.heading, b.item = tag_of in HEADINGS, tag_of in ITEMS
            b.article, b.part, b.named = n_content > 0, n_part > 0, n_named > 0
            out.append(b)
        buffer.clear()
        link_text.clear()

    def leave(k: int):
        nonlocal n_content, n_part, n_named, n_around
        for t, c, p, n, around in stack[k:]:
            n_content, n_part, n_named, n_around = n_content - c, n_part - p, n_named - n, n_around - around
            open_tags[t] -= 1
        del stack[k:]

    def add(raw: str):
        text = references.unescape(raw) if "&" in raw else raw
        buffer.append(text)
        if in_link:
            link_text.append(text)

    at = 0
    for m in PIECE.finditer(html):
        if m.start() > at:
            add(html[at:m.start()])
        at = m.end()
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not m.group("close")
                link_text.append(" ")
            elif tag == "br":
                add(" ")
            if tag == "a" or not m.group("attrs") or "=" not in m.group("attrs"):
                continue
        else:
            flush()
        if m.group("close"):
            if open_tags.get(tag):          # each step of the search removes an element: linear in all
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                leave(k)
            tag_of = stack[-1][0] if stack else ""
            if tag not in INLINE:
                in_link = False
        elif tag not in VOID and tag not in INLINE:
            words, naming = names(m.group("attrs")) if "=" in m.group("attrs") else (set(), set())
            content = tag in CONTENT or "main" in words and "role" in m.group("attrs").lower()
            named = bool(naming) and tag not in UNNAMED or tag == "article" and bool(words & {"comment", "ad"})
            around = named and not naming & NEVER_AROUND and tag != "article"
            if content and not n_part and not named and n_named == n_around:
                has_article = True
                k = len(stack)
                while n_around:             # what encloses the article is no part beside it
                    k -= 1
                    if stack[k][4]:
                        stack[k][3] = stack[k][4] = False
                        n_named, n_around = n_named - 1, n_around - 1
            if tag in HEADINGS or tag in ("p", *ITEMS):      # a new one ends an open one
                if stack and stack[-1][0] == tag or stack and tag in HEADINGS and stack[-1][0] in HEADINGS:
                    leave(len(stack) - 1)
            stack.append([tag, content, tag in PARTS, named, around])
            open_tags[tag] = open_tags.get(tag, 0) + 1
            n_content, n_part, n_named, n_around = n_content + content, n_part + (tag in PARTS), n_named + named, n_around + around
            tag_of = tag
    if at < len(html):
        add(html[at:])
    flush()
    return out, has_article


def features(bs: list[Block], has_article: bool) -> list[tuple]:
    """Feature rows in the order of FEATURES."""
    ends = [(0, 0.0)]
    around = ends + [(b.words, b.links) for b in bs] + ends
    return [(b.words, b.links, *around[i], *around[i + 2], b.heading, b.item, b.article, b.part, b.named, has_article)
            for i, b in enumerate(bs)]


def fit_tree(spark: SparkSession) -> tuple:
    """The decision tree fitted on ``LABELLED``, as nested (feature, threshold, left,
    right) with a 0 or 1 at the leaves."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    rows = [tuple(map(float, line.split())) for line in LABELLED.split("\n") if line]
    data = spark.createDataFrame(rows, [*FEATURES, "label"]).coalesce(1)
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(data)
    model = DecisionTreeClassifier(maxDepth=8, maxBins=64, seed=1).fit(data)

    def read(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return int(node.prediction())
        split = node.split()
        return split.featureIndex(), split.threshold(), read(node.leftChild()), read(node.rightChild())

    return read(model._java_obj.rootNode())


def decide(tree, row: tuple) -> int:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(html: str | None, tree) -> str:
    bs, has_article = blocks(html) if html else ([], False)
    return "\n".join(b.text for b, f in zip(bs, features(bs, has_article)) if decide(tree, f))


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None,
            tree: tuple | None = None) -> DataFrame:
    """``pages`` with ``text``, the main text of the whole html, and its ``n_chars``."""
    tree = fit_tree(pages.sparkSession) if tree is None else tree

    def factory() -> Callable:
        def f(cols):
            texts = [main_text(h, tree) for h in cols[0].to_pylist()]
            return [texts, [len(t) for t in texts]]
        return f

    return append_columns(pages, [html_col], OUT, factory, keep)
