import re
import time
from html.parser import HTMLParser

import pytest

from tracelake.llm.rendering import lay_out, render, visible_text

SKIP = {"head", "script", "style", "template", "noscript"}


class Words(HTMLParser):
    """Visible words in order, for well-formed skipping of the unseen elements."""

    def __init__(self):
        super().__init__()
        self.depth, self.words, self.open = 0, [], []

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self.depth = 0
        elif tag in SKIP:
            self.depth += 1
        elif tag in ("br", "p", "div", "li", "td", "th", "tr", "h1", "h2", "h3", "ul", "table", "article", "nav", "footer"):
            self.words.append(" ")

    def handle_endtag(self, tag):
        if tag in SKIP:
            self.depth = max(0, self.depth - 1)
        elif tag in ("p", "div", "li", "td", "th", "tr", "h1", "h2", "h3", "ul", "table", "article", "nav", "footer"):
            self.words.append(" ")

    def handle_data(self, data):
        if not self.depth:
            self.words.append(data)


def words(text):
    return [w for w in re.split(r"[ \t\n\r\f]+", re.sub(r"(?m)^ *(?:- |\d+\. |> )", "", text)) if w and w != "|"]


def test_given_pages_keep_all_visible_words(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        p = Words()
        p.feed(r.html)
        p.close()
        want = words("".join(p.words))
        got = words(visible_text(r.html))
        assert got == want, (r.page_id, got[:20], want[:20])


def test_layout():
    t = visible_text
    assert t("<p>a<p>b  c<div>d</div>e") == "a\n\nb c\n\nd\ne"
    assert t("a<br>b<br><br>c") == "a\nb\n\nc"
    assert t("<ul><li>x<li>y<ol start=3><li>z</ol></ul>after") == "- x\n- y\n  3. z\n\nafter"
    assert t("<table><tr><th>name<th>n<tr><td>alpha<td>1<tr><td colspan=2>wide</table>") == "name  | n\nalpha | 1\nwide"
    assert t("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>") == "a     | d\n      |\nb | c |"
    assert t("<pre>\n x\n  y</pre>z") == " x\n  y\n\nz"
    assert t("<dl><dt>t<dd>d</dl>") == "t\n  d"
    assert t("<blockquote>q</blockquote>") == "> q"
    assert t("one<b> two</b><i>three</i> &amp; &lt;four&gt;&nbsp;x") == "one twothree & <four>\xa0x"
    assert t("a<hr>b") == "a\n\n---\n\nb"


def test_visibility_and_broken_markup():
    t = visible_text
    assert t("<head><title>T</title></head><body>b<script>if(a<b)</script><style>p{}</style><!-- c --><p hidden>h<p style='display: none'>n<p>v") == "b\n\nv"
    assert t("<input type=hidden value=x>y<template>z</template><noscript>n</noscript>") == "y"
    assert t("<p>a</b></table></p>b <") == "a\n\nb <"
    assert t("<title>only") == "" and t("") == "" and t(None) == "" and t("<!-- open") == "" and t("<p") == "<p"
    assert t("<textarea>a <b></textarea>c<a title='>'>d</a>") == "a <b>cd"
    deep = "<div>" * 50_000 + "x" + "<b>" * 50_000
    assert t(deep) == "x"
    assert t("<td>loose<td>cells") == "loose cells"
    assert lay_out([]) == []


def test_formulas_and_drawings():
    t = visible_text
    assert t("<p>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be") == "let x=2 be"
    assert t("<math><semantics><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>\\frac12</annotation>"
             "<annotation-xml><ci>no</ci></annotation-xml></semantics></math>, a") == "1 2 , a"
    assert t("a<svg><title>T</title><desc>D</desc><defs><text>no</text></defs><metadata>M</metadata><style>s{}</style>"
             "<rect/><text>Jan</text><text>Fe<tspan>b</tspan></text></svg>z") == "a Jan Feb z"
    assert t("<svg><title/><desc/><defs/><text>seen</text></svg><p>after") == "seen\n\nafter"
    assert t("<svg><text><![CDATA[1 < 2 > 0]]></text></svg>") == "1 < 2 > 0"
    assert t("<svg><foreignObject><div/>in</div></foreignObject></svg><desc>out</desc>") == "in\nout"
    assert t("<svg style='display:none'><text>no</text></svg><svg/>x<math/>y") == "xy"


def test_fallback_of_objects():
    t = visible_text
    assert t("<object><p>fallback</object>") == "fallback" and t("<object data='m.swf'>old</object>x") == "x"
    assert t("<video>no</video><audio>no</audio><canvas>no</canvas>x") == "x"


def test_rows_and_columns(spark):
    rows = [(1, None, "u", "old"), (2, "<p>x", None, "old"), (2, "<p>x", None, "old")]
    df = spark.createDataFrame(rows, "page_id long, html string, url string, text string")
    got = sorted(map(tuple, render(df).collect()), key=repr)
    assert got == [(1, None, "u", ""), (2, "<p>x", None, "x"), (2, "<p>x", None, "x")]
    assert render(df.limit(0)).collect() == []


#: Pages on which a scanner that reads again, or a layout that pads, would take minutes or gigabytes.
HOSTILE = {
    "open tags": "<a " * 10 ** 5, "open tags and a declaration": "<a " * 10 ** 5 + "<!", "open quotes": '<a "' * 10 ** 5 + ">", "one long name": "<a" * 20_000 + ' "x>',
    "a wide cell": "<table><tr><td>" + "x" * 50_000 + "<td>y</tr>" + "<tr><td>a<td>b</tr>" * 10_000 + "</table>",
    "a tall cell": "<table><tr><td>" + "a<br>" * 10_000 + "<td>b" * 3000 + "</table>", "wide spans": "<table><tr>" + "<td colspan=1000>a" * 5000 + "</table>",
    "deep lists": "<ul><li>x" * 20_000, "deep quotes": "<blockquote>x" * 20_000, "deep tables": "<table><tr><td>" * 3000 + "x",
    "deep elements": "<p><object>" + "<i>" * 10_000 + "<div></div>" * 5000, "closing tags": "<b><td>" + "</b>" * 50_000 + "<i>" * 10_000, "script": "<script>" * 50_000}


@pytest.mark.parametrize("page", HOSTILE.values(), ids=HOSTILE.keys())
def test_time_and_text_grow_with_the_page(page):
    begin = time.process_time()
    text = visible_text(page)
    assert time.process_time() - begin < 5
    assert len(text) <= 80 * len(page)


def test_nothing_of_an_unaligned_table_is_lost():
    text = visible_text(HOSTILE["a wide cell"])
    assert text.startswith("x" * 50_000 + " | y\na | b\n") and text.count("a | b") == 10_000
    assert visible_text("<table><tr><td>a long cell<td>b</tr><tr><td>c<td>d</tr></table>") == "a long cell | b\nc           | d"
