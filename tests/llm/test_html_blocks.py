"""HTML text: pages of known content in many markups, odd and broken pages."""

from __future__ import annotations

import pytest

from partwise.llm import html_blocks as H

TREE = H.grow(*H.labelled())
LONG = "Several plain words stand here one after another so that nobody could mistake them for a menu entry, and then they end."
PAGES = {
    "semantic": ("<header><p>Site</p></header><nav><a href=x>Menu</a></nav><main><article><h1>T</h1><p>Oi.</p><p>" + LONG + "</p></article></main><footer>Foot</footer>", f"T\nOi.\n{LONG}"),
    "attributes": ("<div id='sidebar'><p>" + LONG + "</p></div><div class=content><p>a &amp; b&nbsp;&lt;i&gt; &#233;</p></div><div class=\"user-comments\"><p>" + LONG + "</p></div>", "a & b <i> é"),
    "script": ("<article><p>x<script>var a='<p>no</p>';</script>y<!-- <p>no</p> --> z</p><style>p{}</style><noscript>no</noscript></article>", "xy z"),
    "inline": ("<article><p>on<b>e</b> <i>two</i>\n\t three<br>four<a href='?a=1>2'>five</a></p></article>", "one two three fourfive"),
    "unclosed": ("<article><h1>Head<p><b>one<p>two<li>three", "Head\none\ntwo\nthree"),
    "cut": ("<article><p>kept</p><p cla", "kept"),
    "quoted": ("<article><p title='a > b'>text 1 < 2 & 3</p></article>", "text 1 < 2 & 3"),
    "inner": ("<article><p>A.</p><div class='ad'>" + LONG + "</div><p>" + LONG + "</p><form><p>" + LONG + "</p></form><aside>Look</aside><p>B.</p></article>", f"A.\n{LONG}\nB."),
    "head": ("<html><head><title>No</title><meta x></head><body class='with-sidebar'><article>Yes</article></body></html>", "Yes"),
    "comments": ("<article><p>A.</p></article><section id='comments'><article class='comment'><p>" + LONG + "</p></article></section>", "A."),
    "uppercase": ("<ARTICLE><P>Up</P></ARTICLE><FOOTER>down</FOOTER>", "Up"),
    "boxes": ("<article><svg width=1/>A <svg><text>no</text></svg><button>no</button>b<button>c <select><option>no</option></select>d</article>", "A bc d"),
    "raw": ("<article>x<textarea><p>no</textarea>y<script>never closed <p>no</p></article>", "xy"),
    "plain": (f"<div><a href=1>Home</a></div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><div><a href=2>Terms</a></div>", "\n".join([LONG] * 3)),
    "empty": ("", ""),
    "menu only": ("<nav><ul><li><a href=1>One</a></li></ul></nav>", ""),
}


NAMES = {
    "about": ("<main><article class='post category-reviews tag-social'><h1>Head</h1><p>Oi.</p><p>" + LONG + "</p></article></main>", f"Head\nOi.\n{LONG}"),
    "lacking": ("<article class='entry notice-free'><p>A.</p><p>" + LONG + "</p></article><div class='notice'>" + LONG + "</div>", f"A.\n{LONG}"),
    "heading": ("<main><h1>Law</h1><section id='comments-on-law'><h2>Comments on law</h2><p>" + LONG + "</p><p>B.</p></section></main>", f"Law\nComments on law\n{LONG}\nB."),
    "math": ("<article><p>The area is <math><mi>x</mi> <mo>=</mo> <mn>2</mn></math> in all.</p></article>", "The area is x = 2 in all."),
    "object": ("<article><p>See <object data='x'>the map</object> here.</p></article>", "See the map here."),
    "article of comments": ("<article><p>A.</p></article><article class='comment'><p>" + LONG + "</p></article><article class='related'><p>" + LONG + "</p></article>", "A."),
    "several names": ("<div class='site footer-links'><p>" + LONG + "</p></div><article class='reviews post'><p>A.</p></article><div class='cookie-consent-banner'><p>" + LONG + "</p></div>", "A."),
    "has": ("<div class='has-sidebar'><article class='no-comments'><p>A.</p><p>" + LONG + "</p></article></div>", f"A.\n{LONG}"),
}


@pytest.mark.parametrize("name", NAMES)
def test_names(name):
    page, want = NAMES[name]
    assert H.article(page, TREE) == want


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    page, want = PAGES[name]
    assert H.article(page, TREE) == want


def test_tree_fits_table():
    x, y = H.labelled()
    assert (H.classify(TREE, x) == (y > 0.5)).all()


def test_long_and_hostile():
    assert H.article("<article>" + "<p>word</p>" * 30000 + "</article>", TREE).count("word") == 30000
    H.article("<" * 50000 + "<a '" * 20000, TREE)
    H.article("<div class='ad'>" * 20000 + "x", TREE)


def test_extract(spark):
    rows = [(i, f"u{i}", p, "x") for i, (p, _) in enumerate(PAGES.values())] + [(0, "again", PAGES["script"][0], "y"), (None, None, None, None)]
    got = H.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    want = {(i, f"u{i}", t, len(t)) for i, (_, t) in enumerate(PAGES.values())} | {(0, "again", "xy z", 4), (None, None, "", 0)}
    assert set(map(tuple, got)) == want and len(got) == len(rows)
    assert H.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
