import html as entities
import random
import re

import pytest
from pyspark.sql import functions as F

from riverdeck.llm.html_text import extract, main_text, smoothed, two_clusters

LONG = "A long paragraph of the article, with many words in it, so that its ratio of text to tags is high."


def marked_article(page):
    """Of these pages: what the article element holds, a line per heading or paragraph."""
    lines = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", part)).split())
             for part in re.split(r"</?(?:h1|p)>", re.search(r"<article>(.*)</article>", page, re.S)[1])]
    return "\n".join(filter(None, lines))


def test_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in extract(pages).collect()}
    for r in pages.collect():
        text = marked_article(r.html)
        assert got[r.page_id] == (r.url, text, len(text))


def test_unmarked_article_among_everything_else():
    page = f"""<html><body class="nav-open"><header><h1>Site</h1></header><div id="main-menu"><ul><li><a>One</a></li></ul></div>
      <div class="content"><div class="cookie-notice">{LONG}</div><h2>Head &amp; title</h2><p>{LONG}</p><p>Short.</p>
      <p>{LONG} <b>bold</b> end</p></div><div class="sidebar"><p>{LONG}</p></div><div id="comments"><p>{LONG}</p></div>
      <form><label>Name</label></form><div><a href=x>More</a> <a href=y>links</a></div><footer>&copy; x</footer></body></html>"""
    assert main_text(page) == f"Head & title\n{LONG}\nShort.\n{LONG} bold end"


def test_marked_article_keeps_its_header_and_drops_the_rest():
    page = f"""<body><aside>{LONG}</aside><main><article><header><h1>Title</h1></header><p>Tiny.</p><aside>{LONG}</aside>
      <script>var t="</p>{LONG}"</script><section id="comments"><article class="comment"><p>{LONG}</p></article></section>
      <p>One<br>two&nbsp;&lt;three&gt;</p></article></main><p>{LONG}</p></body>"""
    assert main_text(page) == "Title\nTiny.\nOne two <three>"


def test_ratios_select_inside_a_mark():
    links = "".join(f'<li><a href="/{k}">Another page of the site, number {k}</a></li>' for k in range(8))
    advert = '<div><a href=x>Buy the finest things here, today only</a> <a href=y>or there</a></div>'
    page = f"""<body><main><h1>Title</h1><p>{LONG * 3}</p><section><h2>Notes</h2><p>Tiny.</p></section><p>{LONG * 3}</p>
      <ul><li>A point, see <a href=x>there</a>.</li></ul><p>{LONG}</p>{advert}<ul>{links}</ul></main></body>"""
    assert main_text(page) == f"Title\n{LONG * 3}\nNotes\nTiny.\n{LONG * 3}\nA point, see there.\n{LONG}"
    assert main_text("<div>x</div><main><ul><li><a>One</a></li></ul></main>") == "One"


def test_a_word_in_a_name_does_not_discard_an_article():
    page = f"""<article><h1>T</h1><h2 id="related-work">Related work</h2><p>{LONG}</p><section id="search-methods"><p>{LONG}</p>
      <p>Short.</p></section><p id="comments-on-method">{LONG}</p></article>"""
    assert main_text(page) == f"T\nRelated work\n{LONG}\n{LONG}\nShort.\n{LONG}"
    for name in ("content no-sidebar", "social-science"):
        assert main_text(f'<body><div class="{name}"><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div></body>') == f"T\n{LONG}\n{LONG}"
    assert main_text(f'<div>Site</div><div class="social"><div class="ad">{LONG}</div><p>{LONG * 20}</p></div>') == LONG * 20


def test_head_without_an_end_tag():
    for start in ("<html><head><title>x</title>", "<head><title>x</title><body>"):
        assert main_text(f"{start}<article><p>{LONG}</p></article>") == LONG
        assert main_text(f"{start}<p>{LONG}</p><p>{LONG}</p>") == f"{LONG}\n{LONG}"
    assert main_text(f"<head><title>x</title>{LONG}") == LONG


def test_page_wide_form():
    side = f'<nav>a b c</nav><div class="sidebar"><p>{LONG}</p></div>'
    body = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p>"
    for mark in ("article", "main", "div"):
        assert main_text(f"<body><form>{side}<{mark}>{body}</{mark}></form></body>") == f"T\n{LONG}\n{LONG}"
    assert main_text(f"<form><article><p>{LONG}</p></article>{side}<article><p>Two.</p></article></form>") == f"{LONG}\nTwo."


def test_broken_markup():
    assert main_text(f"<p><b>{LONG}<br><p>{LONG}") == f"{LONG}\n{LONG}"
    assert main_text("no markup   at all") == "no markup at all"
    for page in ("<p>" * 20_000, "<div>" * 20_000 + "x", "</p>" * 20_000, "<b>" * 5000 + "x" + "</b>" * 5000, "&" * 20_000):
        main_text(page)


def test_marked_sections():
    """What a browser reads as a comment; a section that the parser knows stays as it was."""
    for section in ("<![foo[bar]]>", "<![ if>", "<![if !IE]>", "<![x y z[>", "<![>", "<![endif]>"):
        assert main_text(f"<p>{LONG}</p>{section}<p>{LONG}</p>") == f"{LONG}\n{LONG}", section
    for page in ("<![foo[bar]]>x", "<p>a</p><![ if>b", "<![", "<![a", "<![CDATA[a]]>b", "<p>a<![CDATA[b", "<!["):
        main_text(page)


def test_random_markup():
    pick = random.Random(7)
    parts = ["<", ">", "<!", "<![", "[", "]]>", "]>", "<!--", "-->", "--!>", "<?", "?>", "</", "/>", "<p>", "</p>", "<a href='", '"', "'", "=",
             "<script>", "</script>", "<style>", "<article>", "</article>", "<b>", "</i>", "&", "&#", "&#x", ";", "&amp", "CDATA[", "if",
             "<!DOCTYPE", "<!ELEMENT", "\x00", "\n", " ", "text", "é", "<table", "<td>", "<svg>", "<title>", "<textarea>", "%", "x" * 50]
    for _ in range(4000):
        main_text("".join(pick.choice(parts) for _ in range(pick.randint(1, 40))))


def test_smoothing_and_clusters():
    assert smoothed([5.0] * 6) == pytest.approx([5.0] * 6)
    peak = smoothed([0, 0, 0, 10, 0, 0, 0])
    assert peak[3] == max(peak) and peak[2] == pytest.approx(peak[4]) and peak[2] > peak[1] > 0 == peak[0]
    assert 3 < two_clusters([1, 2, 1, 100, 90, 95]) < 90
    assert two_clusters([4, 4]) == 4


def test_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "u", "<nav>x</nav>"), (3, "u", f"<p>{LONG * 20_000}</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("t"))
    got = sorted([(r.page_id, r.url, len(r.text), r.n_chars) for r in extract(pages).collect()], key=str)
    size = len(LONG) * 20_000
    assert got == sorted([(1, None, 0, 0), (2, "u", 0, 0), (2, "u", 0, 0), (None, "u", 0, 0), (3, "u", size, size)], key=str)
    assert extract(pages.limit(0)).count() == 0
