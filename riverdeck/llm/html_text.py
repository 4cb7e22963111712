"""Main text of web pages, from text-to-tag ratios.

The standard library's parser streams a page's events. Block tags cut them into lines; a line's ratio is
its characters outside links per tag in it. Ratios are smoothed along the page with a Gaussian, and two
clusters of the smoothed values give the page's threshold. Content regions are containers with a line
above it; a region is kept whole, so a short paragraph or a heading stays with its neighbours.

Containers that are never the article by their element or role (menus, page headers, footers, side bars, scripts,
styles) have ratio 0 and no text. So have those whose class or id has a name made of such words only (notices,
adverts, comments), and forms, unless they hold the marked article or nearly all of the page's text. A name
with such a word among others halves the ratio; names of headings and paragraphs don't count. Where a page marks
its article (`<article>`, `<main>`), only regions there are eligible. Containers, lists and tables inside are regions
of their own; the mark adds a bounded bonus to a region's mean ratio, which makes up for a ratio that short article text
cannot reach, but not for a region of links.

One pass over the rows, no shuffle; time is linear in the page, memory a page's lines.

Defined cases: a null or empty html, and one without text, give an empty text with 0 characters; a null url
stays null; repeated rows are separate rows; an empty table gives an empty result. Only page_id, url and
html are read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverdeck.llm.columns import text_or_empty
from riverdeck.llm.shipping import ship

#: Elements that break lines, that hold no article text, that have no end tag, that group.
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol p pre section summary table "
                  "tbody td tfoot th thead title tr ul".split())
NEVER = frozenset("aside button canvas dialog footer head iframe menu nav noscript object script select style svg "
                  "template textarea".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
GROUP = frozenset("article body div main section td".split())
PARTS = GROUP | frozenset("dl ol table ul".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words in a class or id that mark what is not the article.
NOT_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "pager pagination popup promo promoted promotion recommendations recommended related replies reply respond search "
    "share sharing sidebar signup skyscraper social sponsor sponsored subscribe subscription toolbar widget widgets".split())
#: Words beside them that say no more than where or how; elements that such words don't count on.
LAYOUT = frozenset("area bar block body bottom box button buttons col column container content first header inner item items "
                   "left link links list main outer panel post posts right row section site slot top unit wrap wrapper".split())
UNWORDED = frozenset("html body article main h1 h2 h3 h4 h5 h6 p".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
SIGMA = 1.0
RADIUS = 2
PENALTY = 0.5
MOST = 10


@dataclass
class Line:
    region: int
    article: bool
    never: bool
    doubt: int
    weak: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    tags: int = 0


@dataclass
class _Open:
    tag: str
    never: bool
    doubt: int  # the innermost container around it that is left out by its words, or as a form; 0 without one
    weak: bool
    article: bool
    region: int


def _named(value: str) -> int:
    """What a class or id says: 2 where one of its names has no other words than those of NOT_ARTICLE (and LAYOUT),
    1 where such a word stands among others, as in `no-sidebar` or `related-work`, else 0."""
    most = 0
    for name in value.split():
        words = {w.lower() for w in _WORD.findall(name)}
        if not NOT_ARTICLE.isdisjoint(words):
            most = max(most, 2 if all(w in NOT_ARTICLE or w in LAYOUT or len(w) == 1 or w.isdigit() for w in words) else 1)
    return most


def _marked(tag: str, attributes: list, in_article: bool) -> int:
    """3 where an element is never the article, 2 where only its names or its being a form say so, 1 where its
    names make it less likely, else 0."""
    if tag in NEVER or tag == "header" and not in_article:
        return 3
    most = 2 if tag == "form" else 0
    for name, value in attributes:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return 3
        if name == "role" and (value or "").lower() in ROLES:
            return 3
        if name in ("class", "id") and value and tag not in UNWORDED:
            most = max(most, _named(value))
        elif name == "class" and value and tag == "article":
            if not {"comment", "reply", "related", "promo", "ad"}.isdisjoint(w.lower() for w in _WORD.findall(value)):
                most = 2
        elif name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return 3
    return most


def _differ(a: _Open, b: _Open) -> bool:
    return a.never != b.never or a.doubt != b.doubt or a.weak != b.weak


class Lines(HTMLParser):
    """The lines of a page, in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open = [_Open("", False, 0, False, False, 0)]
        self.doubts = [(0, False)]  # of each container in doubt: the one around it; whether it is a form
        self.depth: dict[str, int] = {}
        self.regions = self.links = 0
        self.seen_article = False
        self.fresh()

    def fresh(self) -> None:
        top = self.open[-1]
        self.line = Line(top.region, top.article, top.never, top.doubt, top.weak)
        self.lines.append(self.line)

    def handle_starttag(self, tag: str, attributes: list) -> None:
        if self.open[-1].tag == "head" and tag not in IN_HEAD or tag == "body":
            self.close_head()
        if tag == "br":
            self.line.parts.append(" ")
        if tag in VOID:
            self.line.tags += 1
            if tag == "hr":
                self.fresh()
            return
        if tag == "p" and self.depth.get("p") or tag == "li" and self.open[-1].tag == "li":
            self.close_tag(tag)  # an open paragraph or item ends where the next begins
        top = self.open[-1]
        told = _marked(tag, attributes, top.article)
        mark = tag in ("article", "main")
        never, doubt = top.never or told == 3, top.doubt
        if told == 2:
            self.doubts.append((doubt, tag == "form"))
            doubt = len(self.doubts) - 1
        elif mark and doubt and not never and (self.doubts[doubt] == (0, True) or not self.seen_article):
            doubt = 0  # a page-wide form, or a wrapper with an unlucky class, around the article itself
        article = (top.article or mark) and not (never or doubt)
        self.seen_article |= mark and article
        region = top.region
        if tag in (PARTS if top.article else GROUP):
            self.regions += 1
            region = self.regions
        self.open.append(_Open(tag, never, doubt, top.weak or told == 1, article, region))
        self.depth[tag] = self.depth.get(tag, 0) + 1
        self.links += tag == "a"
        if tag in BLOCK or _differ(self.open[-1], top):
            self.fresh()
        self.line.tags += 1

    def close_head(self) -> None:
        """Its end tag may be left out: the body, or what only a body holds, ends it."""
        if self.depth.get("head"):
            self.close_tag("head")

    def handle_startendtag(self, tag: str, attributes: list) -> None:
        self.handle_starttag(tag, attributes)
        if tag not in VOID:
            self.handle_endtag(tag)

    def close_tag(self, tag: str) -> None:
        top = self.open[-1]
        while len(self.open) > 1:
            gone = self.open.pop()
            self.depth[gone.tag] -= 1
            self.links -= gone.tag == "a"
            if gone.tag == tag:
                break
        if tag in BLOCK or _differ(top, self.open[-1]):
            self.fresh()

    def handle_endtag(self, tag: str) -> None:
        self.line.tags += 1
        if not self.depth.get(tag):
            if tag in BLOCK:
                self.fresh()
            return
        if tag not in BLOCK:  # an inline end does not close the blocks opened inside it
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag == tag:
                    gone = self.open.pop(at)
                    self.depth[tag] -= 1
                    self.links -= tag == "a"
                    around = self.open[at - 1]
                    if _differ(gone, around):
                        for inner in self.open[at:]:
                            inner.never, inner.weak = inner.never and around.never, inner.weak and around.weak
                            inner.doubt = around.doubt if inner.doubt == gone.doubt else inner.doubt
                        self.fresh()
                    return
                if self.open[at].tag in BLOCK and not self.open[at].never:
                    return
            return
        self.close_tag(tag)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # none that the parser knows, such as <![foo[: a comment up to the next >
            return self.parse_bogus_comment(i)

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self.close_head()
        if not self.line.never:
            self.line.parts.append(data)
            if self.links:
                self.line.linked += len(data)


def smoothed(values: list[float]) -> list[float]:
    """A Gaussian average over `RADIUS` neighbours on each side."""
    weights = [math.exp(-k * k / (2 * SIGMA * SIGMA)) for k in range(-RADIUS, RADIUS + 1)]
    n = len(values)
    out = []
    for at in range(n):
        total = weight = 0.0
        for k in range(max(0, at - RADIUS), min(n, at + RADIUS + 1)):
            w = weights[k - at + RADIUS]
            total += w * values[k]
            weight += w
        out.append(total / weight)
    return out


def two_clusters(values: list[float]) -> float:
    """The border between two clusters: 2-means from the extremes."""
    low, high = min(values), max(values)
    for _ in range(50):
        border = (low + high) / 2
        below, above = [v for v in values if v < border], [v for v in values if v >= border]
        moved = (sum(below) / len(below) if below else low, sum(above) / len(above) if above else high)
        if moved == (low, high):
            break
        low, high = moved
    return (low + high) / 2


def settle(lines: list[tuple[Line, str]], doubts: list[tuple[int, bool]]) -> None:
    """Leave out what stands in containers in doubt, but for those that are nearly the whole page: with `MOST` times
    the text outside links that else remains, and no article marked."""
    own = [0] * len(doubts)
    for line, text in lines:
        if not line.never:
            own[line.doubt] += max(0, len(text) - line.linked)
    whole, inside = own[:], [[] for _ in doubts]
    for at in range(len(doubts) - 1, 0, -1):  # a container comes after the one around it
        whole[doubts[at][0]] += whole[at]
        inside[doubts[at][0]].append(at)
    kept, at, outside = {0}, 0, own[0]
    marked = any(line.article and text for line, text in lines)
    while inside[at] and not marked:
        at = max(inside[at], key=whole.__getitem__)
        if whole[at] <= MOST * outside:
            break
        kept.add(at)
        outside += own[at]
    for line, _ in lines:
        line.never |= line.doubt not in kept


def marked_regions(lines: list[tuple[Line, str]], smooth: list[float], border: float) -> set[int]:
    """The regions of a marked article whose mean smoothed ratio reaches the border. The mark adds up to the border
    itself, in full where half of a region's text stands outside links, nothing where all of it is links."""
    sums: dict[int, list] = {}
    for (line, text), s in zip(lines, smooth):
        if line.article and text and not line.never:
            own = sums.setdefault(line.region, [0, 0.0, 0, 0])
            for at, value in enumerate((1, s, len(text), max(0, len(text) - line.linked))):
                own[at] += value
    return {region for region, (n, total, size, free) in sums.items()
            if total / n + border * min(1.0, 2 * free / size) >= border}


def main_text(html: str) -> str:
    parser = Lines()
    parser.feed(html)
    parser.close()
    lines = [(line, " ".join("".join(line.parts).split())) for line in parser.lines]
    settle(lines, parser.doubts)
    lines = [(line, "" if line.never else text) for line, text in lines]
    lines = [(line, text) for line, text in lines if text or line.tags]
    if not any(text for _, text in lines):
        return ""
    ratios = [0.0 if line.never else (PENALTY if line.weak else 1.0) * max(0, len(text) - line.linked) / max(line.tags, 1)
              for line, text in lines]
    smooth = smoothed(ratios)
    border = two_clusters(smooth)
    marked = any(line.article and text for line, text in lines)
    chosen = marked_regions(lines, smooth, border) if marked else {
        line.region for (line, text), s in zip(lines, smooth) if text and not line.never and s >= border}
    if not chosen:  # nothing but links: the region with most text
        size: dict[int, int] = {}
        for line, text in lines:
            if not line.never and line.article == marked:
                size[line.region] = size.get(line.region, 0) + len(text)
        chosen = {max(size, key=size.get)}
    places = [k for k, (line, text) in enumerate(lines) if text and line.region in chosen and not line.never]
    low, high = places[0], places[-1]
    kept = []
    for k, (line, text) in enumerate(lines):
        between = not marked and low < k < high and 2 * line.linked < len(text)
        if text and not line.never and (line.region in chosen or between):
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) -> page_id, url, text, n_chars."""
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def texts(htmls: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) if h else "" for h in htmls], dtype=object)

    return pages.select("page_id", "url", texts(text_or_empty("html")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint"))
