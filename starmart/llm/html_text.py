"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

A page is read as a stream of events of the standard library's parser. Every block
element's text is a line; a line knows how many tags it took and which elements
enclose it. Lines inside boilerplate elements (scripts, menus, forms, and elements whose
class, id or role is such a name as a whole) are never content; names do not count on
articles, on what holds one, or most of the text of a page without. The others' text-to-tag ratios are smoothed
over neighbouring lines; lines above a threshold are clustered into content, and the region
of a cluster is the innermost article that holds it, so that short lines of an article stay.
Outside articles, a region is what lies between the strongest cluster's lines in their
common parent element. The articles and that region are compared by their text: each
stays that has at least SHARE of the other's.
"""

from __future__ import annotations

import re
from collections.abc import Container, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from starmart.llm.common import by_batch, slices

# HTML elements by what they mean for the main text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot "
    "thead tr ul".split()
)
_CELL = frozenset(("td", "th", "br"))
_DROPPED = frozenset(
    "script style noscript template head title nav footer aside form button select textarea iframe object svg canvas audio "
    "video dialog menu fieldset applet".split()
)
_ARTICLE = frozenset(("article", "main"))
_HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: An open p ends where one of these begins.
_ENDS_P = _BLOCK - {"body", "html", "caption", "tbody", "tfoot", "thead", "tr", "option", "optgroup", "legend"}
_SIBLINGS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",), "option": ("option",)}
_BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent notice notices gdpr popup modal overlay "
    "newsletter subscribe subscription signup comment comments disqus reply replies respond related recommended recommendations share "
    "sharing social widget widgets login search searchbox pagination pager toolbar skip complementary contentinfo".split()
)
#: Words that may stand beside those in one name: site-footer, search-box. Any other word makes it another name (has-sidebar).
_BESIDE = frozenset("site page top bottom left right primary secondary global main header bar box list entry post article".split())
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Lines on either side that smoothing reaches, its standard deviation, and the threshold in means of all ratios.
RADIUS, SIGMA, THRESHOLD = 2, 1.0, 0.5
#: What articles and the strongest cluster outside them need of each other's text to stay.
SHARE = 0.5


def _marked(attributes: list[tuple[str, str | None]]) -> tuple[bool, bool, bool]:
    """Whether a whole name in class, id or role is one of boilerplate, whether one is a header's, and whether the element is hidden."""
    boilerplate = header = False
    for key, value in attributes:
        if key in ("class", "id", "role") and value:
            for name in value.split():
                parts = {x.lower() for x in _NAME_PARTS.findall(name) if not x.isdigit()}
                if name.lower() in _BOILERPLATE or parts & _BOILERPLATE and parts <= _BOILERPLATE | _BESIDE:
                    boilerplate = True
                elif "header" in parts and parts <= _BESIDE:
                    header = True
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and value and re.search(r"display\s*:\s*none", value):
            return False, False, True
    return boilerplate, header, False


@dataclass
class Line:
    text: str
    tags: int
    dropped: bool
    parents: tuple[int, ...]
    article: int  # number of the innermost article, or -1


@dataclass
class _Open:
    tag: str
    number: int
    dropped: bool
    header: bool
    article: int
    hard: bool  # dropped for more than its name
    named: tuple[int, ...]  # numbers of the elements around, and of this one, that are boilerplate by name only


_TOP = _Open("", -1, False, False, -1, False, ())


class PageLines(HTMLParser):
    """Collects the lines of a page from the parser's events; names are not looked at in the elements whose numbers `exempt` has."""

    def __init__(self, exempt: Container[int] = ()) -> None:
        super().__init__(convert_charrefs=True)
        self.exempt = exempt
        #: Characters of the page's text and of each element that is boilerplate by name, and those that hold an article.
        self.size = 0
        self.held: dict[int, int] = {}
        self.holders: set[int] = set()
        self.lines: list[Line] = []
        self.open: list[_Open] = []
        self.parts: list[str] = []
        self.tags = 0
        self.count = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            top = self.open[-1] if self.open else _TOP
            heading = any(x.tag in _HEADING for x in self.open)
            dropped = top.header and not (heading and top.article >= 0)
            blocks = tuple(x.number for x in self.open if x.tag in _BLOCK)
            self.lines.append(Line(text, max(1, self.tags), dropped, blocks[:-1] if blocks else (), top.article))
        self.parts.clear()
        self.tags = 0

    def _close(self, depth: int) -> None:
        if any(x.tag in _BLOCK for x in self.open[depth:]):
            self._end_line()
        del self.open[depth:]

    def _close_open(self, tags: tuple[str, ...], stop: tuple[str, ...]) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag in tags:
                return self._close(depth)
            if self.open[depth].tag in stop:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in _CELL:
            self.parts.append(" ")
        if tag in _ENDS_P:
            self._close_open(("p",), ("article", "main", "section", "td", "th", "button", "object"))
        if tag in _SIBLINGS:
            self._close_open(_SIBLINGS[tag], ("ul", "ol", "dl", "table", "select", "menu"))
        if tag == "body":
            self._close_open(("head",), ())
        above = self.open[-1] if self.open else _TOP
        marked, header, hidden = _marked(attrs)
        # The page's own frame is not boilerplate, whatever its class says, nor is an article, but for one inside another.
        frame = tag in ("html", "body")
        own = tag in _ARTICLE and not any(x.tag == "article" for x in self.open) or frame
        named = (marked or header) and not own and self.count + 1 not in self.exempt
        hard = above.hard or tag in _DROPPED or hidden and not frame
        dropped = above.dropped or hard or marked and named
        if tag in _BLOCK:
            self._end_line()
            self.tags = 1
        if tag in _VOID:
            return
        self.count += 1
        if tag in _ARTICLE and not hard:
            # What is named inside an article (its comments) may hold others.
            within = next((x.number for x in self.open if x.tag in _ARTICLE), self.count)
            self.holders.update(x for x in above.named if x < within)
        article = self.count if tag in _ARTICLE and not dropped else above.article
        names = above.named
        if named:
            names += (self.count,)
            self.held[self.count] = 0
        self.open.append(_Open(tag, self.count, dropped, above.header or tag == "header" or header and named, article, hard, names))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in _CELL:
            self.parts.append(" ")
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag == tag:
                return self._close(depth)

    def handle_data(self, data: str) -> None:
        top = self.open[-1] if self.open else _TOP
        if not top.hard:
            size = len("".join(data.split()))
            self.size += size
            for x in top.named:
                self.held[x] += size
        if not top.dropped:
            self.parts.append(data)


def _parsed(html: str, exempt: Container[int] = ()) -> PageLines:
    parser = PageLines(exempt)
    parser.feed(html)
    parser.close()
    parser._end_line()
    return parser


def page_lines(html: str) -> list[Line]:
    """The lines of a page. A name says nothing of an element that holds an article, nor of one with most of the page's
    text where no article is outside such elements, nor where all of the text is in elements with such names."""
    parser = _parsed(html)
    wrong = set(parser.holders)
    if not any(x.article >= 0 and not x.dropped for x in parser.lines):
        wrong |= {k for k, n in parser.held.items() if 2 * n > parser.size}
    if wrong:
        parser = _parsed(html, wrong)
    if parser.held and all(x.dropped for x in parser.lines):
        parser = _parsed(html, range(parser.count + 1))
    return parser.lines


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian-weighted mean over RADIUS lines on either side; the weights at the ends are scaled up."""
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    middle = slice(RADIUS, RADIUS + len(ratios))
    return np.convolve(ratios, kernel)[middle] / np.convolve(np.ones(len(ratios)), kernel)[middle]


def _common(paths: list[tuple[int, ...]]) -> tuple[int, ...]:
    low, high = min(paths), max(paths)
    n = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    return low[:n]


def _article_lines(kept: list[Line], seeds: np.ndarray) -> set[int]:
    """Lines of the articles that a seed is in or that have SHARE of the largest one's text, with those around and inside them."""
    sizes: dict[int, int] = {}
    for x in kept:
        if x.article >= 0:
            sizes[x.article] = sizes.get(x.article, 0) + len(x.text)
    articles = {kept[i].article for i in seeds if kept[i].article >= 0} | {k for k, n in sizes.items() if n >= SHARE * max(sizes.values())}
    inner = {n for x in kept for n in x.parents if x.article in articles}
    return {i for i, x in enumerate(kept) if x.article in articles or x.article >= 0 and (x.article in inner or articles & set(x.parents))}


def _cluster_region(kept: list[Line], seeds: np.ndarray) -> tuple[set[int], int]:
    """What lies between the lines of the strongest cluster of seeds outside articles, in their common parent, and the cluster's text."""
    seeds = np.array([i for i in seeds if kept[i].article < 0], np.int64)
    if not len(seeds):
        return set(), 0
    clusters = np.split(seeds, np.flatnonzero(np.diff(seeds) > RADIUS) + 1)
    sizes = [sum(len(kept[i].text) for i in c) for c in clusters]
    best = clusters[int(np.argmax(sizes))]
    parent = _common([kept[i].parents for i in best])
    inside = [i for i, x in enumerate(kept) if x.article < 0 and x.parents[: len(parent)] == parent]
    at = {i: k for k, i in enumerate(inside)}
    same = [at[i] for i in seeds.tolist() if i in at]
    low, high = same[0], same[-1]
    # Lines next to the region, with nothing else between.
    while low > 0 and inside[low - 1] == inside[low] - 1 and kept[inside[low - 1]].tags <= 3:
        low -= 1
    while high + 1 < len(inside) and inside[high + 1] == inside[high] + 1 and kept[inside[high + 1]].tags <= 3:
        high += 1
    return set(inside[low : high + 1]), max(sizes)


def content(lines: list[Line]) -> list[Line]:
    """The lines of the page's main text, in order."""
    kept = [x for x in lines if not x.dropped]
    if not kept:
        return []
    score = smoothed(np.array([len(x.text) / x.tags for x in kept]))
    seeds = np.flatnonzero(score >= THRESHOLD * score.mean())
    marked = _article_lines(kept, seeds)
    region, size = _cluster_region(kept, seeds)
    held = sum(len(kept[i].text) for i in marked)
    # Articles and the cluster outside them each stay unless the other has far more text.
    chosen = (marked if held >= SHARE * size else set()) | (region if size >= SHARE * held else set())
    return [kept[i] for i in sorted(chosen)]


def main_text(html: str) -> str:
    """The main text of one page; its blocks joined by an empty line."""
    return "\n\n".join(x.text for x in content(page_lines(html)))


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of each row of `pages`.

    A null or empty html gives an empty text. Null and repeated ids stay, each page is
    read whole and by itself, other columns are not read; no rows give no rows.
    """

    def extract(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "html"):
            texts = pa.array([main_text(x) for x in part.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id").cast(pa.int64()), part.column("url"), texts, pc.utf8_length(texts).cast(pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return by_batch(pages.select("page_id", "url", "html"), extract, "page_id long, url string, text string, n_chars long")
