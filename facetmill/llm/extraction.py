"""Main text of HTML pages: text-to-tag ratios of lines, smoothed and clustered, pick the content region.

The standard library's streaming parser gives events; from them come lines, one for
each block of text, with the number of tags met on the way to it and the characters
that stand in links. A line's ratio is that of its text outside links to its tags. It
is smoothed over the lines by a Gaussian and cut at a threshold drawn from its spread:
what lies above are content lines. The region reaches from the first content line that
is above by its own ratio to the last, short blocks between them included, and on to the lines around that stand in
the same container (or the same article or main element) and are not mostly links,
such as a heading or a short last paragraph.

What stands in elements for menus, headers, footers, sidebars, forms and scripts is
left out beforehand. So is an element whose class, id or role is made up of words for
such parts alone ("cookie-banner", but not "social-history"), unless it holds most of
the page's content: the ratio decides against the name.

Defined cases: null and empty pages, and pages without a block outside such parts,
give an empty text; a tag or comment cut off by the page's end is markup, not text; a
menu or the like that is not closed by a tag of its own leaves out nothing by its
name; of lines with equal ratios all are content or none; repeated rows get equal
results; a table without rows gives none; extra columns pass through, and input
columns named like an added one are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import add_columns

ADDED = T.StructType([T.StructField("main_text", T.StringType())])

SIGMA = 1.5

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_DROPPED = frozenset(
    "head title nav header footer aside form script style noscript template button select textarea input svg canvas iframe object dialog menu datalist".split()
)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"))
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dt dd tr td th".split()
)
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_BARRIER = frozenset(("ul", "ol", "dl", "table", "article", "main", "body"))
# What text is set in; a block's container is the element around these.
_TEXTUAL = _HEADINGS | frozenset("p li ul ol dl dt dd table thead tbody tfoot tr td th caption pre blockquote figure figcaption details summary address".split())
# Elements left out by their tag if a tag of their own closes them.
_CLOSED = frozenset("nav header footer aside form menu dialog object".split())
# Words of class, id and role that mark what is not main text.
_PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent gdpr notice notices "
    "alert alerts popup modal overlay sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer footers masthead toolbar comment comments commentlist disqus "
    "reply replies respond share sharing social related recommended newsletter subscribe subscription signup login search searchbox pagination pager contentinfo complementary skip".split()
)
_ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion".split())
_HEADS = frozenset(("header", "topbar", "banner"))
# Words that say nothing of their own next to those.
_NEUTRAL = frozenset(
    "area bar block bottom box btn button buttons col column container content desktop fixed float floating form group header holder icon icons inner item items left link links list "
    "main mobile module outer page panel right row section site slot small sticky text title top unit widget widgets wrap wrapper".split()
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
_SPACE = re.compile(r"\s+")
_CUT_OFF = re.compile(r"<(?:[a-zA-Z/!?]|\Z)")
# Share of a line's text in links from which it is a list of links, and of the page's content that no name takes away.
LINKED, MOST = 0.5, 0.5


def _names(attributes: list[tuple[str, str | None]]) -> list[list[str]]:
    """The words of each name in class, id, role and label."""
    held = [v for name, v in attributes if v and name in ("class", "id", "role", "aria-label")]
    return [[w.lower() for w in _WORD.findall(name)] for value in held for name in value.split()]


def _marked(attributes: list[tuple[str, str | None]]) -> bool:
    return any(set(words) & _PARTS and set(words) <= _PARTS | _NEUTRAL for words in _names(attributes))


def _advert(attributes: list[tuple[str, str | None]]) -> bool:
    """Whether a name calls an element an advert; of elements inside a line only these are left out by name."""
    return any(set(words) & _ADVERTS and set(words) <= _PARTS | _NEUTRAL for words in _names(attributes))


def _hidden(attributes: list[tuple[str, str | None]]) -> bool:
    return any(
        name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and value and _HIDDEN.search(value) for name, value in attributes
    )


def _heads(attributes: list[tuple[str, str | None]]) -> bool:
    """Whether class or id call an element the head of the page."""
    return any(set(words) & _HEADS and set(words) <= _HEADS | _PARTS | _NEUTRAL for words in _names(attributes))


@dataclass
class _Element:
    tag: str
    parent: int
    gone: bool  # left out whatever it holds
    named: bool  # left out by its name
    closed: bool = False


@dataclass
class _Line:
    text: str
    tags: int
    linked: int
    element: int
    gone: bool


class _Lines(HTMLParser):
    """Blocks of text in page order, and the elements around them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements: list[_Element] = []
        # Open elements: their tag, number (of the block around for inline ones), and whether their text is passed over.
        self.stack: list[tuple[str, int, bool]] = []
        self.lines: list[_Line] = []
        self.text: list[str] = []
        self.open: Counter[str] = Counter()
        self.count = self.linked = 0

    def _flush(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            self.text.clear()
            if text:
                _, number, gone = self.stack[-1] if self.stack else ("", -1, False)
                self.lines.append(_Line(text, self.count, min(self.linked, len(text)), number, gone))
                self.count = 0
        self.linked = 0

    def _pop(self, at: int, own: bool) -> None:
        """Closes the open elements from ``at`` on, the first of them by its ``own`` tag or not."""
        if self.stack[at][0] not in _INLINE:
            self._flush()
            self.elements[self.stack[at][1]].closed = own
        self.open.subtract(tag for tag, _, _ in self.stack[at:])
        del self.stack[at:]

    def _push(self, tag: str, number: int, passed: bool) -> None:
        self.stack.append((tag, number, passed))
        self.open[tag] += 1

    def _pop_inline(self) -> None:
        while self.stack and self.stack[-1][0] in _INLINE:
            self._pop(len(self.stack) - 1, False)

    def _close_within(self, tags: tuple[str, ...] | frozenset[str]) -> None:
        if not any(self.open[t] for t in tags):
            return None
        for at in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[at][0]
            if tag in tags:
                return self._pop(at, True)
            if tag in _BARRIER or tag in ("div", "section") and "p" not in tags:
                return None
        return None

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.count += 1
        if tag in _INLINE:
            if tag == "br":
                self.text.append(" ")
            elif tag not in _VOID:
                _, number, gone = self.stack[-1] if self.stack else ("", -1, False)
                self._push(tag, number, gone or _hidden(attributes) or _advert(attributes))
            return
        linked = self.open["a"]
        self._pop_inline()
        self._flush()
        if tag in _CLOSES_P:
            self._close_within(("p",))
        if tag in _SAME:
            self._close_within(_SAME[tag])
        if tag in _VOID:
            return
        if tag in ("article", "main"):
            # These begin the content: a menu or header still open before them was never closed.
            while self.stack and self.stack[-1][0] in _CLOSED:
                self._pop(len(self.stack) - 1, False)
        within = self.open["article"] or self.open["main"]
        by_tag = tag in _DROPPED and not (tag == "header" and within)
        gone = _hidden(attributes) or by_tag and tag not in _CLOSED
        named = by_tag and tag in _CLOSED or tag not in ("body", "html", "article", "main") and _marked(attributes)
        if not within and tag in ("div", "section") and _heads(attributes):
            named = True
        self._open(tag, gone, named)
        if linked and tag not in _DROPPED:
            # A link around blocks goes on inside them.
            self._push("a", *self.stack[-1][1:])

    def _open(self, tag: str, gone: bool, named: bool) -> None:
        _, above, passed = self.stack[-1] if self.stack else ("", -1, False)
        self.elements.append(_Element(tag, above, gone, named))
        self._push(tag, len(self.elements) - 1, gone or passed)

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attributes)

    def handle_endtag(self, tag: str) -> None:
        self.count += 1
        if tag not in _INLINE:
            self._pop_inline()
            self._flush()
        if not self.open[tag]:
            return None
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                return self._pop(at, True)
            if tag in _INLINE and self.stack[at][0] not in _INLINE:
                return None
        return None

    def handle_data(self, data: str) -> None:
        if not (self.stack and self.stack[-1][2] and self.stack[-1][0] in _INLINE):
            self.text.append(data)
            if self.open["a"]:
                self.linked += len(data.strip())

    def read(self, html: str) -> None:
        self.feed(html)
        if _CUT_OFF.match(self.rawdata):
            # A tag or comment that the page's end cuts off.
            self.rawdata = ""
        self.close()
        while self.stack:
            self._pop(len(self.stack) - 1, False)
        self._flush()

    def inherited(self, start: int, own: Callable[[int, int], int]) -> list[int]:
        """A value for each element from its number and its parent's value, and ``start`` for none around (the last entry)."""
        out: list[int] = []
        for number, element in enumerate(self.elements):
            out.append(own(number, out[element.parent] if element.parent >= 0 else start))
        return [*out, start]


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """The Gaussian mean around each value, over the values there are."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel, "full")[reach : reach + len(ratio)]
    return np.convolve(ratio, kernel, "full")[reach : reach + len(ratio)] / weight


def content_lines(sizes: np.ndarray, tags: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Which lines lie above the threshold of the smoothed text-to-tag ratio."""
    smooth = smoothed(sizes / np.maximum(tags, 1), sigma)
    return smooth >= min(smooth.std(), smooth.max())


def bounding_lines(sizes: np.ndarray, tags: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Which content lines lie above the threshold by their own ratio too: not only for their neighbours'."""
    ratio = sizes / np.maximum(tags, 1)
    smooth = smoothed(ratio, sigma)
    limit = min(smooth.std(), smooth.max())
    return (smooth >= limit) & (ratio >= limit)


def _unnamed(page: _Lines, lines: list[_Line]) -> list[_Line]:
    """The lines outside elements that are left out by name, but for those that hold most of the content."""
    named = [e.named and (e.closed or e.tag not in _CLOSED) for e in page.elements]
    if not any(named):
        return lines
    free = np.array([len(x.text) - x.linked for x in lines], float)
    good = content_lines(free, np.array([x.tags for x in lines], float))
    held = np.zeros(len(named) + 1)
    np.add.at(held, [x.element for x in lines], free * good)
    for number in range(len(named) - 1, -1, -1):
        held[page.elements[number].parent] += held[number]
    most = held > MOST * (free * good).sum()
    keeps = page.inherited(1, lambda e, above: int(above and (not named[e] or most[e] and page.elements[e].tag not in _CLOSED)))
    return [x for x in lines if keeps[x.element]]


def _region(page: _Lines, lines: list[_Line]) -> list[_Line]:
    """The lines of the content region."""
    free = np.array([len(x.text) - x.linked for x in lines], float)
    links = np.array([x.linked >= LINKED * len(x.text) for x in lines])
    good = bounding_lines(free, np.array([x.tags for x in lines], float)) & ~links
    if not good.any():
        return [x for x, linked in zip(lines, links) if not linked]
    first, last = np.flatnonzero(good)[[0, -1]]
    container = page.inherited(-1, lambda e, above: above if page.elements[e].tag in _TEXTUAL else e)
    article = page.inherited(-1, lambda e, above: e if above < 0 and page.elements[e].tag in ("article", "main") else above)
    containers = {container[x.element] for x, ok in zip(lines, good) if ok}
    articles = {article[x.element] for x, ok in zip(lines, good) if ok} - {-1}

    def belongs(at: int, x: _Line) -> bool:
        return first <= at <= last or not links[at] and (container[x.element] in containers or article[x.element] in articles)

    return [x for at, x in enumerate(lines) if belongs(at, x)]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = _Lines()
    page.read(html)
    lines = [x for x in page.lines if not x.gone]
    lines = _unnamed(page, lines) if lines else []
    return "\n".join(x.text for x in _region(page, lines)) if lines else ""


def extract(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` with main_text."""
    return add_columns(pages, html, ADDED, lambda texts: [pa.array([main_text(x) for x in texts.to_pylist()], pa.string())], keep)
