"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, clustering.

The standard library's parser is fed in pieces. Its events cut a page into lines, one per block of
text, each with its number of characters and of tags. The ratios are smoothed with a Gaussian and the
lines above one standard deviation form the content cluster; the element that holds the cluster is
the article. Lines in elements that are never content (menus, footers, forms, what is hidden) count for
nothing. Names of classes and ids only hint at that: they are weighed against the share of the text that
their element holds and the links in it, and never condemn what wraps the article.

Null and empty pages give the empty text. A page of any length is parsed in pieces of bounded size,
and its lines are held once. Repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidebook.llm import base

PIECE = 1 << 16
SIGMA = 1.0
SCHEMA = "page_id long, url string, text string, n_chars long"

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr img br".split()
)
CONTAINERS = frozenset("html body main article section div td th center".split())
DROPPED = frozenset(
    "head title script style noscript template iframe svg math canvas object audio video nav footer aside form "
    "button select option textarea input dialog menu".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox promo promoted promotion sponsor sponsored sidebar "
    "comment comments disqus respond replies reply cookie cookies consent gdpr notice notices banner newsletter "
    "subscribe subscription signup share sharing social related recommended breadcrumb breadcrumbs menu menus nav "
    "navbar navigation footer masthead topbar toolbar popup modal overlay paywall widget widgets pagination pager "
    "skip hidden".split()
)
COMMENT_WORDS = frozenset("comment comments disqus respond replies reply".split())
ROOTS = frozenset(("main", "article"))
HEAD = frozenset("title meta link script style base noscript template".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
#: An element with a hint in its name is content all the same with this share of the page, or, inside of the
#: article, with this share of it and not more than so many of its characters in links.
WRAPS, SECTION, LINKED = 0.8, 0.25, 0.3
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Line:
    """A block of text with the containers around it."""

    within: tuple[int, ...]
    hinted: tuple[int, ...]
    parts: list[str]
    tags: int = 0
    linked: int = 0


class Events(HTMLParser):
    """Collects lines outside the regions that are never part of an article."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.kinds: list[str] = ["page"]
        self.open: list[tuple[str, bool, int | None, bool]] = []
        self.within: tuple[int, ...] = (0,)
        # Elements whose names hint that they are no content, by number: whether they say that they are comments,
        # the containers around them, and whether an article begins in them.
        self.hints: list[tuple[bool, tuple[int, ...]]] = []
        self.wraps: set[int] = set()
        self.hinted: tuple[int, ...] = ()
        self.dropped = 0
        self.links = 0
        self.fresh = True
        self.pending = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.pending += 1
        if tag not in INLINE:
            self.fresh = True
        if tag in VOID:
            return
        if tag not in HEAD and self.inside("head"):
            self.close_to("head")
        if tag in CLOSES_P and self.inside("p") and not self.inside("button"):
            self.close_to("p")
        dropped = tag in DROPPED or tag == "header" and not self.inside("article") or self.hidden(tag, attrs)
        words = self.named(tag, attrs)
        hint = not words.isdisjoint(DROPPED_WORDS) and (tag != "article" or not words.isdisjoint(COMMENT_WORDS))
        if hint:
            self.hinted += (len(self.hints),)
            self.hints.append((not words.isdisjoint(COMMENT_WORDS), self.within))
        elif tag in ROOTS:
            self.wraps.update(self.hinted)
        number = None
        if tag in CONTAINERS:
            number = len(self.kinds)
            self.kinds.append(tag)
            self.within += (number,)
        self.open.append((tag, dropped, number, hint))
        self.dropped += dropped
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.pending += 1
        if tag not in INLINE:
            self.fresh = True
        if self.inside(tag):
            self.close_to(tag)

    def handle_data(self, data: str) -> None:
        if self.dropped:
            return
        if self.fresh:
            self.lines.append(Line(self.within, self.hinted, []))
            self.fresh = False
        line = self.lines[-1]
        line.parts.append(data)
        line.tags += self.pending
        line.linked += len(data) if self.links else 0
        self.pending = 0

    def close_last(self) -> str:
        tag, dropped, number, hint = self.open.pop()
        self.dropped -= dropped
        if hint:
            self.hinted = self.hinted[:-1]
        self.links -= tag == "a"
        if number is not None:
            self.within = self.within[:-1]
        return tag

    def close_to(self, tag: str) -> None:
        while self.close_last() != tag:
            pass

    def inside(self, tag: str) -> bool:
        return any(name == tag for name, _, _, _ in self.open)

    @staticmethod
    def hidden(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        """Whether the attributes say that a region is not shown or what else it is."""
        if tag in ("html", "body", "main"):
            return False
        for key, value in attrs:
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return True
            if key == "role" and value in DROPPED_ROLES:
                return True
            if key == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    @staticmethod
    def named(tag: str, attrs: list[tuple[str, str | None]]) -> set[str]:
        """The words of an element's classes and id."""
        if tag in ("html", "body", "main"):
            return set()
        return {w.lower() for key, value in attrs if key in ("class", "id") and value for w in WORDS.findall(value)}


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Ratios convolved with a Gaussian, weights renormalised at both ends."""
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    size = len(ratios)
    total = np.convolve(ratios, kernel)[reach : reach + size]
    weight = np.convolve(np.ones(size), kernel)[reach : reach + size]
    return total / weight


def unhinted(lines: list[tuple[str, Line]], events: Events) -> list[tuple[str, Line]]:
    """The lines that are left when hints have been weighed against what their elements hold."""
    mass: Counter[int] = Counter()
    linked: Counter[int] = Counter()
    around: Counter[int] = Counter()
    for text, line in lines:
        around.update({number: len(text) for number in line.within})
        for hint in line.hinted:
            mass[hint] += len(text)
            linked[hint] += line.linked
    gone = set()
    for hint, (comment, within) in enumerate(events.hints):
        article_around = [n for n in within if events.kinds[n] == "article"]
        wrapper = not comment and (hint in events.wraps or mass[hint] >= WRAPS * around[0])
        section = not comment and article_around and mass[hint] >= SECTION * around[article_around[-1]] and linked[hint] <= LINKED * mass[hint]
        if not wrapper and not section:
            gone.add(hint)
    return [(text, line) for text, line in lines if gone.isdisjoint(line.hinted)]


def innermost(numbers: list[int], lines: list[tuple[str, Line]]) -> list[int]:
    """Of some elements those that hold no other of them."""
    outer = {n for _, line in lines for n in line.within if n in numbers and any(m in numbers for m in line.within[line.within.index(n) + 1 :])}
    return [n for n in numbers if n not in outer]


def article(lines: list[tuple[str, Line]], kinds: list[str]) -> list[str]:
    """The lines of the elements that hold the cluster of high text-to-tag ratios."""
    if not lines:
        return []
    ratios = np.array([len(text) / max(1, line.tags) for text, line in lines], dtype=float)
    smooth = smoothed(ratios)
    content = smooth >= min(smooth.std(), smooth.max())
    mass: Counter[int] = Counter()
    for (text, line), chosen in zip(lines, content, strict=True):
        if chosen and 2 * line.linked <= len(text):
            for number in line.within:
                mass[number] += len(text)
    total = mass[0]
    holders = innermost([n for n, m in mass.items() if kinds[n] in ROOTS and 2 * m >= total], lines)
    if not holders:
        # Several articles that together are most of the page.
        several = innermost([n for n, m in mass.items() if kinds[n] == "article" and 5 * m >= total], lines)
        if 2 * sum(mass[n] for n in several) >= total:
            holders = several
    if not holders:
        holders = [max((n for n, m in mass.items() if 10 * m >= 8 * total), default=-1)]
    kept = []
    inner = [(text, line) for text, line in lines if any(n in line.within for n in holders)]
    linked = [10 * line.linked >= 8 * len(text) for text, line in inner]
    for i, (text, line) in enumerate(inner):
        listed = linked[i] and sum(linked[max(0, i - 2) : i + 3]) >= 3
        if not listed or any(kinds[n] == "article" for n in line.within):
            kept.append(text)
    return kept


def extract(html: str) -> str:
    """Main text of one page: blocks in page order, joined by one space."""
    events = Events()
    for at in range(0, len(html), PIECE):
        events.feed(html[at : at + PIECE])
    events.close()
    lines = [(text, line) for line in events.lines if (text := " ".join("".join(line.parts).split()))]
    return " ".join(article(unhinted(lines, events), events.kinds))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page with its main text and its length in code points."""

    def rows(batch: pa.RecordBatch):
        found = [extract(html) for html in base.texts(batch, "html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    return base.over_batches(pages.select("page_id", "url", "html"), rows, SCHEMA)
