"""Main text of web pages, by text-to-tag ratios.

The standard library's parser streams events; they are cut into lines at block borders. A line knows its characters, the
tags met while it was read, the characters of links and the elements it stands in. The ratio of plain characters to tags is
smoothed over neighbouring lines with a Gaussian, and two-means clustering of the smoothed ratios sets the threshold between
content and the rest. The lines above it vote, with their characters, for the region they stand in: the article or main
element with most votes, else the smallest element that holds nearly all of them, widened while what is added is headings
and plain text (one long block may hold nearly all votes of an article). All lines of that region are the text, so
short lines and headings inside it stay; elements that never hold article text (menus, headers, footers, sidebars, forms,
scripts, styles, and blocks marked as adverts, notices or comments by class, id or role) are left out everywhere.

Defined results: a null, empty or text-free page gives an empty text; markup that is never closed ends with its parent;
character references are decoded, also those without a semicolon where HTML allows it; a page without any tag is one line;
repeated rows are extracted once each; other columns are left out.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from caselight.llm.common import map_rows

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "head title script style noscript template nav footer aside form button select textarea option iframe svg canvas "
    "object dialog menu".split()
)
REGIONS = frozenset(["article", "main"])
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|popup|modal|newsletter|subscribe|"
    r"comments?|replies|disqus|sidebar|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|share|social|related|"
    r"widget|complementary|contentinfo|search|login|hidden)(?:$|[\s_-])",
    re.IGNORECASE,
)
SIGMA = 1.0
NEARLY_ALL = 0.9
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PLAIN = 20  # characters outside links to a tag, from which a line beside a region is plain text


class Lines(HTMLParser):
    """Collects the lines of a page; feed the whole page, then ``close``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, characters of links, element
        self.parents, self.names = [-1], ["#page"]  # of each element
        self.stack: list[tuple[str, int, bool]] = []  # tag, element, left out
        self.open: dict[str, int] = {}
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def _end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append((text, self.tags, self.linked, self.stack[-1][1] if self.stack else 0))
                self.tags = 0
            self.parts, self.linked = [], 0

    def _pop_to(self, tag: str) -> None:
        while True:
            name, _, _ = self.stack.pop()
            self.open[name] -= 1
            if name == tag:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        block = tag not in INLINE
        if block:
            self._end_line()
            if self.open.get("p"):  # a block ends the paragraph before it
                self._pop_to("p")
        self.tags += 1
        if tag in VOID:
            return
        parent, out = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (0, False)
        if not out:
            out = tag in NEVER or (tag == "header" and not any(self.open.get(r) for r in REGIONS))
            for name, value in () if out or tag in ("html", "body") else attrs:
                if name in ("class", "id", "role") and value and MARKED.search(value):
                    out = tag not in REGIONS or name != "class" or "comment" in value.lower()
                elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                    out = True
        element = parent
        if block:
            element = len(self.parents)
            self.parents.append(parent)
            self.names.append(tag)
        self.stack.append((tag, element, out))
        self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)  # HTML knows no short form; the slash means nothing

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._end_line()
        self.tags += 1
        if self.open.get(tag):
            self._pop_to(tag)

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][2]:
            return
        self.parts.append(data)
        if self.open.get("a"):
            self.linked += len(data)

    def close(self) -> None:
        super().close()
        self._end_line()


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; the ends are not pulled to zero."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(values, kernel)[reach : reach + len(values)] / np.convolve(np.ones(len(values)), kernel)[reach : reach + len(values)]


def split_point(values: np.ndarray) -> float:
    """The threshold of two-means clustering in one dimension; the least value where all are equal."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        middle = (low + high) / 2
        upper = values >= middle
        if upper.all():
            return low
        new_low, new_high = float(values[~upper].mean()), float(values[upper].mean())
        if (new_low, new_high) == (low, high):
            break
        low, high = new_low, new_high
    return (low + high) / 2


def _ancestors(parents: list[int], element: int) -> list[int]:
    found = []
    while element >= 0:
        found.append(element)
        element = parents[element]
    return found


def _widened(page: Lines, ratios: np.ndarray, chosen: np.ndarray, chains: dict[int, list[int]], region: int) -> int:
    """The outermost element around ``region`` on the way to which nearly all added text is content, headings or plain text.

    A very long block raises the threshold over the short ones beside it, so plain text counts by ``PLAIN`` too.
    """
    around = _ancestors(page.parents, region)
    place = {e: i for i, e in enumerate(around)}
    added, good = [0] * len(around), [0] * len(around)
    for (text, _, _, element), ratio, is_content in zip(page.lines, ratios, chosen):
        i = next(place[e] for e in chains[element] if e in place)
        added[i] += len(text)
        if is_content and ratio > 0 or ratio >= PLAIN or any(page.names[e] in HEADINGS for e in chains[element]):
            good[i] += len(text)
    for i in range(1, len(around)):
        if good[i] < NEARLY_ALL * added[i]:
            break
        region = around[i]
    return region


def content_lines(page: Lines, sigma: float = SIGMA) -> list[str]:
    """The lines of the content region."""
    if not page.lines:
        return []
    ratios = np.array([max(0, len(t) - linked) / max(1, tags) for t, tags, linked, _ in page.lines], dtype=float)
    smoothed = smooth(ratios, sigma)
    chosen = smoothed >= split_point(smoothed)
    votes: dict[int, int] = {}
    total = 0
    chains: dict[int, list[int]] = {}
    for (text, _, _, element), is_content in zip(page.lines, chosen):
        if element not in chains:
            chains[element] = _ancestors(page.parents, element)
        if is_content:
            total += len(text)
            for e in chains[element]:
                votes[e] = votes.get(e, 0) + len(text)
    regions = [e for e in votes if page.names[e] in REGIONS and votes[e] >= 0.5 * total]
    if regions:  # the innermost of those that hold nearly as much as the best
        best = max(votes[e] for e in regions)
        region = max(e for e in regions if votes[e] >= NEARLY_ALL * best)
    else:
        region = max(e for e in votes if votes[e] >= NEARLY_ALL * total)
        if page.names[region] == "p":  # a lone paragraph stands for the block around it
            region = page.parents[region]
        region = _widened(page, ratios, chosen, chains, region)
    return [text for text, _, _, element in page.lines if region in chains[element]]


def main_text(html: str | None) -> str:
    """The main text of a page: its blocks, joined by line feeds."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    return "\n".join(content_lines(page))


def extract(pages: DataFrame, key: str = "page_id", html: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """(key, ``keep``, text, n_chars) of every page."""
    kinds = dict(pages.dtypes)
    names = [key, *keep]

    def make():
        def work(batch):
            texts = [main_text(h) for h in batch.column(len(names)).to_pylist()]
            out = {n: batch.column(i) for i, n in enumerate(names)}
            return out | {"text": texts, "n_chars": [len(t) for t in texts]}

        return work

    schema = "".join(f"`{n}` {kinds[n]}, " for n in names) + "text string, n_chars bigint"
    return map_rows(pages.select(*names, html), schema, make)
