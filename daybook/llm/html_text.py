"""The main text of web pages.

The standard library's parser reports tags and text; block-level tags cut the text into lines
(blocks). Each line has a ratio of text length to tags. Ratios are smoothed with a Gaussian
kernel, and lines at or above the standard deviation of all (at most their maximum) are
content. The regions that hold content lines are looked up: an outermost ``article`` or ``main``,
else the nearest enclosing container. The nearest container that encloses them all, or the parent
of a lone article or section, is selected with every line in it, however short its sections. Where an
article or main region holds content lines, only the articles and mains in that container are text. Elsewhere
lines of links that are no content by their ratio do not begin or end the text.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments
are never text, by their tag or by a word of their class, id or role; those that are no blocks, as buttons or
scripts, leave the line around them whole. A class or role
counts by its first or last part between hyphens and underscores, unless ``with``, ``no``, ``has`` or
the like is before it. An id, often made from a heading, counts if all its parts are such words or
words for boxes. Headings, articles, mains and the elements that hold one are not left out by a
word; only lists of comments and of related pages may hold articles and go, unless nothing else is left.
A header inside an article or main is the article's own and stays.

Character references are decoded, white space in a block becomes one space, blocks are trimmed, empty
ones left out, and the rest joined by line breaks. ``br`` is white space. Null and empty html
has the empty text. Nothing depends on other rows. Other columns pass unchanged, except those named
like a result (``text``, ``n_chars``).
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import quoted

SIGMA = 1.0
RADIUS = 3

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("article main section div td body".split())
ARTICLES = frozenset(("article", "main"))
LEFT_OUT = frozenset(
    "nav footer aside form script style noscript template head title iframe svg button select "
    "textarea menu dialog object canvas audio video".split()
)
LEFT_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu "
    "nav navbar navigation breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent "
    "notice notices alert popup modal newsletter subscribe signup login share sharing social "
    "related recommended comment comments disqus replies toolbar pagination pager copyright "
    "complementary contentinfo".split()
)
#: Of these, what may be a list of articles.
LISTS_OF_ARTICLES = frozenset("related recommended comment comments disqus replies reviews responses".split())
#: Further names of reader comments; as ids they are headings as often.
CLASS_WORDS = frozenset("reviews responses".split())
#: Before a word, these say what an element has or lacks, not what it is.
HAVING = frozenset("with without no not has have hide hidden show".split())
#: Parts that leave an id what it is.
BOX_WORDS = frozenset(
    "area bar block blocks bottom box button buttons col column container content div footer form google gpt "
    "group header icons inner item items left links list main outer page panel post posts primary right "
    "row secondary section site slot top unit widget widgets wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Open tags of these end when another of them starts.
SIBLINGS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}


def _names(attrs) -> set[str]:
    """The words by which an element says what it is."""
    names = set()
    for name, value in attrs:
        if not value or name not in ("class", "id", "role"):
            continue
        for token in value.lower().split():
            parts = [part for part in re.split(r"[_-]+", token) if part]
            if name == "id":
                rest = [x for x in parts if x not in LEFT_OUT_WORDS and not x.isdigit()]
                if all(x in BOX_WORDS for x in rest):
                    names.update(parts)
            elif parts and HAVING.isdisjoint(parts[:-1]):
                names.update((parts[0], parts[-1]))
    return names


class _Lines(HTMLParser):
    """Lines of text with their number of tags, region and marks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # tag, left out, region, marks of elements that words name
        self.open: list[tuple[str, bool, int, tuple[int, ...]]] = []
        self.regions: list[bool] = [False]  # whether an article
        self.tags_of: list[str] = [""]
        self.parents: list[int] = [0]
        # whether left out, whether an article was in it, whether it may be a list of articles
        self.marks: list[tuple[bool, bool, bool]] = []
        # parts with their marks and whether in a link, tags, region
        self.lines: list[tuple[list[tuple[str, tuple[int, ...], bool]], int, int]] = []
        self.parts: list[tuple[str, tuple[int, ...], bool]] = []
        self.tags = 0
        self.links = 0

    def _state(self) -> tuple[bool, int, tuple[int, ...]]:
        return self.open[-1][1:] if self.open else (False, 0, ())

    def end_line(self):
        if any(not part.isspace() for part, _, _ in self.parts):
            self.lines.append((self.parts, self.tags, self._state()[1]))
            self.tags = 0
        self.parts = []

    def _pop(self, at: int):
        if any(tag in BLOCKS for tag, *_ in self.open[at:]):
            self.end_line()
        self.links -= sum(tag == "a" for tag, *_ in self.open[at:])
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name in SIBLINGS.get(tag, ()):
                self._pop(at)
                break
            if name in BLOCKS:
                break
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        outside, region, marks = self._state()
        in_article = self.regions[region]
        left_out = tag in LEFT_OUT or (tag == "header" and not in_article)
        left_out = left_out and tag not in ("html", "body")
        if tag in ARTICLES and not outside:
            for mark in marks:  # an element that holds it is left out at most as a list of articles
                kept = tag == "main" or not self.marks[mark][0] or not self.marks[mark][2]
                self.marks[mark] = (not kept, True, self.marks[mark][2])
        words = set() if tag in ARTICLES or tag in HEADINGS or tag in ("html", "body") else _names(attrs)
        named = words & (LEFT_OUT_WORDS | CLASS_WORDS)
        if named or ("header" in words and not in_article):
            marks = (*marks, len(self.marks))
            self.marks.append((True, False, not named.isdisjoint(LISTS_OF_ARTICLES)))
        if tag in CONTAINERS and not in_article:
            self.regions.append(tag in ARTICLES)
            self.tags_of.append(tag)
            self.parents.append(region)
            region = len(self.regions) - 1
        self.links += tag == "a"
        self.open.append((tag, outside or left_out, region, marks))

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        self.tags += 1
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._pop(at)
                return
            if tag not in BLOCKS and self.open[at][0] in BLOCKS:
                return  # an inline tag ends inside its block

    def handle_data(self, data):
        left_out, _, marks = self._state()
        if data and not left_out:
            self.parts.append((data, marks, self.links > 0))


class _Line(NamedTuple):
    text: str
    tags: int
    region: int
    linked: bool  # whether all of it is in links


def _kept(parser: _Lines) -> list[_Line]:
    """The lines without elements left out by a word; the next line counts the tags of a line that went."""
    for gone in ({n for n, x in enumerate(parser.marks) if x[0]}, {n for n, x in enumerate(parser.marks) if x[0] and not x[1]}):
        lines, waiting = [], 0
        for parts, tags, region in parser.lines:
            waiting += tags
            parts = [part for part in parts if gone.isdisjoint(part[1])]
            text = " ".join("".join(part[0] for part in parts).split())
            if text:
                lines.append(_Line(text, waiting, region, all(linked or x.isspace() for x, _, linked in parts)))
                waiting = 0
        if lines:
            break
    return lines


def _around(parser: _Lines, region: int) -> list[int]:
    """The region and those that enclose it, from the outermost one."""
    found = [region]
    while found[-1]:
        found.append(parser.parents[found[-1]])
    return found[::-1]


def _selected(parser: _Lines, chosen: set[int]) -> set[int]:
    """All regions of the container that encloses the chosen ones; articles only, if one is chosen."""
    articles = {region for region in chosen if parser.regions[region]}
    chosen = articles or chosen
    paths = [_around(parser, region) for region in chosen]
    common = [level[0] for level in zip(*paths) if len(set(level)) == 1]
    top = common[-1]
    alone = top in chosen and parser.tags_of[top] in ("article", "main", "section")
    if alone:  # others of its kind beside it belong to it
        top = parser.parents[top]
    kinds = ARTICLES if articles else {"section"}
    inside = {top}
    found = set() if alone else {top}
    for region in range(1, len(parser.regions)):  # parents come first
        parent = parser.parents[region]
        if parent not in inside:
            continue
        if alone and parent == top and parser.tags_of[region] not in kinds:
            continue
        inside.add(region)
        found.add(region)
    return {region for region in found if parser.regions[region]} if articles else found


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing; the kernel is cut at the ends and its weights add to one."""
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    total = np.convolve(ratios, kernel)[RADIUS:-RADIUS]
    return total / np.convolve(np.ones(len(ratios)), kernel)[RADIUS:-RADIUS]


def main_text(html: str | None) -> str:
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.end_line()
    lines = _kept(parser)
    if not lines:
        return ""
    ratios = smoothed(np.array([len(line.text) / max(line.tags, 1) for line in lines]))
    threshold = min(ratios.std(), ratios.max())
    chosen = {line.region for line, ratio in zip(lines, ratios) if ratio >= threshold}
    selected = _selected(parser, chosen)
    found = [(line, ratio >= threshold) for line, ratio in zip(lines, ratios) if line.region in selected]
    if not any(parser.regions[region] for region in selected):
        beside = [line.linked and not content for line, content in found]
        if not all(beside):
            found = found[beside.index(False) : len(beside) - beside[::-1].index(False)]
    return "\n".join(line.text for line, _ in found)


def _main_texts(pages: pd.Series) -> pd.Series:
    return pd.Series([main_text(html) for html in pages], dtype=object)


def html_text(pages: DataFrame) -> DataFrame:
    """The pages with ``text`` and ``n_chars``."""
    main_texts = F.pandas_udf(_main_texts, "string")
    frame = pages.select(
        F.struct(*[F.col(quoted(name)) for name in pages.columns]).alias("row"),
        main_texts(F.col("html").cast("string")).alias("found"),
    )
    kept = [F.col("row")[x].alias(x) for x in pages.columns if x not in ("text", "n_chars")]
    return frame.select(
        *kept, F.col("found").alias("text"), F.length("found").cast("long").alias("n_chars")
    )
