"""HTML extraction by text-to-tag ratios (operator 3).

The standard library's streaming parser turns a page into lines, one for each
block of text, with the number of tags it holds and the elements around it.
A line's ratio is its characters outside links per tag, up to ``FULL``.  Tags,
roles and the words of class and id are evidence that changes the ratio: lines
in menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
or reader comments have ratio 0.  The ratios are smoothed with a Gaussian
within runs of like lines, and lines above the page's threshold, between two
clusters of ratios, are the content.

This is done twice.  The first clusters show the region: the outermost article
and main elements (an articleBody where there are none) if they hold most of
the clusters' text, else the smallest container that holds all clusters.  That
is evidence for the second time: lines of the region gain ``INSIDE`` characters
per tag, lines beside it keep ``OUTSIDE`` of theirs.  If the region is the whole
body, lines between the first and the last cluster gain, and the ratios alone
decide at its ends.  The clusters found then choose the lines of the text.

Class and id words do not mark what holds a main element or the page's article
or h1, and ids in headings do not count.  Inside an article or main element
ambiguous words (``related``, ``register``, ``widget``) and the aside of an
article take away the region's gain and no more, so running text stays and
short or linked lines go; adverts, comments, menus and the like go everywhere.

Character references are decoded, white space in a block becomes one space,
blocks are joined in page order by two newlines.  Time is linear in the page.
Defined results: null or empty html, or a page without text outside links,
gives the empty text; unclosed and stray tags are taken as browsers do in
simple cases; repeated pages are extracted one by one; an empty table gives no
rows; extra columns of any name pass through, but html is dropped and columns
named text or n_chars are replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import map_column, prepare

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav "
                   "ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split())
SPACES = frozenset("br td th".split())
DROPPED = frozenset("script style noscript template head title svg math iframe object canvas audio video nav footer "
                    "aside form button select textarea label dialog menu search fieldset".split())
#: A start tag ends an open element of these, unless one of ``LIMITS`` lies between them.
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",)}
LIMITS = ("ul", "ol", "dl", "table", "div", "select")
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar "
                  "toolbar".split())
#: Words of class or id that mark boilerplate.
MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner "
                  "cookie cookies consent gdpr notice notification newsletter subscribe subscription popup modal "
                  "overlay sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead "
                  "comment comments disqus replies related recommended share sharing social toolbar widget widgets "
                  "login signin signup register search pagination pager paywall skip copyright colophon".split())
HEADERS = frozenset("header topbar siteheader pageheader".split())
REGIONS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold many blocks; a region is one of them.
CONTAINERS = frozenset("article body center details dir div html main section".split())
#: Words of what others wrote, which may be articles as well.
OTHERS = frozenset("comment comments replies disqus ad advert sponsored related recommended".split())
#: Words that also name parts of an article: inside one they only take its gain away.
AMBIGUOUS = frozenset("related recommended register search widget widgets notice notification share sharing promotion "
                      "banner overlay copyright colophon login skip topbar header".split())
#: How an element is marked: by a word of class or id, by one of ``OTHERS``, by tag, role or attributes.
WORD, OTHER, HARD = 1, 2, 3
#: Evidence in characters per tag: the most a line can have, the gain inside the region, and the share kept beside it.
FULL, INSIDE, OUTSIDE = 200.0, 100.0, 0.02
#: No page's threshold lies above this.
HIGHEST_CUT = 40.0
SIGMA = 1.0
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


class _Lines(HTMLParser):
    """Parser events -> lines (text, tags, link characters, innermost element, heading)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple] = []
        self.open: list[tuple[str, int]] = []          # tag, element number
        self.at: dict[str, list[int]] = defaultdict(list)   # places of a tag among the open ones
        self.tag: list[str] = [""]
        self.parent: list[int] = [-1]
        self.mark: list[int] = [0]
        self.soft: list[bool] = [False]          # marked by ambiguous words alone
        self.region: list[bool] = [False]
        self.body: list[bool] = [False]          # itemprop articleBody
        self.text: list[str] = []
        self.tags = self.links = self.in_link = self.in_region = self.in_article = 0
        self.heading = False

    def _flush(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            if text:
                number = self.open[-1][1] if self.open else 0
                self.lines.append((text, self.tags + 1, self.links, number, self.heading))
                self.tags = 0
            self.text, self.links = [], 0

    def _count(self, e: int, by: int) -> None:
        if self.region[e] or self.body[e]:
            self.in_region += by
            self.in_article += by * (self.tag[e] != "main")

    def _pop(self, i: int) -> None:
        for tag, e in self.open[i:]:
            self.at[tag].pop()
            self._count(e, -1)
        del self.open[i:]

    def _last(self, tags: Iterable[str]) -> int:
        """The innermost place of any of these tags among the open ones, or -1."""
        return max((self.at[t][-1] for t in tags if self.at[t]), default=-1)

    def _marked(self, tag: str, attrs: dict) -> tuple[int, bool]:
        if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
            return HARD, False
        if "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
            return HARD, False
        if (attrs.get("role") or "").lower() in ROLES or tag == "header" and not self.in_region:
            return HARD, False
        aside = tag == "aside" and self.in_article > 0
        if tag in DROPPED and not aside:
            return HARD, False
        names = (attrs.get("class") or "").lower()
        if tag not in HEADINGS and self._last(HEADINGS) < 0:  # headings have generated ids
            names += " " + (attrs.get("id") or "").lower()
        words = set(_SPLIT.split(names))
        if tag in ("html", "body", "main", "article"):
            return (OTHER if tag == "article" and words & OTHERS else 0), False
        meant = words & (MARKS | OTHERS)
        if not self.in_region and tag not in ("h1", "h2"):
            meant |= words & HEADERS
        if words & OTHERS:
            return OTHER, meant <= AMBIGUOUS
        return (WORD if meant or aside else 0), meant <= AMBIGUOUS

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in SPACES:
            self.text.append(" ")
        if tag == "a":
            self.in_link += 1
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        if tag in BLOCKS:
            self._flush()
            if self.open and self.open[-1][0] == "p":
                self._pop(len(self.open) - 1)
            if tag in SAME:
                same = self._last(SAME[tag])
                if same >= 0 and same > self._last(LIMITS):
                    self._pop(same)
        attrs = dict(attrs)
        own, soft = self._marked(tag, attrs)
        if tag in BLOCKS or own:
            number = len(self.parent)
            self.parent.append(self.open[-1][1] if self.open else 0)
            self.tag.append(tag)
            self.mark.append(own)
            self.soft.append(soft)
            self.region.append(tag in REGIONS or (attrs.get("role") or "").lower() in ("main", "article"))
            self.body.append("articlebody" in (attrs.get("itemprop") or "").lower())
            self.at[tag].append(len(self.open))
            self.open.append((tag, number))
            self._count(number, 1)
            if tag == "h1":
                self.heading = True

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if tag in SPACES:
            self.text.append(" ")
        if self.at[tag]:
            if tag in BLOCKS:
                self._flush()
            self._pop(self.at[tag][-1])
        if tag == "h1":
            self.heading = False

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] not in BLOCKS:
            return  # a marked inline element inside a block
        self.text.append(data)
        if self.in_link:
            self.links += len(data.strip())

    def finish(self) -> None:
        self.close()
        self._flush()

    # An element's number is above its parent's, so one pass over the numbers goes down or up the tree.

    def unmark(self, others: bool = False) -> None:
        """Take the words' marks off what holds a main element, or the least marked articles and h1 of the page.

        Articles inside ``OTHERS`` or marked more than others are comments or teasers; with ``others`` they count too.
        """
        worst, held = [0] * len(self.tag), [0] * len(self.tag)
        kept = []
        for e in range(1, len(self.tag)):
            up = self.parent[e]
            worst[e] = max(worst[up], self.mark[e])
            held[e] = held[up] + (self.mark[e] > 0)
            if self.region[e] or self.tag[e] == "h1":
                free = others or self.tag[e] in ("main", "h1")
                if worst[e] < (HARD if free else OTHER):
                    kept.append(e)
        clear = [False] * len(self.tag)
        for title in (False, True):
            of_kind = [e for e in kept if (self.tag[e] == "h1") == title]
            least = min((held[e] for e in of_kind), default=0)
            for e in of_kind:
                clear[e] = held[e] == least or self.tag[e] == "main"
        for e in range(len(self.tag) - 1, 0, -1):
            if clear[e]:
                self.mark[e] = 0
                clear[self.parent[e]] = True

    def levels(self, region: list[bool] | None = None) -> np.ndarray:
        """Each element's mark, its own or that of one around it: 0, WORD (soft, inside ``region``) or HARD."""
        out = np.zeros(len(self.tag), int)
        for e in range(1, len(self.tag)):
            up = self.parent[e]
            own = 0 if not self.mark[e] else HARD
            if own and region and region[up] and self.soft[e] and self.mark[e] < HARD and not self.region[e]:
                own = WORD
            out[e] = max(out[up], own)
        return out

    def sums(self, elements: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The lines' values summed over each element with all it holds."""
        out = np.bincount(elements, values, len(self.tag))
        for e in range(len(self.tag) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out

    def find_region(self, elements: np.ndarray, plain: np.ndarray, mass: np.ndarray) -> tuple[list[bool], bool, bool]:
        """(elements of the region, whether article or main elements make it, whether it is the whole body)."""
        held = self.sums(elements, plain.astype(float))
        inside = self.sums(elements, mass)
        for flags in (self.region, self.body):
            found, weight = [False] * len(self.tag), 0.0
            for e in range(1, len(self.tag)):
                found[e] = found[self.parent[e]]
                if not found[e] and flags[e] and held[e]:
                    found[e] = True
                    weight += inside[e]
            if weight and weight >= 0.5 * inside[0]:
                return found, True, False
        region = int(np.flatnonzero(inside >= inside[0] - 1e-6)[-1])   # later elements are inner ones along one chain
        while region and self.tag[region] not in CONTAINERS:
            region = self.parent[region]
        found = [e == region for e in range(len(self.tag))]
        for e in range(1, len(self.tag)):
            found[e] = found[e] or found[self.parent[e]]
        return found, False, self.tag[region] in ("", "html", "body")


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing, the ends taking only what is there."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(values, kernel)[reach:reach + len(values)]
    weight = np.convolve(np.ones(len(values)), kernel)[reach:reach + len(values)]
    return full / weight


def threshold(values: np.ndarray) -> float:
    """The cut between two clusters of ratios: two-means on their logarithm, 0 always in the lower one."""
    logs = np.append(np.log1p(values), 0.0)
    lo, hi = 0.0, logs.max()
    for _ in range(25):
        high = logs > (lo + hi) / 2
        if not high.any():
            break
        after = (logs[~high].mean(), logs[high].mean())
        if after == (lo, hi):
            break
        lo, hi = after
    return min(float(np.expm1((lo + hi) / 2)), HIGHEST_CUT)


def clusters(ratio: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The lines above the threshold after smoothing within runs of one kind."""
    smoothed = np.concatenate([smooth(run) for run in np.split(ratio, np.flatnonzero(np.diff(kind)) + 1)])
    if not smoothed.max() > 0:
        return np.zeros(len(ratio), bool)
    return smoothed >= threshold(smoothed) - 1e-9


def kinds(level: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Lines that smooth each other: of one mark; two or more linked lines in a row are by themselves, one is not."""
    row = np.concatenate([[False], linked, [False]])
    return 2 * level + (linked & (row[:-2] | row[2:]))


def extract(html: str | None) -> str:
    """The main text of one page."""
    parser = _Lines()
    parser.feed(html or "")
    parser.finish()
    lines = parser.lines
    if not lines:
        return ""
    element = np.array([x[3] for x in lines])
    for others in (False, True):
        parser.unmark(others)
        marked = parser.levels()[element] > 0
        if not marked.all():
            break
    else:
        return ""
    length = np.array([len(x[0]) for x in lines], float)
    share = np.array([min(1.0, x[2] / max(1, len(x[0]))) for x in lines])
    linked = share >= 0.5
    ratio = np.minimum(FULL, length * (1 - share) / np.array([x[1] for x in lines]))
    plain = ~marked & ~linked
    first = clusters(np.where(marked, 0.0, ratio), kinds(marked.astype(int), linked)) & ~marked
    if not (first & plain).any():
        first = plain if plain.any() else ~marked
    region, semantic, whole = parser.find_region(element, plain, np.where(first, length, 0.0))
    level = parser.levels(region if semantic else None)[element]
    inside = np.array(region)[element]
    gains = inside & (level == 0) & (semantic | ~linked)
    if whole:
        place = np.flatnonzero(first)
        gains[:place[0]] = gains[place[-1] + 1:] = False
    keeps = inside.copy()
    heads = [i for i, x in enumerate(lines) if x[4] and level[i] == 0]
    if len(heads) == 1 and not (gains[heads[0]] and inside[heads[0]]):  # the title above the region
        start = int(np.argmax(gains)) if gains.any() else heads[0]
        if not any(parser.region[e] and region[e] for e in range(len(region))):  # and the lead between them
            gains[heads[0]:start] |= plain[heads[0]:start]
        gains[heads[0]] = True
    keeps |= gains
    ratio = np.where(level == HARD, 0.0, ratio * np.where(keeps, 1.0, OUTSIDE) + INSIDE * gains)
    # the region's edge ends a run, so that lines beside it gain nothing by smoothing
    chosen = clusters(ratio, 2 * kinds(level, linked & ~gains) + keeps)
    return "\n\n".join(x[0] for x, keep in zip(lines, chosen) if keep)


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without its html column, with text and n_chars."""
    prepare(pages.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for values in batches:
            texts = [extract(t) for t in values]
            yield pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    return map_column(pages, html, {"text": "string", "n_chars": "long"}, run)
