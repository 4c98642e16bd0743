"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clusters."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that nest and that an end tag closes; others (p, li, b, ...) only begin and end lines.
CONTAINER = frozenset(
    "article aside blockquote body center details dialog div dl fieldset figure footer form head header html main menu "
    "nav ol search section table ul button select textarea noscript script style svg template iframe object canvas "
    "math audio video title".split()
)
#: Elements whose text is never part of an article.
DROPPED = frozenset(
    "aside button canvas dialog footer form head iframe menu nav noscript object script search select style svg "
    "template textarea title audio video".split()
)
#: Words of a class, id or role that mark what stands beside an article.
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments "
    "commentlist complementary contentinfo consent cookie cookies dialog disqus disclaimer dropdown footer gdpr header "
    "masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "popup promo promoted promotion related reply replies respond search share sharing sidebar sidenav signup skip "
    "social sponsor sponsored subscribe tags teaser toolbar topbar widget widgets alert".split()
)
#: Words of a class that tell a state of the element and not what it is: has-sidebar, comments-open.
STATES = frozenset("has with without no is are open opened closed enabled disabled on off".split())
ARTICLE_WORDS = frozenset("articlebody article-body main".split())
LISTS = frozenset("ul ol dl".split())
#: Elements that are regions: what clusters and marks choose between.
REGIONS = LISTS | frozenset("article main section div table blockquote".split())
#: Markup that the end of a page leaves open: a tag, a comment, a declaration.
_OPEN_MARKUP = re.compile(r"<[A-Za-z/!?]")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")

#: Lines on each side that smoothing reaches, and its deviation in lines.
RADIUS, SIGMA = 4, 1.5
#: Marks are a prior only: ratios of lines within article or main count this much more.
PRIOR = 2.0
#: The marks are believed while they hold this share of the content; an element that holds INNER of it is gone into.
BELIEVED, INNER = 0.5, 0.9


#: How surely an element stands beside the article: its name has a word of BESIDE, or consists of such words.
LOOSE, EXACT = 1, 2


def beside(named: str) -> int:
    """How surely an element with these names, in small letters, stands beside the article; 0 if not."""
    level = 0
    for name in named.split():
        words = _WORD.findall(name)
        if BESIDE.intersection(words) and not STATES.intersection(words):
            level = max(level, EXACT if BESIDE.issuperset(words) else LOOSE)
    return level


@dataclass
class Region:
    """An element that may hold the article, or by its name stands beside it."""

    parent: int
    main: bool = False
    beside: int = 0
    is_list: bool = False


@dataclass
class Line:
    region: int
    text: str
    tags: int
    linked: int = 0


@dataclass
class Page(HTMLParser):
    """Lines of a page outside of dropped elements, with the regions they are in."""

    lines: list[Line] = field(default_factory=list)
    regions: list[Region] = field(default_factory=lambda: [Region(-1)])

    def __post_init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self._stack: list[tuple[str, int, bool, int]] = []
        self._open: Counter[str] = Counter()
        self._region, self._dropped, self._marks = 0, False, 0
        self._text: list[str] = []
        self._tags, self._linked, self._in_link = 0, 0, False

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self._text)).strip()
        if text:
            self.lines.append(Line(self._region, text, self._tags, min(self._linked, len(text))))
            self._tags = 0
        self._text.clear()
        self._linked = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        if tag == "br":
            self._text.append(" ")
        if tag == "a":
            self._in_link = True
        if tag in BLOCK:
            self.flush()
        if tag not in CONTAINER:
            return
        if tag not in BLOCK and tag in DROPPED:
            self._text.append(" ")
        inside = self._marks > 0
        self._stack.append((tag, self._region, self._dropped, self._marks))
        self._open[tag] += 1
        self._marks += tag in ("article", "main")
        if self._dropped:
            return
        named = " ".join(v for k, v in attrs if v and k in ("class", "id", "role", "itemprop")).lower()
        level = beside(named) if tag not in ("body", "html", "main") else 0
        if tag == "article" and level == LOOSE:
            level = 0
        if tag in DROPPED or tag == "header" and not inside or level and tag not in BLOCK:
            self._dropped = True
        elif level or tag in REGIONS:
            main = tag in ("article", "main") or bool(ARTICLE_WORDS.intersection(named.split()))
            self.regions.append(Region(self._region, main, level, tag in LISTS))
            self._region = len(self.regions) - 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag == "a":
            self._in_link = False
        if tag in BLOCK:
            self.flush()
        if not self._open[tag]:  # nothing to close: the stack is not searched
            return
        above = []
        while not above or above[-1] != tag:
            name, region, dropped, marks = self._stack.pop()
            self._open[name] -= 1
            above.append(name)
        if any(name in BLOCK for name in above):
            self.flush()
        self._region, self._dropped, self._marks = region, dropped, marks

    def handle_data(self, data: str) -> None:
        if not self._dropped:
            self._text.append(data)
            if self._in_link:
                self._linked += len(data)

    def close(self) -> None:
        """The end of the page; a tag or comment that it leaves open is no text, and is not searched again."""
        if not _OPEN_MARKUP.match(self.rawdata):
            super().close()
        self.flush()


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; edges take what weights they have."""
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    padded = np.convolve(ratios, kernel)[RADIUS : RADIUS + len(ratios)]
    return padded / np.convolve(np.ones(len(ratios)), kernel)[RADIUS : RADIUS + len(ratios)]


def content_lines(lines: list[Line], prior: np.ndarray | float = 1.0) -> np.ndarray:
    """Lines whose smoothed text-to-tag ratio, times its prior, is in the upper of two clusters, split where they balance."""
    ratio = smoothed(np.array([len(line.text) / max(line.tags, 1) for line in lines], dtype=float) * prior)
    cut = ratio.mean()
    for _ in range(20):
        low, high = ratio[ratio < cut], ratio[ratio >= cut]
        if not len(low) or not len(high):
            break
        moved = (low.mean() + high.mean()) / 2
        if moved == cut:
            break
        cut = moved
    return ratio >= min(cut, ratio.max())


def _within(regions: list[Region], sums: list[int]) -> list[int]:
    """Sums over each region and all regions in it; those follow it in the list."""
    sums = list(sums)
    for at in range(len(regions) - 1, 0, -1):
        sums[regions[at].parent] += sums[at]
    return sums


def _outermost(regions: list[Region], here: list[bool]) -> list[int]:
    """For each region the outermost one around it, or it itself, that is ``here``; -1 if none is."""
    found: list[int] = []
    for at, region in enumerate(regions):
        above = found[region.parent] if region.parent >= 0 else -1
        found.append(above if above >= 0 else (at if here[at] else -1))
    return found


def _free_heavy(page: Page, in_article: list[bool]) -> None:
    """Where no article or main is left outside of what stands beside, names of heavy elements stop to count.

    Such an element has more than half of the text, and its name is loose or it holds an article or main of its
    own.  Elements that heavy lie in each other, so they are freed from the outermost on until an article shows.
    """
    regions = page.regions
    nearest: list[int] = []
    for at, region in enumerate(regions):
        nearest.append(at if region.beside else (nearest[region.parent] if region.parent >= 0 else -1))
    size, marked = [0] * len(regions), [0] * len(regions)
    shows: set[int] = set()
    for line in page.lines:
        size[line.region] += len(line.text)
        if in_article[line.region]:
            marked[line.region] += 1
            shows.add(nearest[line.region])
    size, marked = _within(regions, size), _within(regions, marked)
    if -1 in shows:
        return
    for at, region in enumerate(regions):
        if region.beside and 2 * size[at] > size[0]:
            if not marked[at] and region.beside != LOOSE:
                return
            region.beside = 0
            if at in shows:
                return


def _without_beside(page: Page) -> list[Line]:
    """Lines outside of what by its name stands beside the article; their tags count for the line after them."""
    regions = page.regions
    in_article: list[bool] = []
    for region in regions:
        own = region.main and region.beside != EXACT
        in_article.append(own or region.parent >= 0 and in_article[region.parent])
    _free_heavy(page, in_article)
    root = _outermost(regions, [bool(r.beside) for r in regions])
    kept, tags = [], 0
    for line in page.lines:
        tags += line.tags
        if root[line.region] < 0:
            kept.append(Line(line.region, line.text, tags, line.linked))
            tags = 0
    return kept


def _chosen(regions: list[Region], marked: list[int], content: list[int], links: list[bool]) -> tuple[set[int], set[int]]:
    """Regions whose lines are the article, and those around them whose own lines are as well.

    ``content`` counts the letters of content lines in each region.  Marked regions, but for those of links, are chosen
    while they hold ``BELIEVED`` of it together; otherwise, and without marks, the innermost region with ``INNER`` of it.
    """
    roots = {at for at, root in enumerate(marked) if root == at and not links[at]}
    if roots and sum(content[at] for at in roots) >= BELIEVED * content[0]:
        return roots, set()
    # Each of these holds more than half, so they lie in each other.
    chain = [at for at, region in enumerate(regions) if content[at] >= INNER * content[0] and not region.is_list]
    return {chain[-1]}, set(chain[:-1])


def main_text(html: str | None) -> str:
    """The article of a page: lines of the regions that the content clusters lie in, joined by empty lines.

    The clusters of smoothed ratios, to which marks (article, main) are a prior, say which lines are content.  They
    choose the regions (``_chosen``) and, within these, leave out regions of links: such as have more than
    half of their text in links and less than half of it in content lines.  All other lines of a chosen region are kept, short ones as well,
    and so is what stands directly in the elements around it, such as a headline.  The time taken grows with the
    length of the page, however deep its elements nest.
    """
    page = Page()
    page.feed(html or "")
    page.close()
    lines = _without_beside(page)
    if not lines:
        return ""
    regions = page.regions
    marked = _outermost(regions, [r.main for r in regions])
    prior = np.array([PRIOR if marked[line.region] >= 0 else 1.0 for line in lines])
    own, text, linked = [0] * len(regions), [0] * len(regions), [0] * len(regions)
    for line, is_content in zip(lines, content_lines(lines, prior), strict=True):
        own[line.region] += len(line.text) * bool(is_content)
        text[line.region] += len(line.text)
        linked[line.region] += line.linked
    content, text, linked = _within(regions, own), _within(regions, text), _within(regions, linked)
    if not content[0]:
        return ""
    links = [2 * n > t and 2 * c < t for c, n, t in zip(content, linked, text, strict=True)]
    chosen, around = _chosen(regions, marked, content, links)
    kept: list[bool] = []
    inside: list[bool] = []
    for at, region in enumerate(regions):
        within = region.parent >= 0 and inside[region.parent] and not links[at]
        inside.append(at in chosen or within)
        kept.append(inside[at] or at in around)
    return "\n\n".join(line.text for line in lines if kept[line.region])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; other columns are ignored.

    A null or empty html, or one without text, gives an empty text.  Null ids and urls stay
    null; repeated rows are extracted each on its own.  Pages are parsed whole, as a stream of
    parser events, one at a time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(html) for html in batch["html"]]
            yield pd.DataFrame({
                "page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts,
                "n_chars": [len(t) for t in texts],
            })

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInPandas(run, "page_id bigint, url string, text string, n_chars bigint")
