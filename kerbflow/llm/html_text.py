"""Main text of web pages by text-to-tag ratios.

Parser events are cut into lines (blocks).  Each line has a ratio of text to tags; ratios
are smoothed along the page by a Gaussian and split in two clusters.  Lines of the upper
cluster are content, and so are the other lines of every article element that directly or
in an inner article holds one of them; no chosen line is dropped.

Menus, footers, forms and elements with telling names (whole words of class, id and role)
are left out, unless they hold the article or most of the page's text; inside an article
the ratios decide about names.
"""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import own_names

OUTPUTS = ("text", "n_chars")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "audio button canvas datalist head iframe noscript object script select style svg template textarea title video".split()
)
# Elements that are not the article, unless they hold it.
ASIDE_TAGS = frozenset("aside dialog footer form header menu nav".split())
# Elements that stand inside running text; their names decide nothing.
TEXT_TAGS = frozenset("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 legend li p pre summary td th tr".split())
# Whole class, id and role names that tell what is not the article.
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising alert alerts banner breadcrumb breadcrumbs comment comments commentlist "
    "consent contentinfo cookie cookies copyright disclaimer disqus footer form gdpr header hidden login masthead menu modal "
    "nav navbar navigation newsletter notice notices notification pagination pager popup promo promoted promotion related "
    "recommended reply replies responses search share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "topbar warning widget widgets".split()
)
# Of these, names that articles also give to their own parts.
PART_NAMES = frozenset("alert alerts disclaimer header notice notices warning".split())
CONTAINERS = frozenset(("article", "main"))
SIGMA = 1.0  # lines
# Two clusters are told apart only if the lower one is this poor in text, and so much
# poorer than the upper one; else all lines belong together.
POOR, APART = 8.0, 4.0


@dataclass
class Line:
    text: str
    tags: int
    container: int  # number of the enclosing article element, 0 for none
    asides: tuple[int, ...] = ()  # numbers of the enclosing elements that may not be the article


@dataclass
class Aside:
    """An element that may not be the article, by its tag or by its names."""

    container: int  # number of the article element around it, 0 for none
    named: bool  # told by its names only


class LineReader(HTMLParser):
    """Collects lines; what stands in silent elements is left out, and lines in elements
    that may not be the article name those.

    Elements that were never closed end with the element around them.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = 0
        self.open: list[tuple[str, bool, int, tuple[int, ...]]] = []  # tag, silent, container, asides
        self.counts: dict[str, int] = {}
        self.around = [0]  # of each container, the one around it
        self.inside: list[tuple[int, ...]] = [()]  # of each container, the asides around it
        self.found: list[Aside] = []

    @property
    def silent(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    @property
    def container(self) -> int:
        return self.open[-1][2] if self.open else 0

    @property
    def asides(self) -> tuple[int, ...]:
        return self.open[-1][3] if self.open else ()

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, self.tags, self.container, self.asides))
        self.parts, self.tags = [], 0

    def _close(self, tag: str) -> None:
        if not self.counts.get(tag):
            return
        while True:
            name = self.open.pop()[0]
            self.counts[name] -= 1
            if name == tag:
                return

    def _aside(self, tag: str, attrs: list[tuple[str, str | None]]) -> Aside | None:
        if tag in ("html", "body", "article", "main"):
            return None
        if tag in ASIDE_TAGS and not (tag == "header" and self.container):
            return Aside(self.container, False)
        names: set[str] = set()
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names.update(value.lower().split())
            elif key == "hidden" or key == "aria-hidden" and value == "true":
                return Aside(self.container, False)
        if tag in TEXT_TAGS or tag not in BLOCKS or names.isdisjoint(ASIDE_NAMES - PART_NAMES if self.container else ASIDE_NAMES):
            return None
        return Aside(self.container, True)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            if tag == "body":
                self._close("head")
            elif tag in ("p", "li", "option", "dt", "dd", "tr", "td", "th") and self.open and self.open[-1][0] == tag:
                self._close(tag)
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        silent = self.silent or tag in SILENT
        container, asides = self.container, self.asides
        if not silent and (aside := self._aside(tag, attrs)):
            asides += (len(self.found),)
            self.found.append(aside)
        if tag in CONTAINERS and not silent:
            self.around.append(container)
            self.inside.append(asides)
            container = len(self.around) - 1
        self.open.append((tag, silent, container, asides))
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.parts.append(data)


def read_page(html: str) -> LineReader:
    reader = LineReader()
    try:
        reader.feed(html)
        reader.close()
    except AssertionError:  # a marked section that the parser does not know
        reader = LineReader()
        reader.feed(html.replace("<![", "&lt;!["))
        reader.close()
    reader.flush()
    return reader


def _without_asides(page: LineReader) -> list[Line]:
    """Lines that no element around them takes away.

    An element that holds more than half of the page's text is the page, whatever its name,
    and so is one that holds its longest article, if that is longer than all text outside
    articles and asides.  Inside an article a name takes away only what the page's clusters
    leave out too.
    """
    lines = page.lines
    whole = sum(len(line.text) for line in lines)
    within = [0] * len(page.found)  # text of each aside
    outside = 0
    size = [0] * len(page.around)  # text of each container, with the containers in it
    for line in lines:
        for aside in line.asides:
            within[aside] += len(line.text)
        outside += len(line.text) if not line.container and not line.asides else 0
        at = line.container
        while at:
            size[at] += len(line.text)
            at = page.around[at]
    best = max(range(len(size)), key=size.__getitem__)
    # A container lies in all asides that are open where it starts.
    held = set(page.inside[best]) if best and size[best] > outside else set()
    going = {i for i in range(len(within)) if 2 * within[i] <= whole and i not in held}
    judged = {i for i in going if page.found[i].named and page.found[i].container}
    rest = [line for line in lines if (going - judged).isdisjoint(line.asides)]
    if judged and rest:
        least = least_ratio(rest)
        for i in judged:
            own = [line for line in lines if i in line.asides]
            if sum(len(line.text) for line in own) >= least * max(1, sum(line.tags for line in own)):
                going.discard(i)
    return [line for line in lines if going.isdisjoint(line.asides)]


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian weights along the page, renewed to one at its ends."""
    reach = int(3 * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, weights)[reach : reach + len(ratios)] / np.convolve(np.ones(len(ratios)), weights)[reach : reach + len(ratios)]


def _clusters(lines: list[Line]) -> tuple[np.ndarray, float]:
    """Smoothed log ratios, and the least one of the content cluster."""
    ratios = np.array([len(line.text) / max(1, line.tags) for line in lines])
    value = np.log1p(smoothed(ratios))
    low, high = value.min(), value.max()
    for _ in range(50):
        upper = value >= (low + high) / 2
        if upper.all():
            break
        centres = value[~upper].mean(), value[upper].mean()
        if centres == (low, high):
            break
        low, high = centres
    if np.expm1(low) >= POOR or np.expm1(high) < APART * np.expm1(low):
        return value, -np.inf
    return value, (low + high) / 2


def content_lines(lines: list[Line]) -> np.ndarray:
    """True for lines of the content cluster."""
    value, least = _clusters(lines)
    return value >= least


def least_ratio(lines: list[Line]) -> float:
    """The ratio from which text belongs to the content cluster."""
    return float(np.expm1(_clusters(lines)[1]))


def main_text(html: str | None) -> str:
    """The page's main text, one block per line."""
    page = read_page(html or "")
    lines = _without_asides(page)
    if not lines:
        return ""
    chosen = content_lines(lines)
    # Articles grow to their ends around chosen lines, those around them included.
    grown: set[int] = set()
    for line, good in zip(lines, chosen):
        at = line.container if good else 0
        while at and at not in grown:
            grown.add(at)
            at = page.around[at]
    return "\n".join(line.text for line, good in zip(lines, chosen) if good or line.container in grown)


@own_names
def extract_text(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Add ``text`` and ``n_chars`` (its characters) to each row.

    Null and empty pages have an empty text; pages of any length are read whole; rows are
    neither merged nor dropped and nothing is shuffled; an empty table gives none.
    """

    @F.pandas_udf("string")
    def text(html: pd.Series) -> pd.Series:
        return html.map(lambda h: main_text(h if isinstance(h, str) else None))

    html = df.withColumn("_html", F.col(html_col)).drop(*OUTPUTS)
    return html.withColumn("text", text("_html")).drop("_html").withColumn("n_chars", F.length("text").cast("long"))
