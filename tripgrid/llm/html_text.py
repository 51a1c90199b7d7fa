"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing, clustering.

The standard library parser streams events; every block boundary ends a line. A line's ratio is
its code points over the tags met since the line before. The ratios are smoothed with a Gaussian; a
two-means threshold on their logarithms separates content lines from the rest; ratios that lie
within a factor of two are all content. For marks, every line
of ``DENSE`` code points a tag counts, and every line of an article or main element.

Elements that hold no text of a page (scripts, menus, lists of choices) are left out from the
start. Forms, asides, page headers, footers and elements whose names speak of notices, comments and
the like are only marked: their content lines count ``MARKED`` (comments: ``REMARKS``) of their
length against the unmarked ones. A mark is void where that is still more, provided that the element
encloses an article, main element or page title, or ``LONG`` code points of content while no
unmarked article has any. The largest marked element is decided first; marks inside a void one are
decided anew. What stays marked is left out.

The content region is the article (or main) element with most content lines, together with its
siblings of at least ``SIBLING`` of its content and, if it has no title, what stands between the
title of the main element around it and itself. Without such elements it is the stretch from the
first to the last content line, with the page title in front of it. All lines of the region are kept, in page order.

Defined cases: null or empty html gives an empty text; a page without content lines gives an
empty text; unclosed and stray tags are tolerated, at any depth in linear time; repeated rows give
repeated results; other columns are handed through.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: element names of the HTML standard, by role
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
DROPPED = set(
    "button canvas datalist dialog head iframe input map menu meter nav noscript object option progress script select style svg "
    "template textarea title".split()
)
ASIDE = {"aside", "footer", "form"}
SIBLINGS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}
# fixed values: words of class, id and role names that mark what is not the article
NOISE = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|copyright|disclaimer|disqus|"
    r"footer|gdpr|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|pager|pagination|popup|promo\w*|"
    r"related|replies|reply|respond|share|sharing|sidebar|signup|site-header|skip|social|sponsor\w*|subscribe|subscription|"
    r"toolbar|topbar|widget|complementary|contentinfo|search|alert|dialog)(?:$|[-_\s\d])",
    re.I,
)
REMARK = re.compile(r"(?:^|[-_\s])(?:comments?|commentlist|disqus|replies|reply|respond)(?:$|[-_\s\d])", re.I)
# names of wrappers that only say what the page has
HAS = re.compile(r"^(?:has|no|with|without)[-_]|[-_](?:open|closed|enabled|disabled)$", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SPACE = re.compile(r"\s+")
SIGMA = 1.0
MARKED, REMARKS, LONG, SIBLING = 0.2, 0.02, 500, 0.5
#: ratios within a factor of two form one cluster; a line of so many code points a tag counts for or against a mark
APART, DENSE = math.log(2), 25


class _Lines(HTMLParser):
    """Collects (parts by mark, tags, section, is a title) for every line of a page.

    Mark 0 is none; ``marks`` has the mark around each mark and its weight, ``titled`` the marks around titles and articles.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int]] = []  # tag, left out, mark, section
        self.depth: Counter[str] = Counter()
        self.lines: list[tuple[list[tuple[int, str]], int, int, bool]] = []
        self.parts: list[tuple[int, str]] = []
        self.tags = 0
        self.marks: list[tuple[int, float]] = [(0, 1.0)]
        self.titled: set[int] = set()
        self.sections: list[tuple[str, int]] = [("page", 0)]

    def end_line(self) -> None:
        if self.parts:
            section = self.open[-1][3] if self.open else 0
            self.lines.append((self.parts, self.tags, section, self.depth["h1"] > 0))
            self.parts, self.tags = [], 0

    def _pop(self, size: int) -> None:
        self.depth.subtract(x[0] for x in self.open[size:])
        del self.open[size:]

    def _close(self, tag: str, within: set[str]) -> None:
        if not self.depth[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == tag:
                self._pop(i)
                return
            if name in within:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        left_out, mark, section = self.open[-1][1:] if self.open else (False, 0, 0)
        if tag == "br":
            self.parts.append((mark, " "))
            return
        if tag in BLOCK:
            self.end_line()
            self._close("p", {"table", "td", "th", "button", "div", "article", "section", "main", "li"})
            if tag in SIBLINGS:
                self._close(tag, SIBLINGS[tag])
            left_out, mark, section = self.open[-1][1:] if self.open else (False, 0, 0)
        if tag in VOID:
            return
        if not left_out:
            left_out = tag in DROPPED
            weight = MARKED if tag in ASIDE or (tag == "header" and not section) else 1.0
            for name, value in attrs:
                if name == "hidden" or (name == "aria-hidden" and value == "true"):
                    left_out = True
                elif name in ("class", "id", "role") and value and tag not in ("html", "body", "article", "main"):
                    names = [CAMEL.sub("-", x) for x in value.split() if not HAS.search(x)]
                    if any(NOISE.search(x) for x in names):
                        weight = min(weight, REMARKS if any(REMARK.search(x) for x in names) else MARKED)
            if weight < 1 and not left_out:
                self.marks.append((mark, weight))
                mark = len(self.marks) - 1
            if tag in ("article", "main", "h1") and not left_out:
                self.titled.add(mark)
            if tag in ("article", "main") and not left_out and self.sections[section][0] != "article":
                self.sections.append((tag, section))
                section = len(self.sections) - 1
        self.open.append((tag, left_out, mark, section))
        self.depth[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash does not close other than void elements

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.end_line()
        if self.depth[tag]:
            self._pop(next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag))

    def handle_data(self, data: str) -> None:
        _, left_out, mark, _ = self.open[-1] if self.open else ("", False, 0, 0)
        if not left_out:
            self.parts.append((mark, data))


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing; weights are renormalised at both ends."""
    reach = math.ceil(3 * sigma)
    weight = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(reach + 1)]
    out = []
    for i in range(len(values)):
        near = range(max(0, i - reach), min(len(values), i + reach + 1))
        out.append(sum(values[j] * weight[abs(i - j)] for j in near) / sum(weight[abs(i - j)] for j in near))
    return out


def threshold(values: list[float]) -> float:
    """Two-means split of the values; the border between the two clusters."""
    low, high = min(values), max(values)
    for _ in range(50):
        border = (low + high) / 2
        below, above = [v for v in values if v <= border], [v for v in values if v > border]
        if not above:
            return border
        new = (sum(below) / len(below), sum(above) / len(above))
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _live(page: _Lines, live: list[bool]) -> tuple[list[tuple[str, int, int, bool]], list[bool]]:
    """Lines (text, tags, section, is a title) of the parts whose marks are ``live``, and which of them are content."""
    lines, tags = [], 0
    for parts, n, section, title in page.lines:
        tags += n
        text = SPACE.sub(" ", "".join(x for mark, x in parts if live[mark])).strip()
        if text:
            lines.append((text, tags, section, title))
            tags = 0
    if not lines:
        return [], []
    ratio = smooth([math.log1p(len(text) / max(1, tags)) for text, tags, _, _ in lines])
    border = min(threshold(ratio), max(ratio)) if max(ratio) - min(ratio) > APART else min(ratio)
    return lines, [r >= border for r in ratio]


def void_marks(page: _Lines) -> list[bool]:
    """For each mark, whether nothing around it is left out."""
    n = len(page.marks)
    everything = smooth([math.log1p(sum(len(x) for _, x in parts) / max(1, tags)) for parts, tags, _, _ in page.lines])
    border = min(threshold(everything), math.log1p(DENSE))
    own, told = [0] * n, [0] * n  # code points of counted lines by innermost mark, and those in articles
    for (parts, _, section, _), r in zip(page.lines, everything, strict=True):
        if section or r >= border:
            for mark, x in parts:
                size = len(SPACE.sub(" ", x).strip())
                own[mark] += size
                told[mark] += size if section else 0
    whole, titled = own[:], [m in page.titled for m in range(n)]
    inner: dict[int, list[int]] = defaultdict(list)
    for m in range(n - 1, 0, -1):  # a mark's number is above that of the mark around it
        around = page.marks[m][0]
        whole[around] += whole[m]
        titled[around] = titled[around] or titled[m]
        inner[around].append(m)
    live, outside, articles = [True] + [False] * (n - 1), own[0], told[0]
    waiting = [(-whole[m], m) for m in inner[0]]
    heapq.heapify(waiting)
    while waiting:
        _, m = heapq.heappop(waiting)
        if whole[m] * page.marks[m][1] > outside and (titled[m] or (whole[m] >= LONG and not articles)):
            live[m] = True
            outside, articles = outside + own[m], articles + told[m]
            for x in inner[m]:
                heapq.heappush(waiting, (-whole[x], x))
    return live


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page.end_line()
    if not page.lines:
        return ""
    lines, content = _live(page, void_marks(page))
    if not lines:
        return ""
    kinds = {page.sections[section][0] for _, _, section, _ in lines}
    wanted = "article" if "article" in kinds else "main" if "main" in kinds else ""
    mass: dict[int, int] = defaultdict(int)
    for (text, _, section, _), good in zip(lines, content, strict=True):
        if good and wanted and page.sections[section][0] == wanted:
            mass[section] += len(text)
    if not mass:
        at = [i for i, good in enumerate(content) if good]
        begin = next((i for i in range(at[0], -1, -1) if lines[i][3]), at[0])
        return "\n".join(text for text, _, _, _ in lines[begin : at[-1] + 1])
    best = max(mass, key=lambda s: (mass[s], -s))
    around = page.sections[best][1]
    kept = {s for s, size in mass.items() if page.sections[s][1] == around and size >= SIBLING * mass[best]}
    first = next(i for i, (_, _, section, _) in enumerate(lines) if section in kept)
    front = []
    if around and not any(title for _, _, section, title in lines if section in kept):
        titles = [i for i, (_, _, section, title) in enumerate(lines[:first]) if title and section == around]
        front = [text for text, _, section, _ in lines[titles[0] : first] if section == around] if titles else []
    return "\n".join(front + [text for text, _, section, _ in lines if section in kept])


def extract_main_text(html: Column) -> Column:
    """Main text of an html column."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(x) for x in batch], dtype="object")

    return run(html)
