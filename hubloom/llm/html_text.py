"""Main text of web pages by line-block distribution.

1. Markup is stripped; every block element starts a new line. Scripts, styles and
   other elements without text of the page are left out.
2. Lines in menus, headers, footers, sidebars, notices, adverts, forms and reader
   comments (by element, role, class or id) are taken out. A class or id names these if
   all its words do, but for words of layout such as "box" or "left". Where only some do,
   as in "related-work" or "comments-open", the lines decide: those outside an article
   that are mostly links, or short beside the rest of the page, are taken out. If class
   names leave no text at all, only elements and roles count. A line's weight is its
   length outside links, in a marked article its whole length.
3. The weights are summed over windows of WINDOW lines. Text surges where a window
   rises from nothing to at least SURGE, and dives where the sums return to nothing.
   What lies between is kept, whatever its links, with linked headings and paragraphs
   within a window of it. So is weaker text in the same container as a surge, and a
   list of links between kept lines of one container. On a page without a surge any
   weight is one.
4. Where the page marks an article (article, main), that is done with its lines alone
   and with the others alone. The heaviest region decides, one in the article counting
   ARTICLE times: if it is the article's, only lines in articles are text; if not, the
   mark does not hold the page's body, and step 3 takes all lines.

A page takes time in proportion to its length, and pages are independent.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubloom.llm.texts import chunks

WINDOW = 3
SURGE = 60
#: How many times a region in a marked article counts.
ARTICLE = 4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[A-Za-z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg",
        "math", "object", "canvas", "select", "noembed", "noframes", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd",
          "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
          "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
          "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search",
          "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
_OUTSIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "button",
            "fieldset", "search"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert",
          "dialog", "alertdialog", "menu", "menubar"}
_NAMES = {"ad", "ads", "advert", "advertisement", "adverts", "sponsor", "sponsored", "promo",
          "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header",
          "masthead", "footer", "sidebar", "aside", "widget", "notice", "cookie", "cookies",
          "consent", "gdpr", "banner", "popup", "modal", "newsletter", "subscribe", "signup",
          "login", "share", "sharing", "social", "related", "comment", "comments", "disqus",
          "replies", "respond", "toolbar", "pagination", "pager"}
#: Words by which a class tells what a page has beside it, as in "with-sidebar".
_LAYOUT = {"with", "without", "has", "no"}
#: Words beside these names that say nothing of what an element holds.
_PLAIN = {"area", "bar", "block", "body", "bottom", "box", "button", "buttons", "center", "col",
          "column", "container", "content", "fixed", "float", "form", "global", "group", "icon",
          "icons", "id", "inner", "item", "items", "left", "line", "link", "links", "list", "main",
          "mobile", "module", "outer", "overlay", "page", "panel", "policy", "post", "posts",
          "primary", "right", "row", "secondary", "section", "site", "slot", "stories", "sub",
          "tag", "text", "thread", "title", "top", "unit", "user", "wrap", "wrapper"}
#: Elements that mark the article.
_CONTENT = {"article", "main"}
#: Elements that group lines; a line's container is the innermost.
_CONTAINERS = {"article", "main", "section", "div", "td", "th", "dialog", "details"}
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_CLOSES_P = _BLOCK - {"html", "body", "head"}
#: Elements of single paragraphs and of the article, which a class word alone can't mark.
_TEXT = {"p", "pre", "blockquote", "article", "main", *_HEADINGS}
#: What marks an element: nothing, some words of its class, its class, its role or name.
FREE, DOUBTED, NAMED, OUTSIDE = range(4)

def _marked(attributes: str) -> int:
    """How far class, id or role name boilerplate."""
    found = FREE
    for key, value in _ATTRIBUTE.findall(attributes):
        value = _CAMEL.sub("-", value.strip("\"'"))
        if key.lower() == "role":
            if _ROLES.intersection(value.lower().split()):
                return OUTSIDE
            continue
        for one in value.lower().split():
            words = set(_WORD.findall(one))
            if words & _NAMES and not words & _LAYOUT:
                rest = {w for w in words - _NAMES - _PLAIN if not w.isdigit()}
                found = max(found, DOUBTED if rest else NAMED)
    return found


class _Line(NamedTuple):
    text: str
    #: Length outside links.
    weight: int
    #: The highest mark of the elements it stands in.
    mark: int
    #: Number of the outermost doubted element, 0 without.
    doubted: int
    article: bool
    container: int
    heading: bool
    listed: bool


class _Open:
    """Open elements, how many of them have each mark or are articles, and all containers.

    A container has its parent's number and its first line and the one behind its last;
    number 0 is the page.
    """

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, bool]] = []
        self.names: Counter[str] = Counter()
        self.marks = [0, 0, 0, 0]
        self.articles = self.lines = self.doubts = 0
        self.parents, self.first, self.behind = [0], [0], [-1]
        self.inside = [0]

    def push(self, name: str, mark: int, article: bool) -> None:
        self.stack.append((name, mark, article))
        self.names[name] += 1
        if mark == DOUBTED and not self.marks[DOUBTED]:
            self.doubts += 1
        self.marks[mark] += 1
        self.articles += article
        if name in _CONTAINERS:
            self.parents.append(self.inside[-1])
            self.inside.append(len(self.first))
            self.first.append(self.lines)
            self.behind.append(-1)

    def close(self, name: str) -> None:
        """Closes the innermost element of a name and what is open within it."""
        while self.names[name]:
            last, mark, article = self.stack.pop()
            self.names[last] -= 1
            self.marks[mark] -= 1
            self.articles -= article
            if last in _CONTAINERS:
                self.behind[self.inside.pop()] = self.lines
            if last == name:
                break

    def close_paragraph(self) -> None:
        """A block ends the paragraph it stands in, unless another block is between."""
        if self.names["p"]:
            for name, _, _ in reversed(self.stack):
                if name == "p":
                    self.close("p")
                    break
                if name in _BLOCK:
                    break


def _lines(html: str, opened: _Open) -> Iterator[_Line]:
    parts: list[str] = []
    linked = links = at = 0
    size = len(html)

    def flush() -> Iterator[_Line]:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            opened.lines += 1
            mark = max((m for m in (DOUBTED, NAMED, OUTSIDE) if opened.marks[m]), default=FREE)
            yield _Line(text, max(0, len(text) - linked), mark,
                        opened.doubts if opened.marks[DOUBTED] else 0, opened.articles > 0, opened.inside[-1],
                        any(opened.names[h] for h in _HEADINGS), opened.names["li"] > 0)
        parts.clear()
        linked = 0

    while at < size:
        token = _TOKEN.match(html, at)
        at = token.end()
        if (text := token["text"]) is not None:
            text = unescape(text)
            parts.append(text)
            if links:
                linked += len(text.strip())
            continue
        if token["name"] is None:
            continue
        name, attributes = token["name"].lower(), token["attributes"]
        if token["end"]:
            if name in _BLOCK:
                yield from flush()
            if name == "a":
                links = max(0, links - 1)
            opened.close(name)
            continue
        if name in _RAW:
            if not (attributes.endswith("/") and name in ("svg", "math")):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = end.end() if end else size
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in _BLOCK:
            yield from flush()
            if name in _CLOSES_P:
                opened.close_paragraph()
        if name in _VOID or attributes.endswith("/"):
            continue
        if name == "a":
            links += 1
        article = name in _CONTENT
        if name in _BLOCK or name in _OUTSIDE:
            mark = OUTSIDE if name in _OUTSIDE else FREE
            if not mark and name not in ("html", "body", "main"):
                mark = _marked(attributes)
                if mark == DOUBTED and name in _TEXT:
                    mark = FREE
            opened.push(name, mark, article)
        elif name in ("span", "ins") and (mark := _marked(attributes)) > DOUBTED:
            opened.push(name, mark, False)
    yield from flush()


def _regions(weights: list[int], least: int) -> list[tuple[int, int, bool]]:
    """From each surge to its dive, ends exclusive, and whether it rose to `least`.

    Sums run over WINDOW lines from each line on; a region has no lines without weight
    at its ends.
    """
    sums = [sum(weights[i:i + WINDOW]) for i in range(len(weights))]
    regions, start, risen = [], -1, False
    for i, total in enumerate([*sums, 0]):
        if total and start < 0:
            start, risen = i, False
        if start >= 0 and total >= least:
            risen = True
        if not total and start >= 0:
            while not weights[start]:
                start += 1
            regions.append((start, i, risen))
            start = -1
    return regions


def _surges(weights: list[int]) -> list[tuple[int, int, bool]]:
    """Regions; where none rises to SURGE, any weight is a surge."""
    regions = _regions(weights, SURGE)
    return regions if any(r[2] for r in regions) else [(a, b, True) for a, b, _ in regions]


def _container(start: int, end: int, lines: list[_Line], opened: _Open,
               first: list[int], behind: list[int]) -> int:
    """The innermost container of all lines from start to end, or around it those
    that hold nothing else, with the one that holds more; the page only if need be."""
    at = lines[start].container
    while at and behind[at] < end:
        at = opened.parents[at]
    while opened.parents[at] and first[at] >= start and behind[at] <= end:
        at = opened.parents[at]
    return at


def _widened(start: int, end: int, lines: list[_Line]) -> tuple[int, int]:
    """With the linked lines within a window: headings before, and paragraphs beside."""
    a, b = start, end
    while a > max(0, start - WINDOW + 1) and not lines[a - 1].listed and (
            lines[a - 1].heading or lines[a - 1].container == lines[start].container):
        a -= 1
    while b < min(len(lines), end + WINDOW - 1) and not lines[b].listed and (
            lines[b].container == lines[end - 1].container):
        b += 1
    return a, b


def _kept(lines: list[_Line], weights: list[int], at: list[int], opened: _Open) -> list[bool]:
    """Which lines are text; `at` has the place among them of each line of the page."""
    first = [at[i] for i in opened.first]
    behind = [at[i] if i >= 0 else len(lines) for i in opened.behind]
    regions = _surges(weights)
    near = [0] * (len(lines) + 1)
    for start, end, risen in regions:
        if risen:
            held = _container(start, end, lines, opened, first, behind)
            near[first[held]] += 1
            near[behind[held]] -= 1
    near = list(accumulate(near))
    kept, last = [False] * len(lines), -1
    for start, end, risen in regions:
        if not (risen or near[start] and near[end - 1]):
            last = -1
            continue
        a, b = _widened(start, end, lines)
        if last >= 0 and {x.container for x in lines[last:start]} == {
                lines[last].container, lines[start].container} and (
                lines[last].container == lines[start].container):
            a = min(a, last)
        kept[a:b] = [True] * (b - a)
        last = end - 1
    return kept


def _weight(line: _Line) -> int:
    return len(line.text) if line.article else line.weight


def _heaviest(page: list[_Line], chosen: list[bool]) -> int:
    """Weight of the heaviest region of the chosen lines."""
    weights = [_weight(x) for x, c in zip(page, chosen, strict=True) if c]
    return max((sum(weights[a:b]) for a, b, risen in _surges(weights) if risen), default=0)


def _unmarked(page: list[_Line]) -> list[bool]:
    """Which lines are no boilerplate."""
    free = [x.mark == FREE for x in page]
    rest = sum(x.weight for x, f in zip(page, free, strict=True) if f)
    weights: Counter[int] = Counter()
    lengths: Counter[int] = Counter()
    for x in page:
        if x.mark == DOUBTED:
            weights[x.doubted] += x.weight
            lengths[x.doubted] += len(x.text)

    def stays(x: _Line) -> bool:
        if x.mark != DOUBTED or 2 * weights[x.doubted] < lengths[x.doubted]:
            return x.mark == FREE
        return x.article or weights[x.doubted] >= min(SURGE, rest)
    chosen = [stays(x) for x in page]
    if not any(x.text for x, c in zip(page, chosen, strict=True) if c):
        return [x.mark != OUTSIDE for x in page]
    return chosen


def main_text(html: str | None) -> str:
    """The page's main text: kept lines, joined by two newlines."""
    opened = _Open()
    page = list(_lines(html or "", opened))
    chosen = _unmarked(page)
    inside = [x.article and c for x, c in zip(page, chosen, strict=True)]
    outside = [c and not i for c, i in zip(chosen, inside, strict=True)]
    if any(inside) and ARTICLE * _heaviest(page, inside) >= _heaviest(page, outside):
        chosen = inside
    lines = [x for x, c in zip(page, chosen, strict=True) if c]
    weights = list(map(_weight, lines))
    kept = _kept(lines, weights, [0, *accumulate(map(int, chosen))], opened)
    return "\n\n".join(x.text for x, k in zip(lines, kept, strict=True) if k)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "html"):
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of `pages`.

    Character references are decoded, white space within a block becomes one space,
    blocks are joined by two newlines. A null or empty page, or one without text,
    gives an empty text. Reads page_id, url and html; equal rows get equal results;
    an empty table gives an empty result.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
