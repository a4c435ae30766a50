"""Main text of web pages, from a streaming parse of each whole page.

The standard library's parser gives events. Text between block boundaries is a line; its text-to-tag ratio is its letters
by the tags in it. Ratios are smoothed with a Gaussian over neighbouring lines, and a threshold parts them into two
clusters, content and the rest. The content lines then select a region: the element that holds most of their text (an
``article`` or ``main`` if one does), and in it all lines but those of menus, headers, footers, sidebars, notices, adverts,
forms and comments. In a region without such an element the lines before the first and after the last content line go.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import small_batches

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre
search section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never part of an article, whatever it is.
NEVER = frozenset("""script style template noscript head title nav footer aside form button select textarea option iframe
object svg math canvas audio video dialog menu""".split())
#: Words of class, id and role that tell such parts in other elements.
HINTS = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion
banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription
signup login nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc toolbar header masthead topbar
footer copyright legal colophon sidebar aside rail widget widgets related recommended recommendations teaser share sharing
social comment comments commentlist disqus reply replies respond discussion reactions search form contentinfo complementary
tagcloud tags skip outbrain taboola""".split())
#: Hints that mean a part of the page, but in an article a part of the article (its title block, say).
LAYOUT = frozenset("header masthead topbar rail tags search form alert banner".split())
ROOTS = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Smoothing: standard deviation and radius in lines. Share of the content's letters that a region must hold.
SIGMA, RADIUS, HOLDS = 1.0, 2, 0.5
#: Lines of links alone that in a row make a menu, and their letters on average at most.
MENU, MENU_LETTERS = 3, 20
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: A tag that the page's end cuts off.
CUT = re.compile(r"<[/!?a-zA-Z][^<>]*\Z")


def hinted(attributes: list[tuple[str, str | None]], inside: bool) -> bool:
    """Whether class, id or role tell a part that is no article text; ``inside``: in an article."""
    for name, value in attributes:
        if name in ("class", "id", "role") and value:
            words = {w.lower() for w in WORDS.findall(value)} & HINTS
            if words - LAYOUT if inside else words:
                return True
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
    return False


class Element:
    """An open element, with what it inherits: whether it lies in a part that never holds article text, in a heading, in a link, in an
    article; ``hint``: the innermost hinted element up from it. Kind 2 never holds article text, kind 1 is hinted not to."""

    __slots__ = ("tag", "number", "parent", "kind", "never", "heading", "link", "root", "hint")

    def __init__(self, tag: str, number: int, parent: Element | None, kind: int = 0):
        self.tag, self.number, self.kind = tag, number, kind
        self.parent = self if parent is None else parent
        up = self.parent if parent is not None else None
        self.never = kind == 2 or up is not None and up.never
        self.heading = tag in HEADINGS or up is not None and up.heading
        self.link = tag == "a" or up is not None and up.link
        self.root = tag in ROOTS or up is not None and up.root
        self.hint = self if kind == 1 else up.hint if up is not None else None


class Line:
    __slots__ = ("text", "tags", "links", "at")

    def __init__(self, text: str, tags: int, links: int, at: Element):
        self.text, self.tags, self.links, self.at = text, tags, links, at


class Lines(HTMLParser):
    """Collects the lines of one page, each with the innermost element that is open at its end. Elements are numbered
    in page order, so a parent's number is less than its children's, and sums over parts take one pass over all elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.top = Element("", 0, None)
        self.open: list[Element] = [self.top]
        self.elements, self.lines = [self.top], []
        self.depth: dict[str, int] = {}  # open elements by tag
        self.wrapping: set[int] = set()  # hinted elements that hold an article
        self.parts: list[str] = []
        self.tags = self.links = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split()) if self.parts else ""
        if text:
            self.lines.append(Line(text, self.tags, self.links, self.open[-1]))
            self.tags = 0
        self.parts, self.links = [], 0

    def close_from(self, i: int) -> None:
        for x in self.open[i:]:
            self.depth[x.tag] -= 1
        del self.open[i:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.flush()
            self.end_paragraph()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        inside = self.open[-1].root
        if tag in ROOTS and not inside:  # an article in an unclosed menu is still an article
            i = len(self.open)
            while self.open[i - 1].never:
                i -= 1
            self.close_from(i)
        kind = 0
        if tag in NEVER or tag == "header" and not inside:
            kind = 2
        elif tag not in ("html", "body", "main") and attrs and hinted(attrs, inside or tag == "article"):
            kind = 1
        if tag in ROOTS and not kind:
            hint = self.open[-1].hint
            while hint is not None and hint.number not in self.wrapping:
                self.wrapping.add(hint.number)
                hint = hint.parent.hint
        element = Element(tag, len(self.elements), self.open[-1], kind)
        self.elements.append(element)
        self.open.append(element)
        self.depth[tag] = self.depth.get(tag, 0) + 1

    def end_paragraph(self) -> None:
        """A block ends an open paragraph (and what is open in it), but not one outside of a table cell or list."""
        if not self.depth.get("p"):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag == "p":
                self.close_from(i)
                return
            if tag in BLOCKS:
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if not self.depth.get(tag):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self.close_from(i)
                return
            if self.open[i].tag in ROOTS and tag not in ("body", "html", "article", "main"):
                return  # a stray end tag does not leave the article

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag in ("script", "style"):
            return
        self.parts.append(data)
        if self.open[-1].link:
            self.links += len(data.strip())

    def sums(self, lines: list[Line]) -> list[int]:
        """Letters of these lines by the number of each element that holds them."""
        out = [0] * len(self.elements)
        for x in lines:
            out[x.at.number] += len(x.text)
        for e in reversed(self.elements[1:]):
            out[e.parent.number] += out[e.number]
        return out

    def ends(self) -> list[int]:
        """By number, the last element inside each one: what it holds are the numbers from its own to that."""
        out = list(range(len(self.elements)))
        for e in reversed(self.elements[1:]):
            out[e.parent.number] = max(out[e.parent.number], out[e.number])
        return out

    def under(self, roots: set[int]) -> list[bool]:
        """By number, whether an element is one of ``roots`` or lies in one."""
        out = [False] * len(self.elements)
        for e in self.elements:
            out[e.number] = e.number in roots or out[e.parent.number]
        return out


def smooth(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing; weights beyond either end are left out."""
    at = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-at**2 / (2 * SIGMA**2))
    weight = np.convolve(np.ones(len(ratios)), kernel)[RADIUS:len(ratios) + RADIUS]
    return np.convolve(ratios, kernel)[RADIUS:len(ratios) + RADIUS] / weight


def threshold(values: np.ndarray) -> float:
    """The value half-way between the means of the two clusters that it makes (from the mean on, until it stays)."""
    cut = values.mean()
    for _ in range(50):
        high, low = values[values > cut], values[values <= cut]
        if not len(high) or not len(low):
            break
        new = (high.mean() + low.mean()) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def content(lines: list[Line]) -> np.ndarray:
    """Which lines are content: their smoothed text-to-tag ratio, or their own, is in the upper cluster."""
    ratios = np.array([len(x.text) / max(1, x.tags) for x in lines])
    values = np.log1p(smooth(ratios))
    cut = threshold(values)
    out = (values > cut) | (np.log1p(ratios) > cut)
    return out if out.any() else np.ones(len(lines), bool)


def main_text(html: str | None) -> str:
    """The page's main text, one line a block; empty if the page is null, empty or has none."""
    if not html:
        return ""
    page = Lines()
    page.feed(CUT.sub("", html))
    page.close()
    page.flush()
    lines = [x for x in page.lines if not x.at.never]
    whole = sum(len(x.text) for x in lines)
    held = page.sums(lines)
    # a hint on what holds an article and most of the text, or almost all of it, is of the page's layout
    believed = {e.number for e in page.elements if e.kind == 1 and (
        2 * held[e.number] <= whole or 10 * held[e.number] <= 9 * whole and e.number not in page.wrapping)}
    apart = page.under(believed)
    marks = content(page.lines) if page.lines else np.zeros(0, bool)
    rows = [(x, m) for x, m in zip(page.lines, marks, strict=True) if not x.at.never and not apart[x.at.number]]
    if not rows:
        return ""
    if not any(m for _, m in rows):
        rows = [(x, True) for x, _ in rows]
    mass, ends = page.sums([x for x, m in rows if m]), page.ends()
    total = mass[0]
    # a hinted article is a part like any other (a reader's comment)
    roots = [e.number for e in page.elements if e.tag in ROOTS and not e.kind and mass[e.number] and mass[e.number] >= HOLDS * total]
    if roots:
        region = min(roots, key=lambda n: (-mass[n], n))
        for n in sorted(roots):  # an article in the main part that holds nearly all of it
            if 5 * mass[n] >= 4 * mass[region] and region < n <= ends[region]:
                region = n
        kept = [x for x, _ in rows if region <= x.at.number <= ends[region]]
    else:
        regions = [e.number for e in page.elements[1:] if mass[e.number] >= 0.9 * total and (e.tag in BLOCKS or e.kind and e.tag in ROOTS)]
        kept = rows
        if regions and page.elements[max(regions)].tag not in HEADINGS | {"p", "li"}:
            region = max(regions)
            kept = [(x, m) for x, m in rows if region <= x.at.number <= ends[region]]
        first = next(i for i, (_, m) in enumerate(kept) if m)
        last = max(i for i, (_, m) in enumerate(kept) if m)
        while first and kept[first - 1][0].at.heading:
            first -= 1
        kept = [x for x, _ in kept[first:last + 1]]
    return "\n".join(x.text for x in without_menus(kept))


def without_menus(lines: list[Line]) -> list[Line]:
    """The lines but for runs of ``MENU`` and more, in one element, that are links alone and short ones: a list of things to read
    has titles, which are longer."""
    out: list[Line] = []
    run: list[Line] = []
    for x in [*lines, None]:
        link = x is not None and not x.at.heading and 10 * x.links >= 9 * len(x.text)
        if run and not (link and x.at.parent is run[0].at.parent):
            letters = sum(len(y.text) for y in run)
            out += run if len(run) < MENU or letters > MENU_LETTERS * len(run) else []
            run = []
        if link:
            run.append(x)
        elif x is not None:
            out.append(x)
    return out


def extract_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with a column ``out``, the main text of the whole page in ``html`` (null, empty or no main text: empty).

    Character references are decoded; white space inside a block becomes one space; blocks are trimmed and joined by one
    line feed in page order. A page that ends within a tag loses that tag alone. Repeated rows give equal texts; other
    columns stay, but for one of the name ``out``, which is replaced. Pages are independent, nothing is shuffled.
    """
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def text_of(column: pd.Series) -> pd.Series:
        return column.map(main_text)

    return pages.withColumn(out, text_of(F.col(html)))


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    return extract_text(pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
