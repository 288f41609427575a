"""Main text of HTML pages by line-block distribution (operator 3).

Markup is stripped to lines, one per block element; lines of menus, adverts, forms and other page
furniture count as empty. The text lengths of each sliding window of lines are summed. Text surges at the
first line whose window holds text and dives where windows are empty again; the lines between the surge
and the dive that enclose most text are kept.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import free_name, map_batches

#: Lines of a window.
WINDOW = 3

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is text to the browser's parser, up to their own end tag.
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
_FURNITURE = frozenset(
    "nav footer aside form head button select option menu dialog object canvas audio video label input".split()
)
#: Blocks that are one line of text; links in a paragraph or heading are text like any other.
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6".split())
_LEAVES = _PARAGRAPHS | {"li", "dt", "dd", "pre"}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adsbygoogle banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup "
    "sidebar widget widgets related recommended share sharing social breadcrumb breadcrumbs menu menubar nav navbar "
    "navigation topbar footer masthead header comment comments disqus respond reply replies pagination pager toolbar "
    "login search skip complementary contentinfo copyright disclaimer".split()
)
#: What the start of an item or cell ends, if it is still open within the same list or table.
_ENDS = {
    "li": ("li",), "option": ("option",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",),
    "td": ("td", "th"), "th": ("td", "th"),
}
_SCOPES = frozenset("ul ol menu dl table select article main body div section".split())
_REST = frozenset("with has no without is".split())
_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|!--|[!?/])")
_TAG_END = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


def _furniture(name: str, attributes: str, in_article: bool, wrappers: bool) -> bool:
    """Whether an element is furniture. With ``wrappers``, forms are not, nor are names with any word that is none."""
    if (name in _FURNITURE and not (wrappers and name == "form")) or (name == "header" and not in_article):
        return True
    if name in ("html", "body", "main") or "=" not in attributes:
        return False
    for found in _NAMES.findall(attributes):
        for one in "".join(found).split():
            parts = [part.lower() for part in _PARTS.findall(one)]
            if not parts or parts[0] in _REST or parts[-1] == "free":
                continue
            if (wrappers or name == "article") and not _FURNITURE_WORDS.issuperset(parts):
                continue
            ends = {parts[0], parts[-1]}
            if in_article:
                ends.discard("header")  # the header of an article holds its title
            if ends & _FURNITURE_WORDS:
                return True
    return False


@dataclass(slots=True)
class Line:
    text: str  # empty for furniture
    length: int  # characters outside links; all of them in an article, a paragraph or a heading
    in_article: bool
    paragraph: bool  # in an article, a paragraph or a heading
    container: int  # the element that holds the line's block; 0 for the body


def lines_of(page: str, wrappers: bool = False) -> list[Line]:
    """Lines of a page. With ``wrappers``, forms and half furniture by name are taken for wrappers of the page."""
    lines: list[Line] = []
    pieces: list[str] = []
    linked, links, articles = 0, 0, 0
    open_: list[tuple[str, bool]] = []  # open elements and whether each began a stretch of furniture
    blocks: list[tuple[str, int]] = []  # open block elements and their numbers
    counts: dict[str, int] = {}  # how many elements of a name are open
    skipping, seen, number, outer = 0, False, 0, 0

    def container() -> int:
        if skipping:
            return outer
        for name, which in reversed(blocks[-3:]):
            if name not in _LEAVES:
                return 0 if name in ("html", "body") else which
        return 0

    def flush() -> None:
        nonlocal linked, seen
        text = " ".join("".join(pieces).split())
        if text:
            own = articles > 0 or bool(blocks and blocks[-1][0] in _PARAGRAPHS)
            lines.append(Line(text, len(text) if own else max(0, len(text) - linked), articles > 0, own, container()))
        elif seen:
            lines.append(Line("", 0, articles > 0, False, container()))
        pieces.clear()
        linked, seen = 0, False

    def close(at: int) -> None:
        nonlocal skipping, articles, links
        while len(open_) > at:
            name, began = open_.pop()
            counts[name] -= 1
            if name in _BLOCKS:
                blocks.pop()
            skipping -= began
            articles -= name in ("article", "main")
            links -= name == "a"

    def add(text: str) -> None:
        nonlocal linked, seen
        if skipping:
            seen = seen or not text.isspace()
            return
        text = entities.unescape(text)
        pieces.append(text)
        if links:
            linked += len(text)

    low = page.lower() if len(page.lower()) == len(page) else page
    at, quotes = 0, True
    while True:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:]) if at < len(page) else None
            break
        if tag.start() > at:
            add(page[at : tag.start()])
        if tag[2] is None:  # a comment, a declaration, or something the browser drops
            end = "-->" if tag[0] == "<!--" else ">"
            stop = page.find(end, tag.end())
            at = len(page) if stop < 0 else stop + len(end)
            continue
        closing, name = tag[1], tag[2].lower()
        end = _TAG_END.match(page, tag.end()) if quotes else None
        if end is None:  # a quote that never ends: from here on tags end at the next bracket
            quotes = False
            stop = page.find(">", tag.end())
            if stop < 0:
                break
            attributes, at = page[tag.end() : stop], stop + 1
        else:
            attributes, at = end[0], end.end()
        if name in _BLOCKS:
            flush()
        if closing:
            if counts.get(name):
                close(next(i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name))
            continue
        if name in ("svg", "math") and attributes.endswith("/>"):
            continue
        if name in _RAW:
            stop = low.find(f"</{name}", at)
            at = len(page) if stop < 0 else stop
            continue
        if name == "br":
            add(" ")
        if name in _VOID:
            continue
        if name in _BLOCKS:  # ends a paragraph that was left open, and an item or cell ends the last one
            ends = _ENDS.get(name, ("p",))
            for i in range(len(open_) - 1, -1, -1) if any(map(counts.get, ends)) else ():
                if open_[i][0] in ends:
                    close(i)
                    break
                if open_[i][0] in (_SCOPES if name in _ENDS else _BLOCKS):
                    break
        began = _furniture(name, attributes, articles > 0, wrappers)
        if name in ("article", "main") and not began and skipping and not any(n == "section" and b for n, b in open_):
            # Furniture that was left open ends where the article begins.
            close(next(i for i, (_, b) in enumerate(open_) if b))
        if began and not skipping:
            outer = container()
        open_.append((name, began))
        if name in _BLOCKS:
            number += 1
            blocks.append((name, number))
        counts[name] = counts.get(name, 0) + 1
        skipping += began
        articles += name in ("article", "main")
        links += name == "a"
    flush()
    return lines


def _without_gaps(lines: list[Line]) -> list[Line]:
    """Lines without the furniture within an article, between articles, or within one element of text."""
    kept: list[Line] = []
    gap: list[Line] = []
    for line in lines:
        if not line.text:
            gap += [] if line.in_article else [line]
            continue
        if kept and gap:
            before, inside = kept[-1], line.container
            same = inside and inside == before.container and all(part.container == inside for part in gap)
            if not (same or (before.in_article and line.in_article)):
                kept += gap
        gap = []
        kept.append(line)
    return kept + gap


def _stretch(lines: list[Line], window: int) -> list[Line]:
    """The lines between the surge and the dive that enclose most text."""
    lines = _without_gaps(lines)
    sums = list(accumulate((line.length for line in lines), initial=0))
    n = len(lines)
    best, most, i = (0, 0), 0, 0
    while i < n:
        if not lines[i].length:
            i += 1
            continue
        surge = i  # text surges here
        while i < n and sums[min(i + window, n)] > sums[i]:
            i += 1
        dive = i  # no window from here on holds text
        if (weight := sums[dive] - sums[surge]) > most:  # of equal ones the first
            best, most = (surge, dive), weight
        i = dive + 1
    return [line for line in lines[best[0] : best[1]] if line.text]


def main_text(page: str | None, window: int = WINDOW) -> str:
    """The article of a page: its blocks, white space collapsed, joined by line ends.

    Where all is furniture, the page may lie in a form or in an element with a name like one: it is read
    again with such elements as wrappers, and counts if that gives a paragraph.
    """
    found = _stretch(lines_of(page or ""), window)
    if not found and page:
        found = _stretch(lines_of(page, wrappers=True), window)
        if not any(line.paragraph for line in found):
            found = []
    return "\n".join(line.text for line in found)


def extract_main_text(pages: DataFrame, html: str = "html", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``pages`` with a further column: the main text of each page, empty if there is none.

    Whole pages are read, damaged ones too; a null page is empty, a repeated row gets its text again, and no rows
    give no rows. Character references are decoded, white
    space within a block becomes one space, blocks are joined by ``\\n``. All columns pass through; if
    ``text`` is taken, text_2 is used, and so on.
    """
    name, columns = free_name(pages.columns, text), pages.columns
    at = [c.lower() for c in columns].index(html.lower())

    def extract(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [main_text(page.as_py(), window) for page in batch.column(at)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*columns, name])

    return map_batches(pages, extract, pages.select("*", F.lit("").alias(name)).schema)
