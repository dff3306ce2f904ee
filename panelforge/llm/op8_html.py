"""HTML extraction: a tree builder with implied tags, visibility rules, and a layout-aware text rendering.

The builder opens and closes elements as browsers do for common markup: optional end tags (p, li, dt, dd, option, table
parts), misnested and missing end tags, void and raw-text elements. Nothing of an element that is not shown is emitted:
head, scripts, styles, templates, ``hidden``, inline ``display:none``, closed ``dialog``, the body of closed ``details``,
what stands in for frames, media and canvases where they fail, and ``noscript``; text under inline ``visibility:hidden`` is
left out where nothing inside makes it visible again. Everything else is emitted: also the options that a ``select`` shows,
the text of ``textarea``, ``math``, ``svg`` text elements and the content of ``object``. Values of attributes (alt, value,
placeholder) are no text of the page. The layout is kept: block elements start lines, blocks with margins are set apart by
a blank line, list items carry their mark or number and indent (up to ``MOST_INDENT`` columns, deeper ones stay there),
table cells with their column and row spans are padded to the widths of their columns (wide East Asian characters count
two; columns that nothing starts in have none) as long as a table stays within ``LAYOUT`` times its text, and white space collapses except in ``pre`` and ``textarea``.

Defined results: null and empty pages give an empty text. Any string gives a text: unknown tags are inline, stray end
tags and unclosed comments end where a browser's would, and open elements close at the end. Very long and deeply nested
pages are read whole; open elements are found by tag, so the work is in proportion to the page. Rows are handled one by
one; repeated rows give repeated results. An empty table gives no rows. Other columns never take part, whatever their
names.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_batches, table, text_or_empty

NAME = "op8_html"
_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>?)", re.S
)
_SPACE = re.compile(r"[ \t\n\r\f]+")
_READ = re.compile("hidden|style|open|start|span|selected|multiple|size|value", re.I)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]*)))?")
_NOT_CSS = re.compile(r"/\*.*?(?:\*/|$)|\"[^\"]*\"?|'[^']*'?|\([^)]*\)?", re.S)
_START = re.compile(r"\s*(-?\d{1,9})")
_SPAN = re.compile(r"\s*(\d{1,5})")
#: Columns and rows that a cell can span, as in browsers; columns that list items and quotations can be moved in.
MOST_COLUMNS, MOST_ROWS, MOST_INDENT = 1000, 65534, 64
#: How many times longer than its text padding may make a table, and the places that columns are padded to beyond that.
LAYOUT, MOST_WIDTHS = 8, (160, 80, 40, 20, 10, 0)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes datalist audio video canvas".split())
#: Not shown inside svg and math.
UNSEEN_DRAWN = frozenset("desc defs metadata symbol annotation annotation-xml".split())
#: Blocks, with the blank lines that their margins ask for.
BLOCKS = dict.fromkeys("html body div section article aside header footer main nav address form fieldset legend center details summary dialog hgroup search li dt dd caption option optgroup tr".split(), 0)
BLOCKS |= dict.fromkeys("p h1 h2 h3 h4 h5 h6 ul ol menu dl table blockquote pre figure figcaption hr listing".split(), 1)
LISTS = frozenset(("ul", "ol", "menu"))
CELLS = frozenset(("td", "th"))
ROW_GROUPS = frozenset(("thead", "tbody", "tfoot"))
_SCOPE = frozenset(("table", "td", "th", "caption", "template", "html"))
_P, _P_SCOPE, _TABLE = frozenset(("p",)), _SCOPE | {"button", "object"}, frozenset(("table",))
#: Open elements that a start tag closes, and the elements at which the search for them stops.
_CLOSES = {
    "li": (frozenset(("li",)), LISTS | _SCOPE),
    "dt": (frozenset(("dt", "dd")), _SCOPE | {"dl"}),
    "dd": (frozenset(("dt", "dd")), _SCOPE | {"dl"}),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "tr": (frozenset(("tr", "caption")), frozenset(("table",))),
    "td": (CELLS, frozenset(("tr", "table"))),
    "th": (CELLS, frozenset(("tr", "table"))),
    **dict.fromkeys(ROW_GROUPS, (ROW_GROUPS | {"caption"}, frozenset(("table",)))),
}


class _Text:
    """Lines of rendered text with pending line ends and collapsed white space."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space, self.gap, self.indent, self.mark = False, 0, "", ""

    def add(self, text: str) -> None:
        """Inline text, white space collapsed."""
        parts = _SPACE.sub(" ", text)
        body = parts.strip(" ")
        if not body:
            self.space |= bool(parts)
            return
        if self.now and (self.space or parts[0] == " "):
            self.now.append(" ")
        self.now.append(body)
        self.space = parts[-1] == " "

    def keep(self, text: str) -> None:
        """Preformatted text."""
        first, *rest = text.replace("\r\n", "\n").split("\n")
        if first:
            self.now.append(first)
        for line in rest:
            self.end_line(True)
            if line:
                self.now.append(line)

    def end_line(self, even_empty: bool = False) -> None:
        if self.now or even_empty:
            if self.gap and self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            line = "".join(self.now)
            self.lines.append((self.indent[: len(self.indent) - len(self.mark)] + self.mark + line).rstrip(" ") if line or self.mark else "")
            self.mark, self.now = "", []
        self.space = False

    def block(self, margin: int) -> None:
        """A block starts or ends here."""
        self.end_line()
        self.gap = max(self.gap, margin)

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _attributes(source: str) -> dict[str, str]:
    """The attributes of a start tag by lower-case name, the first of a name counting; none if no name that is read occurs."""
    out: dict[str, str] = {}
    if _READ.search(source):
        for m in _ATTRIBUTE.finditer(source):
            out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _css(attributes: dict[str, str]) -> dict[str, str]:
    """The declarations of the style attribute; the last one of a name counts, but important ones go first."""
    found: dict[str, tuple[bool, str]] = {}
    for part in _NOT_CSS.sub(" ", attributes.get("style", "")).lower().split(";"):
        name, _, value = part.partition(":")
        value, mark, _ = value.partition("!")
        name = name.strip()
        if mark or not found.get(name, (False, ""))[0]:
            found[name] = bool(mark), value.strip()
    return {name: value for name, (_, value) in found.items()}


def _number(pattern: re.Pattern, value: str, default: int) -> int:
    found = pattern.match(value)
    return int(found[1]) if found else default


class _Element:
    __slots__ = ("tag", "shown", "visible", "drawn", "pre", "count", "indent", "outer", "rows", "spans", "folded", "options", "every", "selected")

    def __init__(self, tag: str, above: _Element | None):
        self.tag = tag
        self.shown, self.visible, self.drawn, self.pre = (above.shown, above.visible, above.drawn, above.pre) if above else (True, True, False, False)
        self.count, self.indent, self.outer, self.rows, self.spans, self.folded = 0, None, None, None, (1, 1), False
        self.options, self.every, self.selected = None, False, False


def _width(text: str) -> int:
    """Columns that a line takes."""
    if text.isascii():
        return len(text)
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else 0 if unicodedata.combining(c) or unicodedata.category(c) in ("Mn", "Me", "Cf") else 1 for c in text)


def _places(rows: list[tuple[int, list]]) -> list[list[tuple[int, int, list[str]]]]:
    """The cells of each row as (first column, columns, lines): a cell stands in the first columns that are free, and the
    rows below that it reaches leave them empty.

    Columns taken from above are intervals with the last row that they reach, so a span costs the same however large it is.
    """
    last_row = {}
    for r, (group, _) in enumerate(rows):
        last_row[group] = r  # no cell reaches over the end of its row group
    placed, taken, group, soonest = [], [], None, len(rows)
    for r, (here, cells) in enumerate(rows):
        if here != group:
            taken, group, soonest = [], here, len(rows)
        elif soonest < r:
            taken = [x for x in taken if x[2] >= r]
            soonest = min((x[2] for x in taken), default=len(rows))
        at, line, more, k = 0, [], [], 0
        for columns, deep, lines in cells:
            while k < len(taken) and taken[k][0] <= at:
                at = max(at, taken[k][1])
                k += 1
            free = min(columns, taken[k][0] - at) if k < len(taken) else columns
            line.append((at, free, lines))
            if deep > 1:
                more.append((at, at + free, min(r + deep - 1, last_row[here])))
            at += free
        placed.append(line)
        if more:
            merged: list[tuple[int, int, int]] = []
            for start, stop, until in sorted(more + [x for x in taken if x[2] > r]):
                if merged and merged[-1][1] == start and merged[-1][2] == until:
                    start = merged.pop()[0]
                merged.append((start, stop, until))
            taken, soonest = merged, min(x[2] for x in merged)
    return placed


def _grid(rows: list[tuple[int, list]]) -> list[str]:
    """Rows of (row group, cells) with every column padded to its widest cell; cells are (columns, rows, lines).

    A column is one in which some cell starts. A cell over several columns that is wider than they are widens the last of
    them. Where padding would make the table longer than ``LAYOUT`` times its text, columns are padded to fewer places,
    and a cell that is wider moves those behind it in its row.
    """
    placed = _places(rows)
    starts = sorted({at for line in placed for at, _, _ in line})
    number = {c: i for i, c in enumerate(starts)}
    grid = [[(number[at], bisect_left(starts, at + columns), [(x, _width(x)) for x in lines]) for at, columns, lines in line] for line in placed]
    widths = [0] * len(starts)
    wide = lambda lines: max((w for _, w in lines), default=0)
    for line in grid:
        for i, j, lines in line:
            if j - i == 1:
                widths[i] = max(widths[i], wide(lines))
    for line in grid:
        for i, j, lines in line:
            if j - i > 1 and (more := wide(lines) - sum(widths[i:j]) - 2 * (j - i - 1)) > 0:
                widths[j - 1] += more
    content = sum(1 + sum(len(x) - x.count(" ") for x, _ in lines) for line in grid for _, _, lines in line)
    for most in (None, *MOST_WIDTHS):
        ends = [0, *accumulate((w if most is None else min(w, most)) + 2 for w in widths)] if most != 0 else [0] * len(starts)
        out = _lines(grid, ends, None if most == 0 else LAYOUT * content + 256)
        if out is not None:
            return out


def _lines(grid: list[list[tuple[int, int, list[tuple[str, int]]]]], ends: list[int], budget: int | None) -> list[str] | None:
    """The lines of a grid whose columns start at ``ends``; nothing if they are longer than ``budget``."""
    out, size = [], 0
    for line in grid:
        for k in range(max([1, *(len(lines) for _, _, lines in line)]) if line else 0):
            text, used = [], 0
            for i, _, lines in line:
                if k < len(lines) and lines[k][0]:
                    pad = max(ends[i] - used, 2 if text else 0)
                    text += [" " * pad, lines[k][0]]
                    used += pad + lines[k][1]
                    size += pad + len(lines[k][0])
            if budget is not None and size > budget:
                return None
            out.append("".join(text).rstrip(" "))
    return out


class _Builder:
    def __init__(self) -> None:
        self.text = _Text()
        self.open: list[_Element] = [_Element("", None)]
        #: Places of the open elements by tag, and the open tables that are shown.
        self.at: dict[str, list[int]] = {}
        self.tables: list[_Element] = []
        self.groups = 0

    def last(self, tags: Iterable[str]) -> int:
        """The place of the innermost open element of ``tags``; 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def push(self, e: _Element) -> None:
        self.at.setdefault(e.tag, []).append(len(self.open))
        self.open.append(e)

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if BLOCKS.get(tag) is not None and tag not in ("html", "body", "option", "optgroup", "tr", "caption"):
            self.close_any(_P, _P_SCOPE)
        if tag in _CLOSES:
            closing, stop = _CLOSES[tag]
            self.close_any(closing, stop)
            if tag in ROW_GROUPS or tag == "tr":
                self.close_any(CELLS | {"tr"}, _TABLE)
                if tag in ROW_GROUPS:
                    self.close_any(ROW_GROUPS, _TABLE)
        if tag in CELLS and self.open[-1].tag != "tr" and self.at.get("table"):
            self.start("tr", {})
        if tag in BLOCKS and tag not in ("head", "html") and self.open[-1].tag == "head":
            self.end("head")
        top = self.open[-1]
        e = _Element(tag, top)
        e.shown = top.shown and tag not in UNSEEN and (not top.folded or tag == "summary") and "hidden" not in attributes
        if top.drawn:
            e.shown = e.shown and tag not in UNSEEN_DRAWN
        if tag == "dialog" and "open" not in attributes:
            e.shown = False
        if "style" in attributes:
            css = _css(attributes)
            e.shown = e.shown and css.get("display") != "none"
            e.visible = {"hidden": False, "collapse": False, "visible": True}.get(css.get("visibility"), e.visible)
        if tag in VOID:
            if e.shown and tag == "br":
                self.text.end_line(True)
            elif e.shown and tag == "hr":
                self.text.block(1)
            return
        e.pre = top.pre or tag in ("pre", "listing", "textarea")
        e.drawn = top.drawn or tag in ("svg", "math")
        if tag == "svg":
            e.visible = False  # of a drawing only its text elements are text
        elif tag in ("text", "foreignobject") and top.drawn:
            e.visible = True
        self.push(e)
        if not e.shown:
            return
        if tag == "details":
            e.folded = "open" not in attributes
        if tag in CELLS:
            columns, rows = _number(_SPAN, attributes.get("colspan", ""), 1), _number(_SPAN, attributes.get("rowspan", ""), 1)
            e.spans = min(max(columns, 1), MOST_COLUMNS), min(rows or MOST_ROWS, MOST_ROWS)
            e.outer, self.text = self.text, _Text()
        elif tag == "select":
            e.options, e.every = [], "multiple" in attributes or _number(_SPAN, attributes.get("size", ""), 1) > 1
            e.outer, self.text = self.text, _Text()
        elif tag == "option" and self.at.get("select"):
            e.outer, self.text, e.selected = self.text, _Text(), "selected" in attributes
        elif tag == "tr":
            if self.tables:
                self.tables[-1].rows.append((self.groups, []))
            else:
                self.text.block(0)
        elif tag in ROW_GROUPS:
            self.groups += 1
        elif tag in BLOCKS:
            self.text.block(self.margin(tag))
        if tag == "table":
            e.rows = []
            self.tables.append(e)
            self.groups += 1
        elif tag == "ol":
            e.count = _number(_START, attributes.get("start", ""), 1) - 1
        elif tag == "li":
            parent = self.open[self.last(LISTS)]
            mark = "- "
            if parent.tag == "ol":
                parent.count = _number(_START, attributes.get("value", ""), parent.count + 1)
                mark = f"{parent.count}. "
            self.enter(e, mark if e.visible else " " * len(mark))
        elif tag in ("dd", "blockquote"):
            self.enter(e, "  ")

    def margin(self, tag: str) -> int:
        """Blank lines around a block; lists inside lists have none."""
        inner = tag in LISTS and any(places and places[0] < len(self.open) - 1 for places in map(self.at.get, LISTS))
        return 0 if inner else BLOCKS[tag]

    def enter(self, e: _Element, mark: str) -> None:
        e.indent = self.text.indent
        self.text.indent = (self.text.indent + " " * len(mark))[: max(MOST_INDENT, len(mark))]
        self.text.mark = mark

    def pop(self) -> None:
        e = self.open[-1]
        margin = self.margin(e.tag) if e.shown and e.tag in BLOCKS else 0
        self.open.pop()
        self.at[e.tag].pop()
        if not e.shown:
            return
        if e.outer is not None:
            lines, self.text = self.text.done(), e.outer
            if e.tag == "option":
                options = self.open[self.last(("select",))].options
                if options is not None:
                    options.append((e.selected, " ".join(lines)))
            elif e.tag == "select":
                chosen = [t for s, t in e.options if s or e.every] or [t for _, t in e.options[:1]]
                for k, text in enumerate(chosen if e.every else chosen[-1:]):
                    self.text.end_line() if k else None
                    self.text.add(text)
            elif self.tables:
                table = self.tables[-1]
                if not table.rows:
                    table.rows.append((self.groups, []))
                table.rows[-1][1].append((*e.spans, lines))
            else:
                for line in lines:
                    self.text.add(line)
                    self.text.end_line()
            return
        if e.rows is not None:
            self.tables.pop()
            for line in _grid(e.rows):
                self.text.now.append(line)
                self.text.end_line()
        if e.tag in BLOCKS:
            self.text.block(margin)
            if e.indent is not None:
                if self.text.mark.strip() and e.tag == "li":
                    self.text.end_line(True)  # an item without text still shows its mark
                self.text.indent, self.text.mark = e.indent, ""

    def close_any(self, tags: frozenset, stop: frozenset) -> None:
        """Close the outermost open element of ``tags`` inside the innermost of ``stop``."""
        floor = self.last(stop - tags)
        found = [places[k] for places in map(self.at.get, tags) if places and (k := bisect_right(places, floor)) < len(places)]
        while found and len(self.open) > min(found):
            self.pop()

    def end(self, tag: str) -> None:
        if tag in ("br", "p") and not self.at.get(tag):
            if self.open[-1].shown:
                self.text.end_line() if tag == "br" else self.text.block(1)
            return
        if tag in ("html", "body"):
            return  # what follows is still shown
        stop = _TABLE if tag in ROW_GROUPS or tag in CELLS or tag in ("tr", "caption") else frozenset() if tag == "table" else CELLS | {"caption", "table"}
        place = self.last((tag,))
        if place and place >= self.last(stop):
            while len(self.open) > place:
                self.pop()

    def characters(self, text: str) -> None:
        e = self.open[-1]
        if not e.shown or e.folded or not e.visible or e.options is not None:
            return
        if e.rows is not None or e.tag == "tr" or e.tag in ROW_GROUPS:
            if not text.strip(" \t\n\r\f"):
                return
        if "&" in text:
            text = html.unescape(text)
        text = text.replace("\xa0", " ") if e.pre else text
        if e.pre:
            self.text.keep(text)
        else:
            self.text.add(text)


def render(page: str) -> str:
    """The visible text of a page."""
    b = _Builder()
    at, n = 0, len(page)
    while at < n:
        found = _TOKEN.search(page, at)
        if found is None:
            b.characters(page[at:])
            break
        if found.start() > at:
            b.characters(page[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            b.end(tag)
            continue
        attributes = found[3]
        b.start(tag, _attributes(attributes))
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            stop = close.start() if close else n
            if tag == "textarea":
                b.characters(page[at:stop].removeprefix("\n"))
            elif tag == "xmp":
                b.characters(page[at:stop].replace("&", "&amp;"))
            at = stop
        elif attributes.endswith("/>") and b.open[-1].tag == tag and b.open[-1].drawn:
            b.pop()  # elements of svg and math may close themselves
        if tag in ("pre", "listing") and page.startswith("\n", at):
            at += 1
    while len(b.open) > 1:
        b.pop()
    return "\n".join(b.text.done()).replace("\xa0", " ")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, text."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([render(x) for x in batch.column(1).to_pylist()], pa.string())], ["page_id", "text"])

    rows = pages.select(F.col(id_col).alias("page_id"), text_or_empty(html_col).alias("html"))
    return in_batches(rows, batches, f"page_id {rows.schema['page_id'].dataType.simpleString()}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
