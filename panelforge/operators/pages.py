"""Cells of tables in stored pages, by a tokenising table function over Arrow batches.

Patterns end at the first inner end tag, so they cannot see tables inside cells. Here each page is tokenised once, with a
stack of open tables: a cell's text is its own, that of tables inside it belongs to their cells, and each table knows the
cell that it stands in. Missing end tags close as the next cell, row or table begins. One page is parsed at a time; cells
of several pages share a batch, since a batch for each page costs more than its parsing.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BREAKS = frozenset(("br", "p", "div", "li", "tr", "table"))
#: A batch of cells ends with the page that brings it to so many cells or characters of text.
BATCH_CELLS, BATCH_CHARS = 4096, 4_000_000
CELL = "table int, parent_table int, parent_row int, parent_column int, row int, column int, header boolean, row_span int, column_span int, href string, text string"


def _span(value: str | None) -> int:
    digits = (value or "").strip()
    return max(int(digits), 1) if digits.isascii() and digits.isdigit() and len(digits) < 6 else 1


class _Tables(HTMLParser):
    """Collects (table, parent table, row and column, row, column, header, spans, href, text) of every cell."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[dict] = []
        self.cells: list[dict] = []
        self.tables = 0

    def _close_cell(self) -> None:
        if self.open:
            self.open[-1]["cell"] = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        top = self.open[-1] if self.open else None
        cell = top["cell"] if top else None
        if tag in _BREAKS and cell:
            cell["text"].append("\n")
        if tag == "table":
            inside = (top["number"], cell["row"], cell["column"]) if cell else (None, None, None)
            self.open.append({"number": self.tables, "inside": inside, "row": -1, "column": -1, "cell": None})
            self.tables += 1
        elif top is None:
            return
        elif tag == "tr":
            top.update(row=top["row"] + 1, column=-1, cell=None)
        elif tag in ("td", "th"):
            given = dict(reversed(attrs))
            top.update(row=max(top["row"], 0), column=top["column"] + 1)
            new = {"table": top["number"], "inside": top["inside"], "row": top["row"], "column": top["column"], "header": tag == "th", "text": [], "href": None}
            new["spans"] = _span(given.get("rowspan")), _span(given.get("colspan"))
            top["cell"] = new
            self.cells.append(new)
        elif tag == "a" and cell and cell["href"] is None:
            cell["href"] = dict(reversed(attrs)).get("href")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr"):
            self._close_cell()
        elif tag == "table" and self.open:
            self.open.pop()
            if self.open and self.open[-1]["cell"]:
                self.open[-1]["cell"]["text"].append("\n")
        elif tag in _BREAKS and self.open and self.open[-1]["cell"]:
            self.open[-1]["cell"]["text"].append("\n")

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1]["cell"]:
            self.open[-1]["cell"]["text"].append(data)


def _lines(parts: list[str]) -> str:
    """White space collapsed in each line, empty lines dropped."""
    lines = (" ".join(line.split()) for line in "".join(x if x == "\n" else x.replace("\n", " ") for x in parts).split("\n"))
    return "\n".join(line for line in lines if line)


def page_cells(html: str) -> list[tuple]:
    """The cells of a page in the order of their start, as ``CELL`` has them."""
    found = _Tables()
    found.feed(html)
    found.close()
    return [(c["table"], *c["inside"], c["row"], c["column"], c["header"], *c["spans"], c["href"], _lines(c["text"])) for c in found.cells]


def cell_batches(batches: Iterator[pa.RecordBatch], page: list[str], html: str) -> Iterator[pa.RecordBatch]:
    """Batches of the columns ``page`` and those of ``CELL`` for batches of pages."""
    names = [x.split()[0] for x in CELL.split(", ")]
    kinds = [*[pa.int32()] * 6, pa.bool_(), pa.int32(), pa.int32(), pa.string(), pa.string()]

    def gathered(batch: pa.RecordBatch, at: list[int], found: list[tuple]) -> pa.RecordBatch:
        own = [batch.column(c).take(pa.array(at)) for c in page]
        return pa.RecordBatch.from_arrays([*own, *(pa.array(x, k) for x, k in zip(zip(*found), kinds))], [*page, *names])

    for batch in batches:
        at, found, size = [], [], 0
        for i, text in enumerate(batch.column(html)):
            text = text.as_py()
            new = page_cells(text)
            at += [i] * len(new)
            found += new
            size += len(text) if new else 0
            if len(found) >= BATCH_CELLS or size >= BATCH_CHARS:
                yield gathered(batch, at, found)
                at, found, size = [], [], 0
        if found:
            yield gathered(batch, at, found)


def table_cells(pages: DataFrame, page: list[str], html: str) -> DataFrame:
    """One row per cell of any table of any page: the columns ``page``, then those of ``CELL``. Pages without tables, and
    null pages, give no rows. Pages are parsed by the tasks that read them: deal out a table of few files before."""
    rows = pages.select(*page, F.col(html).alias("__html")).where(F.col("__html").isNotNull())
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__html")
    return rows.mapInArrow(lambda batches: cell_batches(batches, page, "__html"), f"{kept}, {CELL}")
