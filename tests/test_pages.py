"""Cells of nested tables against the structure that the pages were made from."""

import random

import pyarrow as pa
import pytest

from panelforge.operators import pages


def make(rng, depth, counter, inside, cells, out):
    """Write a random table as HTML and note its cells as they begin."""
    number = counter[0]
    counter[0] += 1
    out.append(rng.choice(["<table>", '<TABLE border="1" title="</td> <td>">', "<table><tbody>"]))
    for row in range(rng.randrange(1, 4)):
        out.append(rng.choice(["<tr>", "<TR class=x>"]))
        for column in range(rng.randrange(1, 4)):
            head, span = rng.random() < 0.3, rng.choice([1, 1, 3])
            tag = "th" if head else "td"
            out.append(f"<{tag}" + (f' colspan="{span}"' if span > 1 else "") + ">")
            word, href = f"w{rng.randrange(99)} &amp; x", None
            if rng.random() < 0.3:
                href = f"/h{rng.randrange(9)}"
                out.append(f'<a href="{href}">{word}</a>')
            else:
                out.append(word)
            cell = [number, *inside, row, column, head, 1, span, href, word.replace("&amp;", "&")]
            cells.append(cell)
            if depth and rng.random() < 0.4:
                make(rng, depth - 1, counter, (number, row, column), cells, out)
                if rng.random() < 0.5:
                    out.append(" after <br> that ")
                    cell[-1] += "\nafter\nthat"
            out.append(rng.choice(["", f"</{tag}>"]))
        out.append(rng.choice(["", "</tr>"]))
    out.append("</table>")


@pytest.mark.parametrize("seed", range(80))
def test_nested_tables(seed):
    rng, cells, out = random.Random(seed), [], ["<p>outside</p>"]
    counter = [0]
    for _ in range(rng.randrange(1, 3)):
        make(rng, 3, counter, (None, None, None), cells, out)
        out.append(" text between ")
    assert pages.page_cells("".join(out)) == [tuple(c) for c in cells]


def test_pages_without_cells(spark):
    rows = [(1, None), (2, ""), (3, "<table></table>"), (4, "<td>no table</td>"), (5, "<table><td>bare<table>"), (6, "<table><tr><td colspan=x rowspan=0>a"), (7, "</table></td>x<table><tr><th>y")]
    df = spark.createDataFrame([(*r, "a") for r in rows], "id int, html string, text0 string")
    found = sorted((r["id"], r["text"], r["header"], r["column_span"]) for r in pages.table_cells(df, ["id"], "html").collect())
    assert found == [(5, "bare", False, 1), (6, "a", False, 1), (7, "y", True, 1)]
    assert pages.table_cells(df.where("id > 9"), ["id"], "html").count() == 0


def test_pages_share_batches():
    """Cells of several pages are one batch; a batch ends with the page that fills it."""
    html = "<table><tr><td>a<td>b</table>"
    batch = pa.RecordBatch.from_pydict({"id": list(range(5000)), "html": [html if i % 5 else "none" for i in range(5000)]})
    found = list(pages.cell_batches(iter([batch, batch]), ["id"], "html"))
    assert [b.num_rows for b in found] == [4096, 3904] * 2
    ids = [i for b in found for i in b.column("id").to_pylist()]
    assert ids == [i for i in range(5000) if i % 5 for _ in "ab"] * 2
    assert {(c, t) for b in found for c, t in zip(b.column("column").to_pylist(), b.column("text").to_pylist())} == {(0, "a"), (1, "b")}
    long = pa.RecordBatch.from_pydict({"id": [1, 2], "html": [html + "x" * pages.BATCH_CHARS] * 2})
    assert [b.num_rows for b in pages.cell_batches(iter([long]), ["id"], "html")] == [2, 2]
