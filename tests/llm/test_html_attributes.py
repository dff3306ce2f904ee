"""Attributes inside the values of others, and the layout of tables, for op8_html."""

import random
import re
import time

import pytest

from panelforge.llm import op8_html
from panelforge.llm.op8_html import render


@pytest.mark.parametrize(
    "page, text",
    [
        ('<p title="the hidden truth">a</p>', "a"),
        ('<div data-x="a hidden b">a</div>', "a"),
        ("<div class='a hidden b'>a</div>", "a"),
        ('<p data-style="display:none">a</p>', "a"),
        ('<p title="style=display:none">a</p>', "a"),
        ('<p style="display:none; display:block">a</p>', "a"),
        ('<p style="background:url(x;display:none)">a</p>', "a"),
        ("<p hidden>a</p>b", "b"),
        ('<p title="x"hidden>a</p>b', "b"),
        ("<p HIDDEN=''>a</p>b", "b"),
        ("<p style=display:none>a</p>b", "b"),
        ('<p style = "color:red; Visibility : hidden !important">a</p>b', "b"),
        ('<details title="an open door"><summary>s</summary>a</details>', "s"),
        ("<details open><summary>s</summary>a</details>", "s\na"),
        ('<dialog title="an open door">a</dialog>b', "b"),
        ("<dialog open>a</dialog>", "a"),
        ('<ol title="start=7" start=3><li>a</ol>', "3. a"),
        ('<ol data-start=7><li>a</ol>', "1. a"),
        ('<table><tr><td data-colspan="2">a<td>b<tr><td>c<td>d</table>', "a  b\nc  d"),
    ],
)
def test_attribute_names(page, text):
    assert render(page) == text


def naive_places(rows):
    """Every taken column of every row marked one by one."""
    out, marks = [], set()
    for r, (group, cells) in enumerate(rows):
        at, line = 0, []
        for columns, deep, lines in cells:
            while (r, at) in marks:
                at += 1
            free = 1
            while free < columns and (r, at + free) not in marks:
                free += 1
            line.append((at, free, lines))
            below = r + 1
            while below < r + deep and below < len(rows) and all(rows[k][0] == group for k in range(r, below + 1)):
                marks |= {(below, c) for c in range(at, at + free)}
                below += 1
            at += free
        out.append(line)
    return out


@pytest.mark.parametrize("seed", range(60))
def test_places_of_spanning_cells(seed):
    rng = random.Random(seed)
    rows, group = [], 0
    for _ in range(rng.randrange(1, 12)):
        group += rng.random() < 0.2
        rows.append((group, [(rng.choice([1, 1, 2, 3, 7]), rng.choice([1, 1, 2, 3, 50]), [str(len(rows))]) for _ in range(rng.randrange(0, 6))]))
    assert op8_html._places(rows) == naive_places(rows)


@pytest.mark.parametrize(
    "page, most",
    [
        ("<table>" + "<tr><td>x<td>y" * 3000 + "<tr><td>" + "word " * 9000 + "<td>z</table>", 9),
        ("<table>" + "<tr><td>x<td>y" * 3000 + "<tr><td>" + "w" * 45000 + "<td>z</table>", 9),
        ("<table>" + "<tr><td rowspan=65534 colspan=1000>x" * 2000 + "</table>", 1),
        ("<table><tr>" + "".join(f"<td rowspan={2 + i % 50} colspan={1 + i % 900}>x" for i in range(3000)) + "<tr><td>q" * 3000 + "</table>", 9),
        ("<table><tr>" + "<td>a" * 1000 + ("<tr>" + "<td>" * 999 + "<td>b") * 100 + "</table>", 2),
        ("<table><tr><td>a<td>" * 100 + "x" + "</table>" * 100, 9),
    ],
)
def test_output_is_in_proportion_to_the_page(page, most):
    began = time.process_time()
    text = op8_html.render(page)
    assert len(text) <= most * len(page) and time.process_time() - began < 5
    wanted = re.sub(r"\s", "", re.sub(r"<[^>]*>", "", page))
    assert sorted(text.replace(" ", "").replace("\n", "")) == sorted(wanted)


def test_columns_are_aligned_while_they_are_short():
    assert op8_html.render("<table><tr><th colspan=2>Head<th>Z<tr><td>a<td>b<td>c<tr><td rowspan=2>long cell<td>d<td>e<tr><td>f<td>g</table>") == "\n".join(
        ["Head          Z", "a          b  c", "long cell  d  e", "           f  g"]
    )
    # a cell over columns in which nothing starts takes no room for them
    assert op8_html.render("<table><tr><td colspan=40>a<td>b<tr><td colspan=40>c<td>d</table>") == "a  b\nc  d"
