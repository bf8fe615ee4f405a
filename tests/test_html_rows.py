"""Table rows from stored pages."""

from __future__ import annotations

import random
import time

from siltbed.operators.html_rows import html_rows
from siltbed.plans.bronze import price_rows

FIELDS = ["date", "product", "price", "unit"]

PAGE = """<html><head><script>var t = "<table><tr><td>no</td></tr></table>";</script></head><body>
<div><table class="x"><thead><tr><th>Date<th>Product</tr></thead>
<tr><td> 2024-01-01 </td><th>DDR<b>4</b> &amp; more</th><td><span> 1.5 </span><!-- c --> USD</td><td>Gb</td><td>extra</td></tr>
<tr><td>2024-01-02</td><td>short</td></tr>
<tr><td>2024-01-03</td><td>no unit<script>x()</script></td><td>2<br>3</td></tr>
</table></div><table><tr><td>h</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table></body></html>"""


def test_first_table_only(frame):
    pages = frame([(1, PAGE), (2, "<p>no table</p>"), (3, ""), (4, None)], "page_id bigint, html string")
    got = html_rows(pages, "html", ["page_id"], FIELDS)
    assert got.columns == ["page_id", "row_number", *FIELDS]
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, 1, "2024-01-01", "DDR4& more", "1.5USD", "Gb"),
        (1, 3, "2024-01-03", "no unit", "23", ""),
    ]


def test_nested_rows_and_unclosed_table(frame):
    html = (
        "<div><table><tr><td>h</td></tr><tr><td>a<table><tr><td>n</td></tr></table></td>"
        "<td>b</td><td>c</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></div>"
        "<tr><td>7</td><td>8</td><td>9</td></tr>"
    )
    got = html_rows(frame([(html,)], "html string"), "html", [], ["x", "y", "z"]).collect()
    assert [tuple(r)[1:] for r in got] == [("an", "n", "b"), ("1", "2", "3")]


def test_broken_markup_never_stops_the_job(frame):
    rng = random.Random(1)
    parts = [*"<>&x[", "<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<![", "<!", "<!--", "-->", "]]>", "&#"]
    pages = [("".join(rng.choices(parts, k=rng.randrange(1, 25))),) for _ in range(3000)]
    pages.append(("<table><tr></tr><tr><td>a<![foo[b]]></td><td>b</td><td>c</td></tr></table>",))
    got = html_rows(frame(pages, "html string"), "html", [], ["x", "y", "z"])
    assert got.filter("x = 'a' AND y = 'b' AND z = 'c'").count() == 1


def test_lists_as_containers(frame):
    html = "<ul><li><a>head</a></li><li><a>one</a> <a>two</a></li></ul>"
    got = html_rows(
        frame([(html,)], "html string"), "html", [], ["a", "b"], required=1, container="ul", row="li", cells=["a"]
    )
    assert [tuple(r) for r in got.collect()] == [(1, "one", "two")]


def test_whole_large_pages(frame):
    body = "".join(f"<tr><td>d{i}</td><td>p</td><td>{i}</td></tr>" for i in range(5000))
    pages = frame([(f"<table><tr></tr>{body}</table>", f"u{n}") for n in range(3)], "html string, u string")
    got = html_rows(pages, "html", ["u"], ["d", "p", "v"])
    assert got.groupBy("u").count().filter("count = 5000").count() == 3


def test_unclosed_elements_take_linear_time(frame):
    n = 100_000
    cells = "<table><tr><td>h" + "<tr><td>1<td>2" + "<td>x" * n
    paragraphs = "<p>t" * n + "<table><tr><td>h</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>"
    pages = frame([(1, cells), (2, paragraphs)], "i int, html string")
    start = time.perf_counter()
    got = html_rows(pages, "html", ["i"], ["a", "b", "c"]).collect()
    assert time.perf_counter() - start < 30
    found = {r.i: (r.a, r.b, r.c) for r in got}
    assert found[2] == ("1", "2", "3")
    assert found[1] == ("12" + "x" * n, "2" + "x" * n, "x" * n)


def test_price_rows(frame):
    pages = frame([("https://h.example/price/dram_spot", PAGE)], "url string, html string")
    got = price_rows(pages)
    assert got.columns == ["Date", "Product", "Price", "Unit", "Category"]
    assert {r.Category for r in got.collect()} == {"dram_spot"}
