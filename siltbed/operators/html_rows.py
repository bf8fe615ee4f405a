"""Rows of an HTML table (or list) as a DataFrame."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, StringType, StructType

VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


class _RowCollector(HTMLParser):
    """Cell texts per row of the first container element, in time linear in the page.

    Texts and cells are kept once, in page order. Whatever lies between an element's start
    and its end belongs to it, so a cell is a span of texts and a row a span of cells.
    """

    def __init__(self, container: str, row: str, cells: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self._container, self._row, self._cells = container, row, cells
        self._open: list[tuple[str, list | None]] = []
        self._open_tags: Counter[str] = Counter()
        self._inside = self._done = False
        self._base = 0
        self._texts: list[str] = []
        self._cell_spans: list[list] = []
        self._row_spans: list[list] = []

    def handle_starttag(self, tag, attrs):
        if self._done or tag in VOID_TAGS:
            return
        span = None
        if self._inside and tag == self._row:
            span = [len(self._cell_spans), None]
            self._row_spans.append(span)
        elif self._inside and tag in self._cells:
            span = [len(self._texts), None]
            self._cell_spans.append(span)
        elif tag == self._container and not self._inside:
            self._inside, self._base = True, len(self._open)
        self._open.append((tag, span))
        self._open_tags[tag] += 1

    def handle_endtag(self, tag):
        if self._done or not self._open_tags[tag]:
            return
        name = None
        while name != tag:
            name, span = self._open.pop()
            self._open_tags[name] -= 1
            if span is not None:
                span[1] = len(self._cell_spans if name == self._row else self._texts)
        self._done = self._inside and len(self._open) <= self._base

    def parse_marked_section(self, i, report=1):
        """A malformed ``<![`` section is a comment up to the next ``>``, as in browsers."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.rawdata.find(">", i) + 1 or -1

    def handle_data(self, data):
        if not self._inside or self._done or self._open_tags["script"] or self._open_tags["style"]:
            return
        text = data.strip()
        if text:
            self._texts.append(text)

    def rows(self, width: int) -> Iterator[tuple[int, list[str]]]:
        """Per row its number of cells and the texts of the first ``width`` of them."""
        for start, end in self._row_spans:
            end = len(self._cell_spans) if end is None else end
            row = self._cell_spans[start : min(end, start + width)]
            yield end - start, ["".join(self._texts[a:b]) for a, b in row]


def _cells_per_row(
    html: str, container: str, row: str, cells: frozenset[str], width: int
) -> Iterator[tuple[int, list[str]]]:
    collector = _RowCollector(container, row, cells)
    collector.feed(html or "")
    collector.close()
    return collector.rows(width)


def html_rows(
    pages: DataFrame,
    html: str,
    keep: Sequence[str],
    fields: Sequence[str],
    required: int = 3,
    container: str = "table",
    row: str = "tr",
    cells: Sequence[str] = ("td", "th"),
    skip: int = 1,
) -> DataFrame:
    """Rows of each page's first container: positional ``fields`` beside the ``keep`` columns.

    The first ``skip`` rows are headers; rows with fewer than ``required`` cells are
    dropped, further missing fields are empty. Whole pages are parsed, in Arrow batches;
    only ``keep`` and the page text reach Python.
    """
    cell_tags, width = frozenset(cells), len(fields)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (i, r, *(values + [""] * width)[:width])
                for i, page in enumerate(batch[html])
                for r, (count, values) in enumerate(_cells_per_row(page, container, row, cell_tags, width))
                if r >= skip and count >= required
            ]
            rows = pd.DataFrame(found, columns=["_i", "row_number", *fields])
            source = batch[list(keep)].iloc[rows["_i"].astype("int64")].reset_index(drop=True)
            yield pd.concat([source, rows.drop(columns="_i")], axis=1)

    kept = pages.select(*keep)
    schema = StructType(list(kept.schema.fields)).add("row_number", IntegerType())
    for field in fields:
        schema = schema.add(field, StringType())
    return pages.select(*dict.fromkeys([*keep, html])).mapInPandas(parse, schema)
