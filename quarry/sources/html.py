"""HTML tables as rows and cells (``html_table``), one row per cell.

Pages are cut into tokens (comments, scripts, tags, text) by one pattern, and one
pass goes over the tokens of a page: table depth is the running balance of table
tags, a token's table is the latest one opened at its depth, a row is the running
count of ``tr``, and the latest cell or row event says whether text stands in a
cell.  So nested tables are tables of their own, and end tags of cells and rows may
be left out.  A quote opens an attribute value only directly after ``=``.

Columns follow the HTML standard's cell placement: a cell takes the first column
of its row that no cell above reaches into by ``rowspan``; spans are bounded as
there.  A cell's value is its own text, without that of tables inside it, with
white space collapsed and the common entities decoded.

Work is per page and in time linear in its tokens, row-wise and without a shuffle;
tokens never become rows.
Pages that are null, empty or without tables give no rows; pages that repeat are
pages of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ship_package

#: Text and tags without attributes or a name like script's come first, as most tokens are those; they begin none of the others.
TOKEN = re.compile(r"""[^<]++|</?(?![Ss][CcTt])[A-Za-z][^>=]*+>|<!--.*?-->|(?i:<(script|style)\b[^>]*+>.*?</\1\s*>)"""
                   r"""|</?[A-Za-z](?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+>|<""", re.S | re.A)
KNOWN = re.compile(r"<(/?(?:table|t[rdh]|thead|tbody|tfoot|caption)|br)(?![A-Za-z0-9])", re.I | re.A)
SPACES = re.compile(r"[\s ]+", re.A)
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))
#: The standard's bounds on spans.
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534

#: Events that end a cell without beginning one.
CLOSING = {"/td", "/th", "tr", "/tr", "thead", "/thead", "tbody", "/tbody", "tfoot", "/tfoot", "caption", "/caption"}
SPAN = {name: re.compile(rf"\s{name}\s*=\s*[\"']?\s*(\d{{1,9}})", re.I | re.A) for name in ("colspan", "rowspan")}
#: Cells in a batch that leaves a task, about.
BATCH_CELLS = 1 << 15


def _span(token: str, name: str, most: int) -> int:
    if "=" not in token:
        return 1
    found = SPAN[name].search(token)
    return max(1, min(most, int(found[1]))) if found else 1


def _text(parts: list[str]) -> str:
    text = "".join(parts)
    if text.isalnum():
        return text
    if "&" in text:
        for name, char in ENTITIES:
            text = text.replace(name, char)
    return SPACES.sub(" ", text).strip(" ")


class Table:
    __slots__ = ("rows", "cells", "inside")

    def __init__(self):
        #: Rows begun, cells as (row, start tag, whether a header, pieces of text), and whether a cell is open.
        self.rows, self.cells, self.inside = 0, [], False


def page_tables(page: str) -> list[Table]:
    """Tables of a page in the order of their start tags."""
    tables: list[Table] = []
    at: dict[int, Table] = {}  # depth -> the latest table opened there
    balance = low = 0
    table = None
    for m in TOKEN.finditer(page):
        token = m[0]
        if token[0] != "<" or token == "<":
            if table is not None and table.inside:
                table.cells[-1][3].append(token)
            continue
        tag = KNOWN.match(token)
        if not tag:  # a comment, or a tag that says nothing about tables
            continue
        tag = tag[1].lower()
        if tag == "table":
            balance += 1
            table = at[balance - low] = Table()
            tables.append(table)
        elif tag == "/table":
            balance -= 1
            low = min(low, balance)  # a stray end tag does not lower the depth below zero
            table = at[balance - low] if balance > low else None
        elif table is None:
            continue
        elif tag in ("td", "th"):
            table.cells.append((table.rows, token, tag == "th", []))
            table.inside = True
        elif tag in CLOSING:
            table.rows += tag == "tr"
            table.inside = False
        elif tag == "br" and table.inside:
            table.cells[-1][3].append(" ")
    return tables


def place(cells: Sequence[tuple[int, int, int]]) -> list[int]:
    """Columns of one table's cells (row, colspan, rowspan), in page order."""
    until: dict[int, int] = {}  # column -> the row below the cell that holds it
    out, at, row = [], 0, None
    for r, wide, tall in cells:
        if r != row:
            row, at = r, 0
        while until.get(at, 0) > r:
            at += 1
        out.append(at)
        if tall > 1:
            for c in range(at, at + wide):  # cells may overlap in broken tables: the longer hold stays
                until[c] = max(until.get(c, 0), r + tall)
        at += wide
    return out


def html_tables(df: DataFrame, html: str, keep: Sequence[str] = (), fill: bool = False) -> DataFrame:
    """Every cell of every table of an HTML column: keep..., table_no, row_no,
    col_no (0-based, tables in page order), value, is_header, colspan, rowspan.
    With ``fill`` a cell is repeated at every position it spans."""
    ship_package(df.sparkSession)
    src = df.select(*keep, F.col(html).cast("string").alias("_html"))
    names = ["table_no", "row_no", "col_no", "value", "is_header", "colspan", "rowspan"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            page: list[int] = []
            cells: list[tuple] = []

            def batch() -> pa.RecordBatch:
                at = pa.array(page, pa.int64())
                values = zip(kinds, zip(*cells))
                return pa.RecordBatch.from_arrays([*(c.take(at) for c in b.columns[:-1]), *(pa.array(v, k) for k, v in values)],
                                                  names=[*b.schema.names[:-1], *names])

            for i, text in enumerate(b.column(b.num_columns - 1)):
                text = text.as_py()
                for no, t in enumerate(page_tables(text) if text else ()):
                    first = t.cells[0][0] if t.cells else 0  # 0 where the first tr is left out
                    spans = [(r - first, _span(tag, "colspan", MAX_COLSPAN), _span(tag, "rowspan", MAX_ROWSPAN)) for r, tag, _, _ in t.cells]
                    page.extend([i] * len(spans))
                    cells.extend((no, r, c, _text(parts), head, wide, tall)
                                 for (r, wide, tall), c, (_, _, head, parts) in zip(spans, place(spans), t.cells))
                if len(cells) >= BATCH_CELLS:
                    yield batch()
                    page.clear()
                    cells.clear()
            if cells:
                yield batch()

    ddl = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
    out = src.mapInArrow(run, ", ".join([*ddl, "table_no int, row_no int, col_no int, value string, is_header boolean, colspan int, rowspan int"]))
    if not fill:
        return out
    last = F.max("row_no").over(Window.partitionBy(*keep, "table_no"))
    every = lambda c, n: F.explode(F.sequence(F.col(c), F.col(c) + F.col(n) - 1))
    spread = out.withColumn("_rows", F.least(F.col("rowspan"), last - F.col("row_no") + 1))  # a span ends with its table
    return spread.withColumn("row_no", every("row_no", "_rows")).withColumn("col_no", every("col_no", "colspan")) \
        .select(*keep, "table_no", "row_no", "col_no", "value", "is_header")
