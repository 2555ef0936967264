"""HTML extraction by layout.

A tree builder with implied end tags turns the page into elements; visibility
rules leave out what a browser would not show; and a renderer writes all
visible text, with blank lines between blocks, list markers and indents, line
breaks, preformatted text as it stands, and the cells of tables aligned in
columns.  Both work with explicit stacks, so deep nesting is no problem, and in
time linear in the page.

Row-wise and without a shuffle.  Null and empty pages give an empty text;
broken markup gives a text, never an error.  Only the id and html columns are
read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import bounded_batches

# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = set("head script style template title noembed noframes iframe object audio video canvas datalist "
             "textarea dialog".split())
#: In svg only text elements and foreignObject show text; these show nothing there.
SVG_HIDDEN = set("defs desc metadata symbol clippath mask pattern marker filter lineargradient radialgradient".split())
#: HTML start tags that end an open svg.
ENDS_SVG = set("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
               "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
            "search section summary table caption ul".split())
MARGIN = set("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre table figure hr address fieldset article section".split())
CLOSES_P = BLOCK - {"body", "html", "legend", "optgroup", "option", "caption"}
#: Start tag -> open elements that it ends, up to the nearest of the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"caption", "tr", "tbody", "thead", "tfoot"}, {"table"}), "tbody": ({"caption", "tr", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"caption", "tr", "tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), "body": ({"head"}, {"html"}),
}
#: Tags that may stand in the head; any other start tag, or text, ends it.
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
SCOPE = {"table", "td", "th", "caption", "html", "button", "object"}
#: An attribute: a name, then perhaps "=" and a value.  Only directly after "=" does a quote open a value, if it is ever closed.
NAME, VALUE = r"[^\t\n\f\r />][^\t\n\f\r />=]*+", r"""(?:"[^"]*+"|'[^']*+'|[^\t\n\f\r >]*+)"""
EQUALS = r"[\t\n\f\r ]*+=[\t\n\f\r ]*+"
TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*+(?:>|\Z)"""
                   rf"""|<(?P<start>[a-zA-Z][^\t\n\f\r />]*+)(?P<attrs>(?:[\t\n\f\r /]++|{NAME}(?:{EQUALS}{VALUE})?+)*+)(?:>|\Z)"""
                   r"""|<[!?/][^>]*+(?:>|\Z)""", re.S)
ATTR = re.compile(f"({NAME})(?:{EQUALS}({VALUE}))?+")
STYLE_HIDES = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
#: Widest padding of a column; a longer line is kept whole and the row's later cells start below it, in their columns.
COLUMN = 40
#: Widest stretch of blanks before a cell, as over many spanned columns; a cell beyond stands that far from the text before it.
GAP = 600


class Element:
    __slots__ = ("tag", "attrs", "children", "kind")

    def __init__(self, tag: str, attrs: dict[str, str], kind: str = ""):
        self.tag, self.attrs, self.children, self.kind = tag, attrs, [], kind


def _kind(tag: str, parent: Element) -> str:
    """"" for HTML, "svg" for an svg element, "text" within its text."""
    if tag == "svg":
        return "svg"
    if not parent.kind or parent.tag == "foreignobject":
        return ""
    return "text" if tag == "text" or parent.kind == "text" else "svg"


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTR.findall(text):
        if len(value) > 1 and value[0] in "\"'" and value[0] == value[-1]:
            value = value[1:-1]
        out.setdefault(name.lower(), html.unescape(value))
    return out


def build_tree(page: str) -> Element:
    """Element tree of a page; children are elements and strings."""
    root = Element("#root", {})
    stack = [root]
    count = {"#root": 1}  # open elements by tag

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            count[stack.pop().tag] -= 1

    def find(tags: set[str], barrier: set[str]) -> int:
        """Depth of the outermost element of ``tags`` above the nearest barrier, or -1."""
        if not any(count.get(t) for t in tags):
            return -1
        found = -1
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                found = i
            elif stack[i].tag in barrier:
                break
        return found

    def end_head(tag: str) -> None:
        """The head ends before text (no tag) and before tags that cannot stand in it, also out of its noscript."""
        if stack[-1].tag == "noscript" and stack[-2].tag == "head" and (tag not in IN_HEAD or tag in ("base", "script", "template", "title")):
            close_to(len(stack) - 1)
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            close_to(len(stack) - 1)

    def text(s: str) -> None:
        if s.strip("\t\n\f\r "):
            end_head("")
        stack[-1].children.append(s)

    at = 0
    while True:
        m = TOKEN.search(page, at)
        if not m:
            break
        if m.start() > at:
            text(html.unescape(page[at:m.start()]))
        at = m.end()
        if m["end"]:
            tag = m["end"].lower()
            if tag == "br":
                end_head(tag)
                stack[-1].children.append(Element("br", {}))
            elif count.get(tag):
                barrier = {"table"} if tag in ("td", "th", "tr", "tbody", "thead", "tfoot") else SCOPE - {tag}
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close_to(i)
                        break
                    if stack[i].tag in barrier and tag not in ("table", "body", "html"):
                        break
        elif m["start"]:
            tag = m["start"].lower()
            if tag in ("html", "head") and count.get("head"):
                continue
            end_head(tag)
            if tag in ENDS_SVG and stack[-1].kind:
                depth = len(stack)
                while stack[depth - 1].kind and stack[depth - 1].tag != "foreignobject":
                    depth -= 1
                close_to(depth)
            if tag in CLOSES_P and count.get("p"):
                depth = find({"p"}, SCOPE)
                if depth > 0:
                    close_to(depth)
            if tag in IMPLIED:
                depth = find(*IMPLIED[tag])
                if depth > 0:
                    close_to(depth)
            raw = m["attrs"].strip("\t\n\f\r ")
            node = Element(tag, _attributes(raw) if raw else {}, _kind(tag, stack[-1]))
            stack[-1].children.append(node)
            if tag in VOID or node.kind and ATTR.sub("", m["attrs"]).endswith("/"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
                stop = end.start() if end else len(page)
                if tag not in HIDDEN:
                    node.children.append(page[at:stop])
                close = page.find(">", stop)
                at = close + 1 if end and close >= 0 else len(page)
                continue
            stack.append(node)
            count[tag] = count.get(tag, 0) + 1
        elif stack[-1].kind and page.startswith("<![CDATA[", m.start()):
            stop = page.find("]]>", m.start())
            stack[-1].children.append(page[m.start() + 9:stop if stop >= 0 else len(page)])
            at = stop + 3 if stop >= 0 else len(page)
    if at < len(page):
        text(html.unescape(page[at:]))
    return root


def visible(e: Element) -> bool:
    a = e.attrs
    if e.tag in HIDDEN and not (e.tag == "dialog" and "open" in a):
        return False
    if e.kind and (e.tag in SVG_HIDDEN or a.get("display") == "none" or a.get("visibility") in ("hidden", "collapse")):
        return False
    return "hidden" not in a and not ("style" in a and STYLE_HIDES.search(a["style"]))


class Writer:
    """Lines of one block context."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = ""
        self.marker = ""

    def text(self, s: str) -> None:
        words = s.split()
        if not words:
            self.space = self.space or (bool(s) and bool(self.now))
            return
        if self.now and (self.space or s[0].isspace()):
            self.now.append(" ")
        self.now.append(" ".join(words))
        self.space = s[-1].isspace()

    def raw(self, s: str) -> None:
        for i, line in enumerate(s.split("\n")):
            if i:
                self.line(keep=True)
            self.now.append(line)

    def line(self, keep: bool = False) -> None:
        """End the current line, if it has text or is kept empty."""
        text = "".join(self.now)
        if text or keep:
            if self.gap and self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            lead = self.indent
            if self.marker:
                lead, self.marker = self.indent[:len(self.indent) - len(self.marker)] + self.marker, ""
            self.lines.append((lead + text).rstrip())
        self.now, self.space = [], False

    def block(self, margin: bool) -> None:
        self.line()
        self.gap = max(self.gap, int(margin))


def _place(table: dict, lines: list[str], wide: int, high: int) -> None:
    """Put a cell in the row's next column that no cell from above spans."""
    row, col, held, free = len(table["rows"]), table["col"], table["held"], table["free"]
    passed = []
    while True:
        until, to = free.get(col, (0, 0))
        if until <= row:
            until, to = held.get(col, (0, 0))
            if until <= row:
                break
        passed.append((col, until))
        col = to
    if len(passed) > 1:  # the next row goes by all of them at once, while they are held
        least = 65534 + row
        for c, until in reversed(passed):
            least = min(least, until)
            free[c] = (least, col)
    end = col + wide
    if held:
        for c in range(col + 1, col + wide):
            if c in held and held[c][0] > row:
                end = max(end, held[c][1])
    table["cells"].append((col, lines))
    table["col"] = end
    if high > 1:
        first, until = table["last"]
        if first in held and held[first] == (until, col) and until == row + high:  # next to one of the same height
            held[first] = (until, end)
        else:
            held[col], table["last"] = (row + high, end), (col, row + high)


def _table_lines(rows: list[tuple[list[tuple[int, list[str]]], int]]) -> list[str]:
    """Rows (cells as column and lines, and the row's width) as lines with aligned columns."""
    wide: dict[int, int] = {}
    for row, n in rows:
        for i, cell in row:
            if i < n - 1:
                wide[i] = max([wide.get(i, 0)] + [len(x) for x in cell if len(x) <= COLUMN])
    starts, at = {}, 0
    for i in sorted({i for row, _ in rows for i, _ in row}):
        starts[i] = at + 2 * i
        at += wide.get(i, 0)
    out = []
    for row, _ in rows:
        lines: list[list[str]] = []
        long: list[int] = []  # of each line
        first = 0
        row = [c for c in row if c[1]]
        for j, (i, cell) in enumerate(row):
            room = starts[row[j + 1][0]] - starts[i] - 2 if j + 1 < len(row) else None
            below = first
            more = first + len(cell) - len(lines)
            lines.extend([] for _ in range(more))
            long.extend([0] * more)
            for k, x in enumerate(cell, first):
                if x:
                    gap = min(starts[i] - long[k], GAP)
                    lines[k].append(" " * gap + x)
                    long[k] = max(long[k], starts[i]) + len(x)
                if room is not None and len(x) > room:
                    below = k + 1
            first = below
        out.extend("".join(x).rstrip() for x in lines)
    return out


def render(root: Element) -> str:
    """Visible text of a tree, laid out."""
    out = Writer()
    writers, tables, lists, pre = [out], [], [], 0
    todo: list = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        w = writers[-1]
        if type(node) is str:
            w.raw(node) if pre else w.text(node)
            continue
        tag = node.tag
        block = tag in BLOCK or node.kind and tag in ("text", "foreignobject")
        if leaving:
            if tag in ("td", "th"):
                if tables and tables[-1]["cells"] is not None:
                    w.line()
                    writers.pop()
                    _place(tables[-1], w.lines, *tables[-1]["span"].pop())
            elif tag == "tr":
                if tables and tables[-1]["cells"] is not None:
                    tables[-1]["rows"].append((tables[-1]["cells"], tables[-1]["col"]))
                    tables[-1]["cells"] = None
            elif tag == "table":
                t = tables.pop()
                for line in _table_lines(t["rows"]):
                    w.now = [line]
                    w.line(keep=True)
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            elif tag == "pre":
                pre -= 1
            if tag in ("li", "dd", "blockquote"):
                w.line()
                w.indent, w.marker = node.attrs["#indent"], node.attrs["#marker"]
            if block:
                w.block(tag in MARGIN and not (tag in ("ul", "ol") and lists))
            continue
        if not visible(node):
            continue
        if tag == "br":
            w.line(keep=True)
            continue
        if tag == "img" and node.attrs.get("alt"):
            w.text(node.attrs["alt"])
            continue
        if block:
            w.block(tag in MARGIN and not (tag in ("ul", "ol") and lists))
        if tag == "hr":
            continue
        if tag in ("option", "optgroup") and node.attrs.get("label"):
            w.text(node.attrs["label"])
            if tag == "option":  # shown instead of its text
                w.block(False)
                continue
        if node.kind == "text" and tag == "tspan" and ("x" in node.attrs or "y" in node.attrs):
            w.line()
        if tag in ("li", "dd", "blockquote"):
            node.attrs["#indent"], node.attrs["#marker"] = w.indent, w.marker
            if tag == "li":
                if lists and lists[-1] is not None:
                    lists[-1] += 1
                    mark = f"{lists[-1]}. "
                else:
                    mark = "- "
                w.indent, w.marker = w.indent + " " * len(mark), mark
            else:
                w.indent += "  "
        elif tag in ("ul", "ol", "menu", "dir"):
            start = node.attrs.get("start", "1").strip()
            lists.append((int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1) - 1 if tag == "ol" else None)
        elif tag == "pre":
            pre += 1
        elif tag == "table":
            tables.append({"rows": [], "cells": None, "span": [], "col": 0, "held": {}, "last": (-1, 0), "free": {}})
        elif tag in ("thead", "tbody", "tfoot") and tables:
            tables[-1]["held"], tables[-1]["free"] = {}, {}  # no cell spans rows beyond its group
        elif tag == "tr" and tables:
            tables[-1]["cells"], tables[-1]["col"] = [], 0
        elif tag in ("td", "th") and tables:
            if tables[-1]["cells"] is None:  # a cell outside any row is text of its own
                w.line()
            else:
                span = node.attrs.get("colspan", "1").strip()
                high = node.attrs.get("rowspan", "1").strip()
                tables[-1]["span"].append((min(int(span), 1000) if re.fullmatch(r"[1-9]\d{0,8}", span) else 1,
                                           min(int(high) or 65534, 65534) if re.fullmatch(r"\d{1,9}", high) else 1))
                writers.append(Writer())
        todo.append((node, True))
        quiet = node.kind == "svg" and tag != "foreignobject"
        todo.extend((c, False) for c in reversed(node.children) if not (quiet and type(c) is str))
    out.line()
    return "\n".join(out.lines)


def page_text(page: str | None) -> str:
    return render(build_tree(page)) if page else ""


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text) of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([page_text(x) for x in b.column(1).to_pylist()], pa.string())],
                                             names=[id_col, "text"])

    src = bounded_batches(df.select(id_col, F.col(html_col).cast("string").alias("_html")))
    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, text string")
