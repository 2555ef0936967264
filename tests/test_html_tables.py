"""Tables of HTML pages against a grid written by hand and a plain parser."""

import random
from html.parser import HTMLParser

import pytest

from quarry.sources.html import html_tables, place


class Reference(HTMLParser):
    """Cells of well-formed tables: [table, row, value, header, colspan, rowspan]."""

    def __init__(self):
        super().__init__()
        self.stack, self.tables, self.cells = [], 0, []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.stack.append({"no": self.tables, "row": -1, "cell": None})
            self.tables += 1
        elif tag == "tr":
            self.stack[-1]["row"] += 1
        elif tag in ("td", "th"):
            a = dict(attrs)
            self.stack[-1]["cell"] = [self.stack[-1]["no"], self.stack[-1]["row"], "", tag == "th", int(a.get("colspan", 1)), int(a.get("rowspan", 1))]
            self.cells.append(self.stack[-1]["cell"])

    def handle_endtag(self, tag):
        if tag == "table":
            self.stack.pop()
        elif tag in ("td", "th"):
            self.stack[-1]["cell"] = None

    def handle_data(self, data):
        if self.stack and self.stack[-1]["cell"]:
            self.stack[-1]["cell"][2] += data


def grid(cells):
    """Placement on a grid of taken positions."""
    taken, out = set(), []
    for r, wide, tall in cells:
        c = 0
        started = [x for (a, _, _), x in zip(cells, out) if a == r]
        c = max(started, default=-1) + 1
        while (r, c) in taken:
            c += 1
        out.append(c)
        taken |= {(i, j) for i in range(r, r + tall) for j in range(c, c + wide)}
    return out


def test_place_equals_grid():
    rnd = random.Random(3)
    for _ in range(300):
        cells = [(r, rnd.choice([1, 1, 2, 3]), rnd.choice([1, 1, 1, 2, 4])) for r in range(6) for _ in range(rnd.randint(0, 4))]
        assert place(cells) == grid(cells)


def page(rnd, depth=0):
    quote = lambda v: rnd.choice([f'"{v}"', f"'{v}'", f"{v}"])
    rows = []
    for _ in range(rnd.randint(1, 4)):
        cells = []
        for _ in range(rnd.randint(1, 3)):
            tag = rnd.choice(["td", "th", "TD"])
            span = rnd.choice(["", f" colspan={quote(2)}", f" rowspan = {quote(2)}", " title='a>b'", ' title="<td>"'])
            inner = page(rnd, depth + 1) if depth < 2 and rnd.random() < 0.2 else rnd.choice(["a", "b c", "é 😀", "", "<i>x</i>y", "<!-- <td> -->z"])
            cells.append(f"<{tag}{span}>{inner}</{tag.lower()}>")
        rows.append("<tr>" + rnd.choice(["", "\n "]).join(cells) + "</tr>")
    return "<table class=x>" + "".join(rows) + "</table>"


def test_pages_equal_plain_parser(spark):
    rnd = random.Random(11)
    pages = [(i, "<p>text" + page(rnd) + "<hr>" + page(rnd)) for i in range(60)]
    got = {}
    for r in html_tables(spark.createDataFrame(pages, "id int, html string"), "html", ["id"]).collect():
        got.setdefault((r.id, r.table_no), []).append((r.row_no, r.col_no, r.value, r.is_header, r.colspan, r.rowspan))
    for i, text in pages:
        ref = Reference()
        ref.feed(text)
        for no in range(ref.tables):
            cells = [c for c in ref.cells if c[0] == no]
            cols = grid([(c[1], c[4], c[5]) for c in cells])
            want = sorted((c[1], col, " ".join(c[2].split()), c[3], c[4], c[5]) for c, col in zip(cells, cols))
            assert sorted(got.pop((i, no))) == want
    assert not got


@pytest.mark.parametrize("html,want", [
    (None, []), ("", []), ("<p>no table", []), ("<table></table>", []), ("<table><tr></table>", []),
    ("<table><td>a<td>b<tr><td>c</table>", [(0, 0, 0, "a"), (0, 0, 1, "b"), (0, 1, 0, "c")]),
    ("</table><table><tr><th>x</table>text</table><table><tr><td>y", [(0, 0, 0, "x"), (1, 0, 0, "y")]),
    ("<table><tr><td>a&amp;&lt;b<br>c</td>lost<td>d</table>", [(0, 0, 0, "a&<b c"), (0, 0, 1, "d")]),
    ("<table><caption>t</caption><tbody><tr><td rowspan=9>a<td>b<tr><td>c</tbody></table>", [(0, 0, 0, "a"), (0, 0, 1, "b"), (0, 1, 1, "c")]),
    ("<script>'<table><td>no'</script><table><tr><td x=it's>v", [(0, 0, 0, "v")]),
])
def test_awkward_pages(spark, html, want):
    df = spark.createDataFrame([(html, 1), (html, 1)], "html string, table_no int")
    got = [(r.table_no, r.row_no, r.col_no, r.value) for r in html_tables(df, "html").collect()]
    assert sorted(got) == sorted(want * 2)


def test_fill_repeats_spanning_cells(spark):
    html = "<table><tr><td rowspan=2>a<td colspan=2>b<tr><td>c<td rowspan=5>d</table>"
    got = html_tables(spark.createDataFrame([(1, html)], "id int, html string"), "html", ["id"], fill=True).collect()
    assert sorted((r.row_no, r.col_no, r.value) for r in got) == [(0, 0, "a"), (0, 1, "b"), (0, 2, "b"), (1, 0, "a"), (1, 1, "c"), (1, 2, "d")]


def test_pages_are_read_row_by_row(spark):
    """No shuffle or window over tokens; script, stray end tags, an open cell and repeated pages as before."""
    html = "</table><TABLE><td>a<br>b &amp;lt; c<script>'<td>no'</script><b x='>'>d</b><tr><th rowspan=2>e<tr><td colspan='x'>f</table></table><td>out<table><tr><td> "
    df = spark.createDataFrame([(1, html), (1, html), (2, None), (3, ""), (4, "<p>none")], "id int, html string")
    out = html_tables(df, "html", ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    want = [(1, 0, 0, 0, "a b &lt; cd", False, 1, 1), (1, 0, 1, 0, "e", True, 1, 2), (1, 0, 2, 1, "f", False, 1, 1), (1, 1, 0, 0, "", False, 1, 1)]
    assert sorted(map(tuple, out.collect())) == sorted(want * 2)
