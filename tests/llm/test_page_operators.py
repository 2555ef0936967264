"""URL filter, WARC and HTML extraction."""

import base64
import gzip
import hashlib
import itertools
import math
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.llm import html_text, queries, url_filter, warc
from quarry.plans.compare import compare, duck
from quarry.session import load

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, verdict string, digest string, id int"


def pages():
    rnd = random.Random(2)
    big = "".join(rnd.choice("<p>é\r\n \n😀ab") for _ in range(200_000))
    same = "<p>copy\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n</p>"
    html = [None, "", same, "\n", big, "x", same, big, same, "no newline", "ends\n", "\r\n\r\n", "", None, "😀"]
    urls = ["http://A.Example.com/en/x?q#f", None, "nonsense", "https://www.example.com/en/1", "http://x.net/es/", "http://x.net/es",
            "http://example.com", "ftp://NET/fr/a", "http://b.org?x=1", "http://b.org#://c", "://", "http://é.com/", "a://b://c/", "", "http://c\r\nd.com/"]
    rows = [(i * 2, u, h, "v", "d", 1) for i, (u, h) in enumerate(zip(urls, html))]
    return rows + [rows[2], (None, "http://n.com/", "x", "", "", 0)]


# -- WARC --------------------------------------------------------------------
def brute_records(rows, least=0):
    best = {}
    for i, _, h, *_ in rows:
        if i is not None:
            best[h or ""] = max(i, best.get(h or "", i))
    out = []
    for i, _, h, *_ in rows:
        data = (h or "").encode()
        r = best.get(h or "") if len(data) >= least else i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if r == i else "revisit", None if r == i else r))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("rows,least,chunk", [(pages(), 0, 1 << 16), (pages(), 4, 7000), ([], 0, 100)], ids=["default", "chunked", "empty"])
def test_warc_round_trip(spark, rows, least, chunk):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), path, min_bytes=least, chunk=chunk)
    chunks = warc.read_archives(spark, path, chunk=chunk).collect()
    got = warc.records(warc.read_archives(spark, path, payload=False, chunk=chunk))
    assert order(tuple(r)[:3] + (r.record_type, r.refers_to) for r in got.collect()) == order(brute_records(rows, least))
    assert all(r.payload_digest == r.stated_digest for r in chunks if r.last)
    assert all(len(r.payload) <= chunk for r in chunks)
    by = {r[0]: (r[2] or "").encode() for r in rows}
    whole = {}
    for r in sorted((r for r in chunks if r.warc_type == "response"), key=lambda r: (r.record_id, r.chunk_no)):
        whole.setdefault(r.record_id, []).append(bytes(r.payload))
    for ident, parts in whole.items():
        n = re.fullmatch(r"<urn:page:(\d*)>", ident)[1]
        text = by[int(n) if n else None]
        assert b"".join(parts).startswith(text) and (b"".join(parts) == text or rows.count(rows[2]) > 1)


def test_cuts_are_at_character_starts(spark):
    text = "aé€😀" * 300 + "\r\n"
    df = spark.createDataFrame([(1, "u", text), (2, "u", "x" * 14), (3, "u", "😀" * 9)], "page_id long, url string, html string")
    for chunk in (4, 5, 7, 64):
        rows = warc.chunk_table(df, "page_id", "url", "html", chunk=chunk).orderBy("id", "chunk_no").collect()
        for i, want in ((1, text), (2, "x" * 14), (3, "😀" * 9)):
            parts = [r.chunk for r in rows if r.id == i]
            assert "".join(parts) == want and "\ufffd" not in want and max(len(p.encode()) for p in parts) <= chunk + 3
            assert [r.n_chunks for r in rows if r.id == i] == [len(parts)] * len(parts)


def test_long_record(spark):
    """A payload of 256 MB: work grows with its size, not with the square."""
    line = "é" + "0123456789abcdef" * 511 + "\n"
    n = (256 << 20) // len(line.encode())
    df = spark.range(1).select(F.col("id").alias("page_id"), F.lit("http://a.com/").alias("url"),
                               F.repeat(F.concat(F.col("id").cast("string"), F.lit(line)), n).alias("html"))
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    warc.write_archives(df, path)
    got = warc.records(warc.read_archives(spark, path, payload=False)).collect()
    data = ("0" + line).encode() * n
    assert [tuple(r)[:3] for r in got] == [(0, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())]


def test_archive_bytes_are_warc(spark):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    warc.write_archives(spark.createDataFrame(pages(), SCHEMA).coalesce(1), path, chunk=50_000)
    import glob
    data = b"".join(gzip.open(f).read() for f in glob.glob(path + "/*.gz"))
    at = n = 0
    while at < len(data):
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
        at += len(head) + 4 + int(re.search(rb"\r\nContent-Length: (\d+)$", head)[1])
        assert data[at:at + 4] == b"\r\n\r\n"
        at, n = at + 4, n + 1
    assert n > len(pages())


def test_truncated_archive_raises(spark):
    path = tempfile.mkdtemp(prefix="warc-")
    with gzip.open(path + "/x.gz", "wb") as f:
        f.write(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort")
    with pytest.raises(Exception, match="truncated"):
        warc.read_archives(spark, path).collect()


def test_warc_query(spark):
    out = queries.op6_warc(spark, SF)
    rel = duck(SF).execute(queries.SQL["op6_warc"])
    assert compare(out.columns, [tuple(r) for r in out.collect()], [d[0] for d in rel.description], rel.fetchall()) == "exact"
    rows = [tuple(r) for r in load(spark, SF, "pages").select("page_id", "url", "html").collect()]
    assert order(map(tuple, out.collect())) == order(brute_records(rows))


# -- URL filter --------------------------------------------------------------
def brute_rule(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    best = None
    for what, rule in rules:
        of, _, p = rule.partition("/")
        if (host == of or host.endswith("." + of)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (what, rule)
    return host, path, best


def test_judge_awkward_urls(spark):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA)
    none = url_filter.mine_rules(spark.createDataFrame([], "url string, block int"))
    got = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in url_filter.judge(df, none, queries.URL_RULES).collect()}
    assert url_filter.judge(df, none, queries.URL_RULES).count() == len(rows)
    for i, u, *_ in rows:
        host, path, best = brute_rule(u, queries.URL_RULES)
        assert got[i, host, path] == ((best[1], best[0]) if best else (None, "allow"))
    empty = spark.createDataFrame([], SCHEMA)
    assert url_filter.judge(empty, none, queries.URL_RULES).collect() == []


def test_rules_equal_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for n in range(400):
        host = rnd.choice(["a", "spam", "b"]) + rnd.choice([".com", ".net"])
        url = f"http://{host}/{rnd.choice(['en', 'fr', 'es'])}/{n}{rnd.choice(['', '?ref=1', '#top'])}"
        rows.append((url, int(("spam" in host and "/es/" in url) or (".net" in host and "ref" in url) or rnd.random() < 0.05)))
    rows += rows[:50] + [(None, 1), ("no url", None)]
    df = spark.createDataFrame(rows, "url string, block int")
    tokens = {r.url: frozenset(r.t) for r in df.select("url", url_filter.url_tokens(df.url).alias("t")).collect()}
    data = [(tokens[u], b) for u, b in rows if b is not None and (tokens[u] or b)]
    want = {}
    for size in range(1, 5):
        for part in {frozenset(c) for t, b in data if b for c in itertools.combinations(sorted(t), size)}:
            n, hits = sum(part <= t for t, _ in data), sum(part <= t and b for t, b in data)
            if hits / len(data) >= 0.03 and hits / n >= 0.6:
                want[part] = hits / n
    want = {p: c for p, c in want.items() if not any(q < p and d >= c for q, d in want.items())}
    rules = url_filter.mine_rules(df, min_support=0.03, min_confidence=0.6, level=1.0)
    got = {frozenset(r.tokens): r.confidence for r in rules.collect()}
    assert got.keys() == want.keys() and len(got) > 2
    assert all(abs(got[p] - want[p]) < 1e-9 for p in got)
    judged = url_filter.judge(df.selectExpr("monotonically_increasing_id() as page_id", "url"), rules).collect()
    urls = [u for u, _ in rows]
    assert sorted((r.host + r.path, r.verdict) for r in judged) == sorted(
        ("".join(brute_rule(u, ())[:2]), "block" if any(p <= tokens[u] for p in want) else "allow") for u in urls)


def brute_rules(data, support, confidence):
    want = {}
    for part in {frozenset(c) for t, b in data if b for k in range(1, len(t) + 1) for c in itertools.combinations(sorted(t), k)}:
        n, hits = sum(part <= t for t, _ in data), sum(part <= t and b for t, b in data)
        if hits / len(data) >= support and hits / n >= confidence:
            want[part] = hits / n
    return {p: c for p, c in want.items() if not any(q < p and d >= c for q, d in want.items())}


def test_small_tables_and_long_rules(spark):
    names = "abcde"
    rows = [("http://h.org/?" + "&".join(q), int(len(q) == 5)) for k in range(6) for q in itertools.combinations(names, k) for _ in range(3 if k == 5 else 1)]
    rows += [("http://h.org/x?a", 1), ("http://h.org/y", 0), ("http://" + ".".join(f"l{i}" for i in range(40)) + ".net/z?a", 1)]
    df = spark.createDataFrame(rows, "url string, block int")
    tokens = {r.url: frozenset(r.t) for r in df.select("url", url_filter.url_tokens(df.url).alias("t")).collect()}
    once = frozenset(t for t in tokens[rows[-1][0]] if t.startswith(("host:", "domain:", "tld:net", "path:")))  # all its rules have one token
    got = {frozenset(r.tokens): r.confidence for r in url_filter.mine_rules(df, level=1.0).collect()}
    short = [(tokens[u] - once | ({"path:z"} if once <= tokens[u] else set()), b) for u, b in rows]
    want = brute_rules(short, url_filter.MIN_SUPPORT, url_filter.MIN_CONFIDENCE)
    want.update({frozenset([t]): 1.0 for t in once})
    assert got == want and max(map(len, got)) == 5 and frozenset(["path:x"]) in got
    assert url_filter.mine_rules(df.selectExpr("url", "0 as block")).collect() == []


def chance(n, hits, base):
    """Hoeffding's bound on that many hits or more."""
    c = hits / n
    if c <= base:
        return 1.0
    return math.exp(-n * (c * math.log(c / base) + ((1 - c) * math.log((1 - c) / (1 - base)) if c < 1 else 0)))


def random_urls(rnd, n):
    return [f"http://{rnd.choice('abcdefgh')}{rnd.randrange(40)}.{rnd.choice(['com', 'net', 'org'])}/{rnd.choice('xyz')}/{rnd.randrange(n)}" for _ in range(n)]


def test_few_rules_survive_labels_of_chance(spark):
    rnd = random.Random(8)
    all_rules = kept = 0
    for n, share in ((100, 0.2), (500, 0.1)):
        df = spark.createDataFrame([(u, int(rnd.random() < share)) for u in random_urls(rnd, n)], "url string, block int")
        all_rules += url_filter.mine_rules(df, level=1.0).count()
        kept += url_filter.mine_rules(df).count()
    assert all_rules > 50 and kept <= 0.01 * all_rules


@pytest.mark.parametrize("n", [100, 2000])
def test_planted_combinations_survive(spark, n):
    rnd = random.Random(9)
    rows = [(u, int(rnd.random() < 0.08)) for u in random_urls(rnd, n)]
    # five urls of two tokens together, each of which is also in clean urls
    rows += [(f"http://spam.shop{i}.biz/buy/{i}", 1) for i in range(5)] + [(f"http://spam.ok{i}.com/read/{i}", 0) for i in range(9)]
    rows += [(f"http://www.fine{i}.com/buy/{i}", 0) for i in range(9)]
    df = spark.createDataFrame(rows, "url string, block int")
    tokens = {r.url: frozenset(r.t) for r in df.select("url", url_filter.url_tokens(df.url).alias("t")).collect()}
    rules = {frozenset(r.tokens): r for r in url_filter.mine_rules(df).collect()}
    planted = tokens["http://spam.shop1.biz/buy/1"]
    assert any(p <= planted for p in rules)
    base = sum(b for _, b in rows) / len(rows)
    for part, r in rules.items():
        m, hits = sum(part <= tokens[u] for u, _ in rows), sum(part <= tokens[u] and b for u, b in rows)
        assert abs(r.confidence - hits / m) < 1e-9 and chance(m, hits, base) <= url_filter.LEVEL * 1.0001
    # the bound drops rules only: those left are those of all rules that it lets through
    every = {frozenset(r.tokens) for r in url_filter.mine_rules(df, level=1.0).collect()}
    count = lambda part: (sum(part <= tokens[u] for u, _ in rows), sum(part <= tokens[u] and b for u, b in rows))
    assert set(rules) == {p for p in every if chance(*count(p), base) <= url_filter.LEVEL}


def test_url_query(spark):
    rows = load(spark, SF, "pages").select("page_id", "url").collect()
    got = {r.page_id: r for r in queries.op1_url_filter(spark, SF).collect()}
    assert len(got) == len(rows)
    for i, u in rows:
        host, path, best = brute_rule(u, queries.URL_RULES)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        assert r.verdict == (best[0] if best else "allow" if r.confidence is None else "block")


# -- HTML --------------------------------------------------------------------
@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two", "one\n\ntwo"), ("<p>a <b>b</b>c<br>d</p>e", "a bc\nd\n\ne"),
    ("<ul><li>a<li>b<ol><li>c<li>d</ol></ul>z", "- a\n- b\n  1. c\n  2. d\n\nz"),
    ("<ol start=7><li><p>x</p><p>y</p><li>z</ol>", "7. x\n\n   y\n\n8. z"),
    ("<title>t</title><style>p{}</style><script>var t='</p>';</script><p hidden>h</p><p style='color:red; DISPLAY : none'>n</p>v", "v"),
    ("<div>a</div><div>b</div>", "a\nb"), ("<pre> x\n  y</pre>", " x\n  y"),
    ("<table><tr><td>a<td>long cell<tr><td>bb<td>c</table>", "a   long cell\nbb  c"),
    ("<table><tr><th colspan=2>h<th>k<tr><td>1<td>2<td>3</table>", "h     k\n1  2  3"),
    ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>z</table>", "a        z\n\nin  ner"),
    ("<!-- a --><p>b<!-- <p>x --> c", "b c"), ("a<!doctype html>b", "ab"), ("x < y & z <3", "x < y & z <3"),
    ("<p title='a>b'>q</p>", "q"), ("<p title='unclosed>q</p>r", "q\n\nr"), ("</p></div>end", "end"),
    ("<a href=x>l</a> <img alt='pic'> <input value=v>", "l pic"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("<td>loose</td>", "loose"), ("&copy; &am &#x41; &notit;", "© &am A ¬it;"), ("<textarea>no</textarea>yes", "yes"),
])
def test_render(page, text):
    assert html_text.page_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<html><head><title>T</title><p>Hello <b>you</b><p>all", "Hello you\n\nall"), ("<head><meta charset=x>\n loose text<div>d</div>", "loose text\nd"),
    ("<head><title>T</title></head><p>x", "x"), ("<head><title>T</title><body><p>x", "x"), ("<head>\n<style>p{}</style>\n<link rel=x>\n<h1>h</h1>", "h"),
    ("<head><script>s</script><template>t</template><noscript><link></noscript><title>T</title>v", "v"), ("<head><html><head>v", "v"),
    ("<head><noscript><p>n</p></noscript><title>T</title><p>v", "n\n\nv"), ("<head><title>T</title></body>v", "v"), ("<head>&nbsp;&amp; more", "& more"),
    ("<head><title>A</title><p>a</html><html><head><title>B</title><p>b", "a\n\nb"),
])
def test_head_without_end_tag(page, text):
    assert html_text.page_text(page) == text


@pytest.mark.parametrize("page,text", [
    ('<a href="x"">Link</a> text <a href="y">Two</a> more <a href="z">Three</a>', "Link text Two more Three"),
    ("<p class=it's>Some text isn't lost</p>", "Some text isn't lost"), ("<p class=it's>one</p><p class='b'>two</p>", "one\n\ntwo"),
    ('<p title="a>b" " id="c">q</p><p title=\'"\'>r</p>', "q\n\nr"), ('<p ="x>y</p><p id="z">w', "y\n\nw"), ('<p"x>y</p> <b id="z">w</b>', "y w"),
    ("<p title = 'a>b'id=\"c>d\">q", "q"), ("<p title=>q</p><p id='r'>s", "q\n\ns"), ('<p title="unclosed>q</p>r', "q\n\nr"),
    ("<p title=x\u00a0y='>q</p><p id='r'>s", "q\n\ns"), ('<img alt="it\'s"> <img alt=\'"a"\'> <img alt=b\'> <img alt=c/>', "it's \"a\" b' c/"),
    ('<p style="display:none"">n</p><p style=display:none>n</p>v', "v"), ("b<a/href=x>c</a><br/>d", "bc\nd"),
])
def test_quotes_in_tags(page, text):
    assert html_text.page_text(page) == text


def test_quotes_stay_linear():
    import time
    for part in ("<p a='", "<p a=\"'", "<p a=x\"", "<p '\"=", "<p a = ", "<p a=\"b\"\"", "<p " + " " * 50):
        began = time.process_time()
        html_text.page_text(part * 20_000)
        html_text.page_text(part * 20_000 + ">")
        assert time.process_time() - began < 5, part


@pytest.mark.parametrize("page,text", [
    ("Pick <select><option>A<option selected>B</select> now", "Pick\nA\nB\nnow"), ("<select><option>A<p>B", "A\n\nB"),
    ("<select><optgroup label=G><option>a<option label='b'>x<optgroup label=H><option hidden>h<option>c</select>", "G\na\nb\nH\nc"),
    ("<datalist><option>no</datalist>yes", "yes"),
    ("a <svg viewBox='0 0 1 1'><title>t</title><desc>d</desc><style>s</style><defs><text>no</text></defs>stray<g><path d='M0'/>"
     "<text x=1>Sales <tspan>2020</tspan></text><text>Cost</text></g></svg> b", "a\nSales 2020\nCost\nb"),
    ("<svg><defs/><title/><text x='1'/>no<text><tspan x=0>one</tspan><tspan x=0>two</tspan><![CDATA[<3]]></text></svg>z", "one\ntwo<3\nz"),
    ("<svg><foreignObject><div/>in<p>side</p></foreignObject><text display=none>no</text><text fill=a/>label</text></svg>", "in\n\nside\n\nlabel"),
    ("<svg><path d=x><p>out", "out"), ("<p>a <svg><use href=#i /></svg>b", "a b"),
])
def test_select_and_svg_text(page, text):
    assert html_text.page_text(page) == text


LONG = "long " * 9 + "cell"


@pytest.mark.parametrize("page,text", [
    (f"<table><tr><td>a<td>b<td>c<tr><td>{LONG}<td>d<td>e<tr><td>f<td>g<td>h</table>", f"a  b  c\n{LONG}\n   d  e\nf  g  h"),
    (f"<table><tr><td>{LONG}<td>x{LONG}<td>e<tr><td>fff<td>g<td>h</table>", f"{LONG}\n     x{LONG}\n        e\nfff  g  h"),
    (f"<table><tr><td>a<td>{LONG}<tr><td>b<td>c</table>", f"a  {LONG}\nb  c"),
    (f"<table><tr><td>p<br>{LONG}<br>q<td>r<tr><td>s<td>t</table>", f"p\n{LONG}\nq  r\ns  t"),
    ("<table><tr><td rowspan=2>aa<td>b<td>c<tr><td>d<td>e<tr><td>f<td>g<td>h</table>", "aa  b  c\n    d  e\nf   g  h"),
    ("<table><tr><td>a<td rowspan=3 colspan=2>bb<td>c<tr><td>d<td>e<tr><td>f<td>g<tr><td>h<td>i<td>j<td>k</table>",
     "a  bb     c\nd         e\nf         g\nh  i   j  k"),
    ("<table><tr><td rowspan=0>a<td rowspan=0>b<td>c<tr><td>d<tbody><tr><td>e<td>f<td>g</table>", "a  b  c\n      d\ne  f  g"),
    ("<table><tr><td>a<td rowspan=2>b<td>c<tr><td colspan=2>dd<td>e</table>", "a   b  c\ndd     e"),
    ("<table><tr><td rowspan=x>a<td>b<tr><td>c<td>d</table>", "a  b\nc  d"),
])
def test_table_columns(page, text):
    assert html_text.page_text(page) == text


def test_huge_tables_keep_their_text():
    cells = "".join(f"<td rowspan={9000 - i % 7 * 1000} colspan=9>a" for i in range(3000))
    for page in (f"<table><tr>{cells}" + "<tr><td>b" * 9000, "<table><tr>" + "<td rowspan=0 colspan=1000>a" * 3000 + "<tr><td>b" * 9000):
        text = html_text.page_text(page)
        assert (text.count("a"), text.count("b")) == (3000, 9000) and len(text) < 8_000_000


def test_large_tables_are_laid_out_like_small_ones():
    cell = lambda i, j: f"<td>{i * j % 977}"
    text = html_text.page_text("<table>" + "".join("<tr>" + "".join(cell(i, j) for j in range(400)) for i in range(400)) + "</table>")
    wide = [max(len(str(i * j % 977)) for i in range(400)) for j in range(400)]
    want = ["  ".join(str(i * j % 977).ljust(w) for j, w in enumerate(wide)).rstrip() for i in range(400)]
    assert text.split("\n") == want


def test_many_spanned_columns_are_stepped_over_in_every_row():
    cells = "".join(f"<td rowspan={3000 + i % 2}>" for i in range(300)) + "<td>a"
    lines = html_text.page_text(f"<table><tr>{cells}" + "<tr><td>b" * 2999 + "<tr><td>c</table>").split("\n")
    assert lines[0].index("a") == lines[1].index("b") == lines[2999].index("b") == 600 and len(lines) == 3001 and lines[3000] == "c"


def test_render_extremes():
    assert html_text.page_text("<div>" * 50_000 + "x") == "x"
    assert html_text.page_text("<b><p>" * 20_000 + "x" + "</b>" * 20_000).strip() == "x"
    assert html_text.page_text("<" * 100_000).startswith("<")
    assert len(html_text.page_text("<p a='" * 3000)) >= 0
    wide = "<table>" + "<tr><td>a<td>b" * 2000 + "<tr><td>" + "w" * 100_000 + "<td>c</table>"
    assert len(html_text.page_text(wide)) < 300_000


def visible_words(page):
    """Words of a generated page by regular expressions alone."""
    page = re.sub(r"(?s)<!--.*?-->|<(title|style|script)\b.*?</\1>", " ", page)
    import html
    return html.unescape(re.sub(r"<(?:/?(?:b|a)\b)[^>]*>", "", re.sub(r"<(?!/?(?:b|a)\b)[^>]*(>|$)", " ", page))).split()


def test_html_query(spark):
    rows = {r.page_id: r.html for r in load(spark, SF, "pages").collect()}
    got = {r.page_id: r.text for r in queries.op10_html_text(spark, SF).collect()}
    assert got.keys() == rows.keys()
    for i, page in rows.items():
        assert got[i].replace("\n- ", "\n").removeprefix("- ").split() == visible_words(page)


def test_html_awkward_table(spark):
    rows = pages()
    assert html_text.extract(spark.createDataFrame(rows, SCHEMA)).count() == len(rows)
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).collect() == []
