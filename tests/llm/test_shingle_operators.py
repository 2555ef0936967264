"""SimHash, sketches and decontamination against brute force."""

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from cases import BENCH_SCHEMA, SCHEMA, benchmark, documents
from quarry.llm import decontaminate, queries, simhash, sketches
from quarry.session import load

SF = "/root/testdata/sf0.001"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# -- SimHash ---------------------------------------------------------------
def brute_fingerprint(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, bits=4):
    """[(id, fingerprint)] -> [(id, fingerprint, component)]"""
    fps = [f for _, f in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [(i, f, least.get(g)) for (i, f), g in zip(rows, group)]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("empty", [False, True])
def test_simhash_awkward_table(spark, empty):
    rows = [] if empty else documents() + [(None, "stray", None, None, None, 0, "", "", 0), (None, None, None, None, None, 0, "", "", 0)]
    out = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    got = [(r.doc_id, r.fp & (2 ** 64 - 1), r.component_id) for r in out.collect()]
    assert key(got) == key(brute_components([(r[0], brute_fingerprint(r[1])) for r in rows]))


def test_simhash_query(spark):
    docs = load(spark, SF, "documents").collect()
    got = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in queries.op7_simhash(spark, SF).collect()]
    assert key(got) == key(brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in docs]))


@pytest.mark.parametrize("n", [10, 10 ** 5, 10 ** 6, 10 ** 10])
@pytest.mark.parametrize("bits", [0, 1, 3, 4, 7])
def test_segment_plan_covers(n, bits):
    plan = simhash.segment_plan(n, bits) if bits else [(0, 64, 0)]
    assert sum(w for _, w, _ in plan) == 64
    assert sum(r + 1 for *_, r in plan) == bits + 1  # more differing bits than any miss of all segments allows


@pytest.mark.parametrize("n", [10, 10 ** 6])
def test_links_equal_brute_force(spark, n):
    import random
    rnd = random.Random(1)
    base = [rnd.getrandbits(64) for _ in range(40)]
    fps = {b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, 6))) for b in base for _ in range(6)}
    signed = [f - 2 ** 64 if f >> 63 else f for f in fps]
    for bits in (3, 4):
        got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits, n).distinct().collect()
        got = {frozenset((r.src, r.dst)) for r in got}
        assert got == {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= bits}


# -- sketches ----------------------------------------------------------------
def brute_shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute_edited(rows):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    text = {r[0]: r[1] or "" for r in rows}
    after = {i: text[ids[(n + 1) % len(ids)]] for n, i in enumerate(ids)}
    out = []
    for r in rows:
        t = r[1] or ""
        q = len(t) // 4
        out.append((r[0], t, t[:len(t) - q] + after.get(r[0], "")[:q], after.get(r[0], "")))
    return out


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("rows", ["awkward", "empty", "one", "null id"])
def test_edited_fingerprints(spark, rows):
    rows = {"awkward": documents(), "empty": [], "one": documents()[20:21],
            "null id": documents()[8:14] + [(None, "a b c d e f g h", "", "", 0, 0, "", "", 0)]}[rows]
    made = sketches.edited_fingerprints(spark.createDataFrame(rows, SCHEMA), k=100_000)  # all shingles kept: exact likeness
    own = F.col("sketch")
    got = made.select("doc_id", "n_chars", "edited", F.round(sketches.resemblance(own, F.col("edited_sketch"), 100_000), 9),
                      F.round(sketches.resemblance(own, F.col("next_sketch"), 100_000), 9),
                      F.size("sketch"), F.round(sketches.containment(own, F.col("edited_sketch"), 100_000), 6)).collect()
    want = []
    for i, t, e, nxt in brute_edited(rows):
        a, b, c = brute_shingles(t), brute_shingles(e), brute_shingles(nxt)
        want.append((i, len(t), e, round(likeness(a, b), 9), round(likeness(a, c), 9), len(a), round(len(a & b) / len(a), 6) if a else 1.0))
    assert key(map(tuple, got)) == key(want)


def test_fingerprint_query(spark):
    docs = [tuple(r) for r in load(spark, SF, "documents").select("doc_id", "text").collect()]
    want = {i: (t, e, nxt) for i, t, e, nxt in brute_edited(docs)}
    got = queries.op9_fingerprints(spark, SF).collect()
    assert len(got) == len(docs)
    by_text, errors = {}, []
    for r in got:
        t, e, nxt = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        by_text.setdefault(t, set()).add(r.fingerprint)
        a, b, c = map(brute_shingles, (t, e, nxt))
        errors += [abs(r.near_edited - likeness(a, b)), abs(r.near_next - likeness(a, c))]
    assert all(len(x) == 1 for x in by_text.values()) and len({x for s in by_text.values() for x in s}) == len(by_text)
    assert sum(errors) / len(errors) < 0.03 and max(errors) < 0.3


def test_sketches_merge(spark):
    a, b = "a b c d e f g h i", "e f g h i j k l m n"
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        sketches.merge(sketches.sketch(F.col("a"), 4), sketches.sketch(F.col("b"), 4), 4).alias("m"),
        F.slice(F.sort_array(F.array_union(sketches.sketch(F.col("a"), 99), sketches.sketch(F.col("b"), 99))), 1, 4).alias("w")).first()
    assert row.m == row.w


# -- decontamination ---------------------------------------------------------
def brute_contamination(docs, items, window=13):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    wins = {}
    for i, t, *_ in items:
        w = split(t)
        for s in range(max(len(w) - window, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[s:s + window]), set()).add("" if i is None else str(i))
    out = []
    for i, t, *_ in docs:
        w = split(t)
        hit, found = set(), set()
        for win, ids in wins.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    found |= ids
        out.append((i, len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("docs,items", [(documents(), benchmark()), ([], benchmark()), (documents(), []),
                                        (documents() + [(None, "two words smile", "", "", 0, 0, "", "", 0)], benchmark() + [(None, "one", "")])],
                         ids=["awkward", "no documents", "no items", "null ids"])
def test_contamination(spark, docs, items):
    out = decontaminate.contamination(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, BENCH_SCHEMA))
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in out.collect()]
    assert key(got) == key(brute_contamination(docs, items))


def test_contamination_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    docs, items = documents(), benchmark()
    out = decontaminate.contamination(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, BENCH_SCHEMA))
    assert key((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in out.collect()) == key(brute_contamination(docs, items))


def test_contamination_query(spark):
    docs = [tuple(r) for r in load(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in load(spark, SF, "benchmark").collect()]
    got = {r.doc_id: r for r in queries.op2_decontaminate(spark, SF).collect()}
    for i, n, hit, found in brute_contamination(docs, items):
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0 and 20 * hit >= n)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
