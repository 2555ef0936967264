"""Filter audit, top-k search and centroid clustering against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cases import SCHEMA, documents
from quarry.llm import filter_audit, queries, topk_search, va_file
from quarry.plans.compare import compare, duck, type_diff
from quarry.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_topk_search", "op13_centroid_clusters"])
def test_queries_equal_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    rel = duck(SF).execute(queries.SQL[name])
    assert type_diff(got.schema, rel.description) == {}
    assert compare(got.columns, [tuple(r) for r in got.collect()], [d[0] for d in rel.description], rel.fetchall()) == "exact"


# -- filter audit ------------------------------------------------------------
def brute_audit(docs, labels):
    """docs: (id, part, text); labels: (id, quality, toxic)."""
    docs = [(i, p or "", t or "") for i, p, t in docs]
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[j] == 1} for j in (0, 1))
    fails = []
    for i, _, t in docs:
        w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
        f = set()
        f |= {"A"} if len(w) < 100 else set()
        f |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        f |= {"D"} if re.search("[#$%&*|]", t) else set()
        f |= {"E"} if i is not None and any(j is not None and j < i and t == u for j, _, u in docs) else set()
        fails.append(f)
    out = {}
    for part in {p for _, p, _ in docs}:
        own = [(i, f) for (i, p, _), f in zip(docs, fails) if p == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for s, c in enumerate(order, 1):
                gone = [x for x in left if c in x[1]]
                left = [x for x in left if c not in x[1]]
                shapley[c] += len(gone)
                out[part, order, s] = [len(left), len(gone), sum(c in f for _, f in own) - sum(c in f for _, f in left + gone),
                                       sum(f == {c} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for order in map("".join, permutations("ABCDE")):
            for s, c in enumerate(order, 1):
                out[part, order, s].append(shapley[c])
    return {k: tuple(v) for k, v in out.items()}


def audited(df):
    cols = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("shard_bytes", [1, 20_000, filter_audit.SHARD_BYTES])
def test_audit_equals_brute_force(spark, shard_bytes):
    rnd = random.Random(5)
    rows = [(i, t, [None, "", "en", "de"][k % 4], s, n, a, b, c, d) for k, (i, t, _, s, n, a, b, c, d) in enumerate(documents())]
    word = lambda: rnd.choice(["the", "a", "Of", "ABC", "x" * 9, "é", "w%d" % rnd.randrange(400)])
    rows += [(500 + i, " ".join(word() for _ in range(rnd.choice([5, 99, 100, 101, 150, 300]))) + rnd.choice(["", "#", " | ", "\t\x0b\x0c"]),
              "fr", "s", 0, 0, "", "", 0) for i in range(40)]
    rows += [(500, rows[-1][1], "en", "s", 0, 0, "", "", 0), (None, rows[-1][1], "fr", "s", 0, 0, "", "", 0), (None, None, None, "s", 0, 0, "", "", 0)]
    rows += [(9, "\x1c\x85  A B", "fr", "s", 0, 0, "", "", 0)]
    labels = [(i, (i // 3) % 2, int(i % 5 == 0)) for i in range(0, 560, 3)] + [(3, None, 1), (6, 1, None), (None, 1, 1), (3, 1, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audited(filter_audit.filter_audit(docs, lab, shard_bytes=shard_bytes))
    assert got == brute_audit([(r[0], r[2], r[1]) for r in rows], labels)


def test_audit_of_empty_tables(spark):
    docs, lab = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(docs, lab).count() == 0
    one = spark.createDataFrame(documents()[:3], SCHEMA)
    assert filter_audit.filter_audit(one, lab).count() == 600


def test_words_have_one_global_number(spark):
    docs = spark.createDataFrame(documents(), SCHEMA).repartition(4)
    shards = filter_audit.csr_shards(docs, "doc_id", "lang", "text", 3000).cache()
    assert shards.count() > 4
    numbers = filter_audit.global_numbers(shards)
    pairs = numbers.join(shards.select("shard", F.posexplode("vocabulary").alias("at", "word")), ["shard", "at"]) \
        .select("word", "term").distinct().collect()
    every = {w for r in documents() for w in (r[1] or "").encode().split()}
    assert len(pairs) == len({p.word for p in pairs}) == len({p.term for p in pairs}) == len(every)
    # the matrix gives back every document's words
    word = {p.term: p.word for p in pairs}
    rows = filter_audit.matrix_rows(shards, numbers, cells=True).collect()
    got = Counter((r.id, frozenset((word[t], c) for t, c in zip(r.terms, r.counts))) for r in rows)
    split = lambda t: Counter(w for w in re.split("[\x20\x09-\x0d]+", t or "") if w)
    assert got == Counter((r[0], frozenset(split(r[1]).items())) for r in documents())
    shards.unpersist()


def test_shards_of_a_task_do_not_wait_for_each_other(spark, monkeypatch):
    """However many shards a task has, a row group takes them up to a size."""
    monkeypatch.setitem(filter_audit.ROW_GROUPS, "parquet.block.size", "1000")
    docs = spark.createDataFrame(documents(), SCHEMA).coalesce(1)
    at = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = {*at.glob("matrix-*")}
    rows = filter_audit.document_rows(docs, shard_bytes=3000)
    (made,) = {*at.glob("matrix-*")} - before
    groups = [pq.ParquetFile(f).metadata for f in made.glob("*.parquet")]
    assert sum(m.num_rows for m in groups) > 4 and all(m.num_row_groups == m.num_rows for m in groups)
    assert rows.count() == len(documents())


def test_a_shard_is_the_same_in_slices(monkeypatch):
    texts = pa.array([r[1] or "" for r in documents()] + ["", " ", "É#A b", "b A  A\t"])
    ids, parts = pa.array(range(len(texts)), pa.int64()), pa.array(["p"] * len(texts))
    got = []
    for size in (1, 500, 1 << 30):
        monkeypatch.setattr(filter_audit, "SLICE_BYTES", size)
        got.append(filter_audit.csr_shard(0, ids, parts, texts).to_pydict())
    assert got[0] == got[1] == got[2]


# -- top-k search ------------------------------------------------------------
def whole(vec, scale):
    if vec is None or any(x is None or not math.isfinite(x) for x in vec):
        return None
    return [math.floor(scale * float(np.float32(x))) for x in vec]


def brute_search(rows, asked, k, scale):
    rows = {(i, tuple(whole(v, scale))) for i, v in rows if i is not None and whole(v, scale) is not None}
    out = []
    for q, qv in rows:
        if asked(q):
            best = sorted((-sum(a * b for a, b in zip(qv, cv)), c) for c, cv in rows if c != q)[:k]
            out += [(q, n, c, -s) for n, (s, c) in enumerate(best, 1)]
    return sorted(out)


def vectors(kind, n=400, dims=24, seed=1):
    rnd = np.random.default_rng(seed)
    if kind == "dense":
        v = rnd.normal(size=(n, dims))
    elif kind == "sparse":
        v = rnd.gamma(0.5, size=(n, dims)) * (rnd.random((n, dims)) < 0.1)
    elif kind == "negative":
        v = -np.abs(rnd.normal(size=(n, dims)))
    else:  # many ties
        v = rnd.integers(-1, 2, size=(n, dims)) * (rnd.random((n, dims)) < 0.3) / 4
    return [(i, [float(np.float32(x)) for x in r]) for i, r in enumerate(v)]


AWKWARD = [(1000, None), (1001, []), (1005, [0.0] * 24), (1010, [None] * 24), (1015, [float("nan")] + [1.0] * 23), (1020, [float("inf")] * 24),
           (1025, [0.5, -0.25]), (1030, [2.0] * 30), (None, [1.0] * 24), (1035, [1.0] * 24), (1035, [1.0] * 24), (1035, [0.5] * 24), (-5, [1.0] * 24)]


@pytest.mark.parametrize("kind", ["dense", "sparse", "negative", "ties"])
def test_search_equals_brute_force(spark, kind):
    rows = vectors(kind) + AWKWARD
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<float>, id int, shard string").repartition(3)
    got = topk_search.search(df, df.where(topk_search.divisible("vec_id", 5)), 5, scale=256.0, shard_rows=37, block_rows=20)
    assert sorted(map(tuple, got.collect())) == brute_search(rows, lambda q: q % 5 == 0, 5, 256.0)


def test_search_prunes_sparse_vectors():
    rows = vectors("sparse", 3000, 200)
    flat = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    lists = {t: [(r, v[t]) for r, (_, v) in enumerate(flat) if v[t]] for t in range(200)}
    lists = {t: p for t, p in lists.items() if p}
    starts = np.cumsum([0] + [len(p) for p in lists.values()])
    shard = topk_search.Shard(np.arange(3000), np.array(list(lists)), starts, *(np.array([x[j] for p in lists.values() for x in p]) for j in (0, 1)))
    query = dict(enumerate(flat[7][1]))
    scores, ids = shard.best(query, 7, 5, None)
    assert len(ids) == 2999
    fifth = sorted(scores.tolist())[-5]
    near, best = shard.best(query, 7, 5, fifth)
    assert sorted(near.tolist()) == sorted(s for s in scores.tolist() if s >= fifth) and len(best) < 20


def test_search_edges(spark):
    schema = "vec_id long, embedding array<float>"
    none = spark.createDataFrame([], schema)
    some = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5])], schema)
    assert topk_search.search(none, none).count() == 0
    assert topk_search.search(some, none).count() == 0
    assert topk_search.search(none, some).count() == 0
    assert [tuple(r) for r in topk_search.search(some, some.where("vec_id = 0")).collect()] == [(0, 1, 1, 256 * 128 + 512 * 128)]
    huge = spark.createDataFrame([(0, [1e30, 2.0]), (1, [1e30, 0.5])], schema)
    with pytest.raises(ValueError):
        topk_search.search(huge, huge)


def test_copies_of_one_vector_spread_over_shards(spark):
    df = spark.range(1000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>").alias("embedding"))
    sizes = [r.n for r in topk_search.build_index(topk_search._vectors(df, "vec_id", "embedding", 256.0), 100)
             .select(F.size("ids").alias("n")).collect()]
    assert len(sizes) == 10 and max(sizes) < 200
    got = topk_search.search(df, df.where("vec_id = 500"), 5, shard_rows=100)
    assert [r.id for r in got.orderBy("rank").collect()] == [0, 1, 2, 3, 4]


# -- centroid clustering -----------------------------------------------------
def brute_clusters(rows, dims, k, rounds, scale=1024.0):
    kept = [(i, whole(v, scale)) for i, v in rows if v is not None and len(v) == dims and whole(v, scale) is not None]
    key = lambda r: (hashlib.sha256(("3:" + ("" if r[0] is None else str(r[0]))).encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        sets = [[] for _ in cents]
        for _, v in kept:
            sets[near(v)[1]].append(v)
        cents = [[sum(x) // len(s) for x in zip(*s)] if s else c for c, s in zip(cents, sets)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), tuple(cents[j])) for i, j, d in found), key=repr)


@pytest.mark.parametrize("kind,cells", [("dense", 64), ("ties", 4), ("sparse", 16), ("negative", 256)])
def test_clusters_equal_brute_force(spark, kind, cells):
    rows = vectors(kind, 300) + AWKWARD + [(None, [0.25] * 24), (2000, [100.0] + [0.0] * 23)]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, key int").repartition(3)
    got = va_file.centroid_clusters(df, dims=24, k=6, rounds=5, cells=cells)
    assert sorted(((*r[:5], tuple(r[5])) for r in got.collect()), key=repr) == brute_clusters(rows, 24, 6, 5)


def test_intervals_hold_and_decide():
    rnd = np.random.default_rng(4)
    centres = rnd.integers(-600, 600, (5, 16))
    x = (centres[rnd.integers(0, 5, 3000)] + rnd.normal(0, 60, (3000, 16))).astype(np.int64)
    grid = va_file.Grid(x.min(0), x.max(0))
    codes = grid.codes(x)
    rows = np.arange(16)[None, :]
    assert (grid.first[rows, codes] <= x).all() and (x <= grid.last[rows, codes]).all()
    found = va_file.sure(codes, grid.tables(centres))
    want = va_file.nearest(x, centres)[0]
    assert (found >= 0).mean() > 0.95 and (found[found >= 0] == want[found >= 0]).all()
    flat = va_file.Grid(np.zeros(16, np.int64), np.zeros(16, np.int64))
    assert va_file.sure(flat.codes(np.zeros((2, 16), np.int64)), flat.tables(np.ones((3, 16), np.int64))).tolist() == [0, 0]


def test_cluster_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert va_file.centroid_clusters(spark.createDataFrame([], schema)).count() == 0
    few = [(i, [float(i), 1.0]) for i in range(3)] * 2
    got = va_file.centroid_clusters(spark.createDataFrame(few, schema), dims=2)
    assert sorted(((*r[:5], tuple(r[5])) for r in got.collect()), key=repr) == brute_clusters(few, 2, 8, 10)
    with pytest.raises(ValueError):
        va_file.centroid_clusters(spark.createDataFrame([(0, [1e9, 1.0])], schema), dims=2)
