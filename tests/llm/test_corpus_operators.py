"""Suffix-array deduplication against brute force; toxicity by held-out accuracy."""

import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import SCHEMA, documents
from quarry.llm import queries, suffix_dedup, toxicity
from quarry.session import load

SF = "/root/testdata/sf0.001"
SF_MORE = "/root/testdata/sf0.1"


# -- suffix arrays -----------------------------------------------------------
def joined(runs):
    lens = np.array(list(map(len, runs)))
    ends = np.cumsum(lens)
    return np.frombuffer(b"".join(runs), np.uint8), ends - lens, ends


def shared(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_suffix_array_and_common_prefixes():
    rnd = random.Random(1)
    for trial in range(150):
        runs = [bytes(rnd.choice(b"ab" if trial % 2 else b"abcde\0\xff") for _ in range(rnd.randint(1, 60))) for _ in range(rnd.randint(1, 12))]
        runs += (runs[:2] if trial % 3 == 0 else []) + ([b"a" * 80] if trial % 5 == 0 else [])
        data, starts, ends = joined(runs)
        want = sorted((bytes(data[p:ends[r]]), r, p) for r in range(len(runs)) for p in range(starts[r], ends[r]))
        sa, rank = suffix_dedup.suffix_array(data, starts, ends)
        assert sa.tolist() == [x[2] for x in want]
        lcp = suffix_dedup.common_prefixes(data, starts, ends, sa, rank)
        assert lcp.tolist() == [0] + [shared(a[0], b[0]) for a, b in zip(want, want[1:])]


def test_suffix_array_of_wide_and_periodic_runs():
    rnd = random.Random(3)
    phrase = bytes(rnd.randrange(256) for _ in range(300))
    runs = [bytes(range(256)) * 2, b"ab" * 400, b"ba" * 400, phrase * 2, b"\xff" + phrase, phrase[5:], b"\0" * 500, b"x"]
    data, starts, ends = joined(runs)
    want = sorted((bytes(data[p:ends[r]]), r, p) for r in range(len(runs)) for p in range(starts[r], ends[r]))
    sa, rank = suffix_dedup.suffix_array(data, starts, ends)
    assert sa.tolist() == [x[2] for x in want] and (rank[sa] == np.arange(len(data))).all()
    lcp = suffix_dedup.common_prefixes(data, starts, ends, sa, rank)
    assert lcp.tolist() == [0] + [shared(a[0], b[0]) for a, b in zip(want, want[1:])]


@pytest.mark.parametrize("top", [9, 2 ** 31 - 1])
def test_order_in_one_word_and_beyond(top):
    rnd = np.random.default_rng(4)
    a, b = rnd.integers(0, 9, 5000), rnd.integers(0, 7, 5000)
    order, new = suffix_dedup._order([a, b], [top, top])
    assert order.tolist() == np.lexsort([b, a]).tolist()
    pairs = list(zip(a[order].tolist(), b[order].tolist()))
    assert new.tolist() == [True] + [x != y for x, y in zip(pairs[1:], pairs)]


def test_common_prefixes_take_no_step_a_byte():
    data, starts, ends = joined([np.random.default_rng(5).integers(0, 256, 200_000, np.uint8).tobytes()])
    sa, rank = suffix_dedup.suffix_array(data, starts, ends)
    began = time.process_time()
    suffix_dedup.common_prefixes(data, starts, ends, sa, rank)
    assert time.process_time() - began < 2  # a numpy step a byte took 15.7 s


@pytest.mark.parametrize("min_len", [1, 4, 5, 20, 33])
def test_equal_windows_have_equal_keys(min_len):
    rnd = random.Random(2)
    seen = {}
    for _ in range(40):
        text = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 120)))
        keys, first, n, _ = suffix_dedup.text_runs(text, min_len)
        assert n.sum() == max(0, len(text) - min_len + 1)
        for k, f, m in zip(keys.tolist(), first.tolist(), n.tolist()):
            for p in range(f, f + m):
                assert seen.setdefault(text[p:p + min_len], k) == k


def brute_repeats(texts, min_len):
    datas = [(t or "").encode() for t in texts]
    count = {}
    for d in datas:
        for p in range(len(d) - min_len + 1):
            count[d[p:p + min_len]] = count.get(d[p:p + min_len], 0) + 1
    out = []
    for d in datas:
        gone = np.zeros(len(d) + 1, np.int8)
        for p in range(len(d) - min_len + 1):
            if count[d[p:p + min_len]] > 1:
                gone[p:p + min_len] = 1
        spans = np.flatnonzero(np.diff(np.concatenate([[0], gone]))).tolist()
        out.append((len(d), spans, bytes(c for c, g in zip(d, gone) if not g)))
    return out


def checked(spark, rows, schema, min_len, shard_bytes):
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, schema), min_len=min_len, shard_bytes=shard_bytes).collect()
    got = sorted(((r.doc_id, (r.n_bytes, list(r.spans), bytes(r.kept))) for r in out), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    want = sorted(zip([r[0] for r in rows], brute_repeats([r[1] for r in rows], min_len)), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    assert got == want


@pytest.mark.parametrize("shard_bytes", [1 << 20, 3000])
@pytest.mark.parametrize("min_len", [400, 40])
def test_removal_on_awkward_table(spark, min_len, shard_bytes):
    rows = documents() + [(None, "null id " * 90, "", "", 0, 0, "", "", 0)]
    checked(spark, rows, SCHEMA, min_len, shard_bytes)


def test_removal_across_split_keys(spark):
    """Shards of a few runs: one key's equal windows are in different shards."""
    rnd = random.Random(7)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(70))
    rows = []
    for i in range(60):
        left, right = ("".join(rnd.choice("xyz") for _ in range(rnd.randint(5, 60))) for _ in range(2))
        rows.append((i, left + passage + right if i % 3 else left + passage[rnd.randint(0, 20):] + right))
    rows += [(100, "é" * 300), (101, "ab" * 200), (102, None), (103, "")]
    checked(spark, rows, "doc_id long, text string", 50, 150)


def test_removal_on_empty_table(spark):
    checked(spark, [], SCHEMA, 400, 1 << 20)
    checked(spark, [(1, ""), (2, None)], "doc_id long, text string", 400, 1 << 20)


def test_removal_query(spark):
    rows = load(spark, SF, "documents").collect()
    want = {r.doc_id: w for r, w in zip(rows, brute_repeats([r.text for r in rows], 400))}
    got = queries.op8_suffix_dedup(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        n, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n, n - len(kept), len(spans) // 2)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert sum(r.n_removed for r in got) > 0


@pytest.mark.parametrize("shard_bytes", [1 << 20, 150])
@pytest.mark.parametrize("min_len, also", [(50, [20]), (20, [50, 31]), (33, [32, 80])])
def test_several_lengths_in_one_pass(spark, min_len, also, shard_bytes):
    """Bytes behind a run's windows belong to the next run too: they are no second occurrence."""
    rnd = random.Random(9)
    letters = lambda n, of="abcdefgh ": "".join(rnd.choice(of) for _ in range(n))
    passages = [letters(n) for n in (19, 20, 21, 31, 35, 49, 50, 51, 79, 80, 90, 300)]
    rows = [(i, letters(rnd.randint(0, 60), "xyz") + passages[i % 12][rnd.randint(0, 1) * (i % 3):] + letters(rnd.randint(0, 60), "uvw")) for i in range(60)]
    rows += [(100, "é" * 200), (101, "ab" * 150), (102, None), (103, ""), (104, rows[11][1]), (None, rows[10][1]), (105, letters(2000))]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), min_len=min_len, also=also,
                                      shard_bytes=shard_bytes).collect()
    known = lambda x: (x[0] is None, x[0] or 0)
    for n in [min_len, *also]:
        want = [(r[0], w[1]) for r, w in zip(rows, brute_repeats([r[1] for r in rows], n))]
        got = [(r.doc_id, list(r["spans" if n == min_len else f"spans_{n}"])) for r in out]
        assert sorted(got, key=known) == sorted(want, key=known)
        assert any(s for _, s in want)


def test_removal_query_finds_passages_of_over_50_words(spark, tmp_path):
    rnd = random.Random(10)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows, planted = [], set()
    for i in range(0, 60, 2):
        passage = prose(51 + i % 9)
        assert 200 <= len(passage) < 400
        for d in (i, i + 1):
            rows.append((d, f"{prose(80)} {passage} {prose(80)}"))
            planted.add(d)
    rows += [(100 + i, prose(200)) for i in range(60)] + [(200, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op8_suffix_dedup(spark, str(tmp_path)).collect()
    want = {r[0]: w for r, w in zip(rows, brute_repeats([r[1] for r in rows], 200))}
    assert {r.doc_id for r in got if r.n_repeated_200 > 0} == planted
    for r in got:
        n, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_repeated_200, r.n_spans_200) == (n, 0, n - len(kept), len(spans) // 2)


# -- toxicity ----------------------------------------------------------------
def test_ordinal_regression_recovers_thresholds():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(6000, 3))
    latent = x @ [2.0, -1.0, 0.0] + rnd.logistic(size=6000)
    grade = np.digitize(latent, [0.0, 2.0, 4.0])
    rows, cols = np.repeat(np.arange(6000), 3), np.tile(np.arange(3), 6000)
    w, t, grades = toxicity.fit_ordinal(rows, cols, x.ravel(), grade, 3, l2=1e-3)
    assert np.allclose(w, [2, -1, 0], atol=0.15) and np.allclose(t, [0, 2, 4], atol=0.2) and grades.tolist() == [0, 1, 2, 3]
    model = toxicity.OrdinalModel({}, w, t, grades)
    eta = np.array([-5.0, 1.0, 9.0])
    assert model.grade(eta).tolist() == [0, 1, 3] and (np.diff(model.severity(eta)) > 0).all()


def test_gradient_is_the_loss_slope():
    rnd = np.random.default_rng(5)
    rows, cols, vals = np.repeat(np.arange(50), 4), rnd.integers(0, 6, 200), rnd.random(200)
    seen = {}

    def spy(f, x):
        seen["f"], seen["x"] = f, x + rnd.normal(size=len(x)) * 0.3
        return x

    original, toxicity._minimise = toxicity._minimise, spy
    try:
        toxicity.fit_ordinal(rows, cols, vals, rnd.integers(0, 4, 50), 6)
    finally:
        toxicity._minimise = original
    f, x = seen["f"], seen["x"]
    value, grad = f(x)
    for i in range(len(x)):
        d = np.zeros(len(x))
        d[i] = 1e-6
        assert abs((f(x + d)[0] - f(x - d)[0]) / 2e-6 - grad[i]) < 1e-4


def test_held_out_accuracy(spark):
    docs, labels = load(spark, SF_MORE, "documents"), load(spark, SF_MORE, "labels")
    model = toxicity.fit(docs, labels.where("doc_id % 2 = 0"))
    truth = {r.doc_id: r.toxic for r in labels.where("doc_id % 2 = 1").collect()}
    out = toxicity.score(docs, model).withColumn("bad", toxicity.rejected()).collect()
    assert len(out) == docs.count()
    caught = [r.bad for r in out if truth.get(r.doc_id) == 1]
    clean = [r.bad for r in out if truth.get(r.doc_id) == 0]
    assert sum(caught) / len(caught) > 0.88 and sum(clean) / len(clean) < 0.01


@pytest.mark.parametrize("labels", [[], [(3, None)], [(3, 0), (9, 0)], [(3, 1), (9, 1)], [(3, 1), (3, 0), (9, 0), (None, 1)]])
def test_toxicity_awkward_tables(spark, labels):
    df = spark.createDataFrame(documents(), SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.score(df, toxicity.fit(df, lab)).collect()
    assert len(out) == len(documents()) and all(0 <= r.severity <= 3 for r in out)
    if not any(x for _, x in labels):
        assert all(r.severity == 0 for r in out)
    empty = df.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, lab)).collect() == []


def test_repeated_ids_count_once_in_the_fit(spark):
    rows = [(i, f"plain words {i}" if i % 3 else f"nasty words {i}") for i in range(60)]
    lab = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    many = spark.createDataFrame(rows + [rows[3]] * 500 + [(4, None), (4, "z other text"), (99, "no label")] * 20, "doc_id long, text string").repartition(4)
    sample = [sorted(map(tuple, toxicity.labelled_sample(d, lab, "doc_id", "text", "toxic", 40).collect())) for d in (once, many)]
    assert sample[0] == sample[1] and len(sample[0]) == 40
    sample = toxicity.labelled_sample(many, lab, "doc_id", "text", "toxic", 100).collect()
    assert sorted(map(tuple, sample)) == sorted((int(i % 3 == 0), t) for i, t in rows)
    a, b = toxicity.fit(once, lab), toxicity.fit(many, lab)
    assert list(a.features) == list(b.features) and np.allclose(a.weights, b.weights, atol=1e-6)


def test_toxicity_query(spark):
    out = queries.op4_toxicity(spark, SF)
    assert out.columns == ["doc_id", "severity", "grade", "toxic"] and out.count() == load(spark, SF, "documents").count()
    assert out.where(F.col("toxic") != (F.col("severity") >= toxicity.REJECT)).count() == 0
