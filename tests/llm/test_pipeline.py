"""The pipeline, stage by stage and whole, against brute force."""

import hashlib
import random
import re

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as pipeline
from cases import SCHEMA, documents
from quarry.llm import byte_bpe, toxicity
from quarry.session import load
from test_corpus_operators import brute_repeats
from test_shingle_operators import brute_components, brute_contamination, brute_fingerprint, key

SF = "/root/testdata/sf0.001"


def brute_keep_one(rows):
    """Rows (id, text, ...): the least (id, text hash) row of each component; ids must be given."""
    comp = brute_components([(r[0], brute_fingerprint(r[1])) for r in rows])
    return sorted({r[0]: r for r, c in zip(rows, comp) if c[2] == r[0]}.values())


def test_near_copies_stage(spark):
    rows = [r[:5] for r in documents()]
    docs = spark.createDataFrame([r + (1,) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, row int")
    out = pipeline.drop_near_copies(spark, docs, SF)
    assert out.columns == pipeline.COLUMNS
    assert key(map(tuple, out.collect())) == key(brute_keep_one(rows))


def test_near_copies_without_ids(spark):
    rows = [(None, "a b c d e f", None, None, None)] * 3 + [(None, "something else entirely here", None, None, None), (4, "a b c d e f", "", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert key(tuple(r)[:2] for r in pipeline.drop_near_copies(spark, docs, SF).collect()) == key([(None, rows[3][1]), (4, rows[4][1])])


def test_repeats_and_contamination_stages(spark):
    rows = load(spark, SF, "documents").collect()
    docs = load(spark, SF, "documents")
    cut = pipeline.cut_repeats(spark, docs, SF)
    assert cut.columns == pipeline.COLUMNS
    want = {r.doc_id: b[2].decode("utf-8", "ignore") for r, b in zip(rows, brute_repeats([r.text for r in rows], pipeline.REPEAT_BYTES))}
    got = {r.doc_id: r for r in cut.collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    clean = pipeline.drop_contaminated(spark, docs, SF)
    assert clean.columns == pipeline.COLUMNS
    items = [tuple(r) for r in load(spark, SF, "benchmark").collect()]
    bad = {i for i, n, hit, _ in brute_contamination([(r.doc_id, r.text) for r in rows], items) if hit and 20 * hit >= n}
    assert bad and sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in rows if r.doc_id not in bad)


def test_planted_passages_are_cut(spark):
    """Passages of 51 to 60 words and 200 to 399 bytes that repeat go; other documents stay as they are."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [p for p in (text(rnd.randint(51, 60)) for _ in range(60)) if 200 <= len(p) < 400]
    rows = [(f"{text(120)}\n", p, f"\n{text(rnd.randint(60, 200))}") for p in passages for _ in range(rnd.randint(2, 4))]
    clean = [text(rnd.randint(20, 400)) for _ in range(100)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(["".join(r) for r in rows] + clean)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r.text for r in pipeline.cut_repeats(spark, docs, SF).collect()}
    assert len(passages) > 40
    # a byte of the passage's border may be shared by chance, and then goes too
    cut = [left[i][:len(a) - 2] == a[:-2] and left[i].endswith(b[2:]) and len(left[i]) <= len(a) + len(b) for i, (a, _, b) in enumerate(rows)]
    assert sum(cut) >= 0.95 * len(rows)
    assert [left[len(rows) + i] for i in range(100)] == clean


def brute_run(spark):
    """All stages in plain Python on the small table (the model's scores are taken as given)."""
    docs = load(spark, SF, "documents")
    model = toxicity.fit(docs, load(spark, SF, "labels"))
    vec, rows = toxicity.Vectorizer(model.features), []
    for r in docs.collect():
        k, v, _ = vec(r.text)
        eta = sum(model.weights[i] * x for i, x in zip(k, v))
        severity = model.severity(__import__("numpy").array([eta]))[0]
        if severity < toxicity.REJECT:
            rows.append(tuple(r))
    rows = brute_keep_one(rows)
    texts = [b[2].decode("utf-8", "ignore") for b in brute_repeats([r[1] for r in rows], pipeline.REPEAT_BYTES)]
    rows = [(r[0], t) for r, t in zip(rows, texts)]
    items = [tuple(r) for r in load(spark, SF, "benchmark").collect()]
    bad = {i for i, n, hit, _ in brute_contamination(rows, items) if hit and 20 * hit >= n}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    out = []
    for i, t in rows:
        if i not in bad:
            ids = enc.encode_ordinary(t)
            out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return out


def test_run_equals_brute_force(spark):
    got = [tuple(r) for r in pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(brute_run(spark)) and len(got) > 100


@pytest.mark.parametrize("rows", [[], [(None,) * 5, (1, None, None, None, None), (2, "", "", "", 0), (2, "", "", "", 0)]], ids=["empty", "nulls"])
def test_stages_on_awkward_tables(spark, rows):
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, severity int")
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == pipeline.COLUMNS
        docs = spark.createDataFrame([(*tuple(r), 7) for r in docs.collect()], "doc_id long, text string, lang string, source string, n_chars long, severity int")
    out = pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == (1 if rows else 0)  # all of them are one group of empty texts


def test_stage_names_call_operators():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "suffix_array_dedup", "decontamination", "byte_bpe"]
    assert re.fullmatch(r"\w+", pipeline.STAGES[0][0]) and pipeline.ORACLE_SQL is None
