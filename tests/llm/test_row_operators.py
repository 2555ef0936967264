"""Tokenisers against their libraries, on awkward texts and on whole tables."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from cases import SCHEMA, documents
from quarry.llm import byte_bpe, queries, token_counts
from quarry.session import load

SF = "/root/testdata/sf0.001"
RANKS = P.path("byte_bpe_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=1500, seed=5):
    rnd = random.Random(seed)
    alpha = list("abcdeéüñ'  \n\t.,!%%123 ABCΣİßσ\x1c\x85 　日本語😀é<|>") + \
        ["'s", "'re", "<|endoftext|>", "<|startoftext|>", "the", "ing", " \n ", "   "]
    texts = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return texts + [None, "", " ", "  ", "\n", "a" * 5000, "ab" * 3000, "%" * 777, " " * 500,
                    "".join(rnd.choice("abcdefgh") for _ in range(20000)), "".join(rnd.choice("ab") for _ in range(5000))]


def test_encoder_equals_library(tik):
    bpe = byte_bpe.ByteBPE(byte_bpe.read_ranks(RANKS), P.PATTERN)
    enc, texts = bpe.encoder(), odd_texts()
    for i in range(0, len(texts), 100):
        part = texts[i:i + 100]
        for t, ids in zip(part, enc.encode_batch(part)):
            assert ids.tolist() == tik.encode_ordinary(t or "")
            assert bpe.decode(ids) == (t or "").encode()


def test_encoder_forgets_and_stays_right(tik, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 50)
    enc = byte_bpe.ByteBPE(byte_bpe.read_ranks(RANKS), P.PATTERN).encoder()
    for t in odd_texts(200, 9):
        assert enc.encode_batch([t])[0].tolist() == tik.encode_ordinary(t or "")


def test_counter_equals_library():
    lib = Tokenizer.from_file(WORDS)
    counter, texts = token_counts.Counter(token_counts.WordBPE(WORDS)), odd_texts()
    for i in range(0, len(texts), 100):
        part = texts[i:i + 100]
        want = [len(e.ids) for e in lib.encode_batch([t or "" for t in part], add_special_tokens=False)]
        assert counter.count_batch(part).tolist() == want


def test_counter_without_rank_order(monkeypatch):
    bpe = token_counts.WordBPE(WORDS)
    words = [w.encode() for w in "thinking about unbelievable wordinesses aaaaaaaa".split()]
    want = bpe.counts(words).tolist()
    bpe.in_order = False  # one merge a round must come to the same
    assert bpe.counts(words).tolist() == want


@pytest.mark.parametrize("empty", [False, True])
def test_on_awkward_table(spark, tik, empty):
    rows = [] if empty else documents()
    df = spark.createDataFrame(rows, SCHEMA)
    out = byte_bpe.decode(byte_bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN)
    got = sorted((r.doc_id, r.ids, bytes(r.decoded)) for r in out.collect())
    assert got == sorted((r[0], tik.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows)
    lib = Tokenizer.from_file(WORDS)
    got = sorted(tuple(r) for r in token_counts.token_counts(df, WORDS, limit=300).collect())
    want = [(r[0], len((r[1] or "").encode()), len(lib.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
    assert got == sorted((*w, w[2] > 300) for w in want)


def test_queries_on_table(spark, tik):
    docs = {r.doc_id: r.text or "" for r in load(spark, SF, "documents").collect()}
    lib = Tokenizer.from_file(WORDS)
    for r in queries.op3_byte_bpe(spark, SF).collect():
        ids = tik.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    got = {r.doc_id: r for r in queries.op5_token_counts(spark, SF).collect()}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        n = len(lib.encode(t, add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), n, n > 2048)
