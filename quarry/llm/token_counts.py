"""Token counts under a BPE tokenizer with word ends.

The distinct white-space pieces of a task are split into pre-tokens and merged
together: all pre-tokens lie in one ragged numpy array of symbols, and each
round applies every sequence's lowest-rank pair at all its places at once;
a sequence without a pair is finished and its surviving symbols are counted.

Row-wise and without a shuffle.  Null texts are empty and have no bytes and no
tokens; only the id and text columns are read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import SPACE, Codes, PairHash, bounded_batches

NO_RANK = np.iinfo(np.int32).max
CACHE = 600_000


def _byte_chars() -> list[str]:
    """Byte -> printable character of byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBPE:
    """A tokenizer file of kind BPE with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain BPE models are supported")
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        chars = _byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.last = np.array([vocab[c + end] for c in chars], np.int32)
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.to = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.pairs = PairHash(left, right, np.arange(len(merges), dtype=np.int32), NO_RANK)
        # A symbol is made before it is used: then no merge creates a pair of lower rank, and all places of a
        # sequence's lowest pair can be merged in one round.  Otherwise only the leftmost one is.
        born = np.full(max(vocab.values()) + 1, -1, np.int64)
        born[self.to[::-1]] = np.arange(len(merges))[::-1]
        rank = np.arange(len(merges))
        self.in_order = bool((np.maximum(born[left], born[right]) < rank).all()) and len(set(self.to.tolist())) == len(merges)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token once no pair merges."""
        out = np.zeros(len(words), np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[raw]
        ends = np.cumsum(size)
        sym[ends - 1] = self.last[raw[ends - 1]]
        seq = np.repeat(np.arange(len(words)), size)
        while len(sym):
            rank = np.full(len(sym), NO_RANK, np.int32)
            same = np.flatnonzero(seq[:-1] == seq[1:])
            rank[same] = self.pairs.get(sym[same], sym[same + 1])
            starts = np.flatnonzero(np.diff(seq, prepend=-1))
            low = np.minimum.reduceat(rank, starts)
            lens = np.diff(np.append(starts, len(sym)))
            stop = low == NO_RANK
            out[seq[starts[stop]]] = lens[stop]
            keep = np.repeat(~stop, lens)
            sym, seq, rank, low = sym[keep], seq[keep], rank[keep], np.repeat(low[~stop], lens[~stop])
            if not len(sym):
                break
            at = np.flatnonzero(rank == low)
            if self.in_order:
                runs = np.flatnonzero(np.diff(at, prepend=-2) > 1)
                at = at[(np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))) % 2 == 0]
            else:
                at = at[np.diff(seq[at], prepend=-1) != 0]
            sym[at] = self.to[rank[at]]
            left = np.ones(len(sym), bool)
            left[at + 1] = False
            sym, seq = sym[left], seq[left]
        return out


class Counter:
    """Counts batches of texts; remembers the pieces it has met."""

    def __init__(self, bpe: WordBPE):
        self.bpe = bpe
        self.findall = regex.compile(bpe.pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]")).findall
        self.special = regex.compile("|".join(map(regex.escape, bpe.special))) if bpe.special else None
        self.odd = regex.compile("[\x1c-\x1f]").search
        self.split = regex.compile(f"[{SPACE}]+").split
        self._reset()

    def _reset(self) -> None:
        self.pieces, self.words = Codes(), Codes()
        self.piece_n, self.word_n = np.empty(0, np.int64), np.empty(0, np.int64)

    @staticmethod
    def _lower(s: str) -> str:
        """Character by character: no rule for a sigma at the end of a word."""
        s = unicodedata.normalize("NFC", s)
        return s.lower() if "Σ" not in s else "".join(c.lower() for c in s)

    def _learn(self) -> None:
        fresh, self.pieces.fresh = self.pieces.fresh, []
        get, codes, counts = self.words.__getitem__, [], []
        for p in fresh:
            words = self.findall(self._lower(p))
            counts.append(len(words))
            codes.extend(map(get, words))
        new, self.words.fresh = self.words.fresh, []
        if new:
            self.word_n = np.concatenate([self.word_n, self.bpe.counts([w.encode() for w in new])])
        upto = np.concatenate([[0], np.cumsum(self.word_n[np.array(codes, np.int64)])])
        ends = upto[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        self.piece_n = np.concatenate([self.piece_n, np.diff(ends)])

    def count_batch(self, texts: list[str | None]) -> np.ndarray:
        if len(self.pieces) > CACHE or len(self.words) > CACHE:
            self._reset()
        get, coded, extra = self.pieces.__getitem__, [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            text = text or ""
            segments = [text]
            if self.special and any(s in text for s in self.bpe.special):
                segments = self.special.split(text)
                extra[i] = len(segments) - 1
            codes = []
            for s in segments:
                codes.extend(map(get, self.split(s) if self.odd(s) else s.split()))
            coded.append(np.array(codes, np.int64))
        if self.pieces.fresh:
            self._learn()
        return extra + np.array([int(self.piece_n[c].sum()) for c in coded], np.int64)


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text, as the
    tokenizer file's library counts without added special tokens; special
    strings inside a text are one token each, as by its default."""
    shared = df.sparkSession.sparkContext.broadcast(WordBPE(path))  # one vocabulary file: bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counter.count_batch(b.column(2).to_pylist()))],
                                             names=[id_col, "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = bounded_batches(df.select(id_col, F.octet_length(text).cast("long").alias("_bytes"), text.alias("_text")))
    kind = src.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long") \
        .withColumn("over_limit", F.col("n_tokens") > limit)
