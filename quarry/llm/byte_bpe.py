"""Byte-level BPE encoding and decoding.

Texts are cut into pieces at spaces that the tokenizer's pattern always cuts
at, each distinct piece of a task is split by the pattern once, and the
distinct pre-tokens are merged together: they are grouped by length into
padded numpy matrices in which every row merges its leftmost minimum-rank pair
each round.  Ranks come from a hashed pair table; finished rows leave the
matrix.  Decoding is one ragged gather from the table of token bytes.

Row-wise and without a shuffle, so a hot source or a group of copies costs
what its bytes cost.  Null texts are empty; an empty text has no tokens; any
other column, whatever its name, is not read.  Duplicate rows are encoded
each on their own.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import SPACE, Codes, PairHash, bounded_batches, ragged_build, ragged_take

NO_RANK = np.iinfo(np.int32).max
PAD = NO_RANK
#: Column counts of the padded matrices; longer pre-tokens are merged alone.
WIDTHS = (4, 6, 8, 12, 16, 24, 32, 64)
#: Distinct pieces and pre-tokens a task remembers before it starts afresh.
CACHE = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank from a rank file (base64 token, space, rank)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class ByteBPE:
    """Ranks as arrays: the pair table for merging, token bytes for decoding.

    Like the rank files' library, a pair may merge if its joined bytes are a
    token, whichever merge the token was learned from."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        left, right, to = [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    to.append(rank)
        self.pairs = PairHash(np.array(left, np.int64), np.array(right, np.int64), np.array(to, np.int32), NO_RANK)
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        by_id: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            by_id[rank] = token
        self.bytes_flat, self.bytes_off = ragged_build(by_id, np.uint8)

    # -- merging ---------------------------------------------------------
    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each pre-token as a ragged table (values, offsets)."""
        whole = [self.ranks.get(w, -1) for w in words]
        size = np.fromiter(map(len, words), np.int64, len(words))
        known = np.array(whole, dtype=np.int64) >= 0
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # row numbers, lengths, values
        rows = np.flatnonzero(known)
        parts.append((rows, np.ones(len(rows), np.int64), np.array(whole, np.int32)[rows]))
        low = 0
        for width in WIDTHS:
            rows = np.flatnonzero(~known & (size > low) & (size <= width))
            low = width
            for cut in range(0, len(rows), 65_536):
                some = rows[cut:cut + 65_536]
                parts.append((some, *self._merge_matrix([words[i] for i in some], size[some], width)))
        for i in np.flatnonzero(~known & (size > low)):
            ids = self._merge_long(words[i])
            parts.append((np.array([i]), np.array([len(ids)]), ids))
        lens = np.zeros(len(words), np.int64)
        for rows, n, _ in parts:
            lens[rows] = n
        offsets = np.concatenate([[0], np.cumsum(lens)])
        out = np.empty(offsets[-1], np.int32)
        for rows, n, values in parts:
            if len(values):
                ends = np.cumsum(n)
                out[np.repeat(offsets[rows] - (ends - n), n) + np.arange(len(values))] = values
        return out, offsets

    def _merge_matrix(self, words: list[bytes], size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(words)
        ids = np.full((n, width), PAD, np.int32)
        flat = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        ids[np.arange(width) < size[:, None]] = flat
        ranks = self.pairs.get(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        done = np.full((n, width), PAD, np.int32)
        live, cols = np.arange(n), np.arange(width)
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(at)), at]
            go = best != NO_RANK
            if not go.all():  # compaction: rows without a pair left are finished
                done[live[~go], :ids.shape[1]] = ids[~go]
                live, ids, ranks, at, best = live[go], ids[go], ranks[go], at[go], best[go]
                if not len(live):
                    break
            r = np.arange(len(live))
            width_now = ids.shape[1] - 1
            moved = cols[:width_now] + (cols[:width_now] > at[:, None])
            ids = np.take_along_axis(ids, moved, 1)
            ids[r, at] = best
            # pairs right of the merge move one to the left; its two neighbours are looked up
            ranks = np.take_along_axis(ranks, moved[:, :width_now - 1], 1) if width_now > 1 else ranks[:, :0]
            if width_now < 2:
                done[live, :width_now] = ids
                break
            has = at < width_now - 1
            ranks[r[has], at[has]] = self.pairs.get(best[has], ids[r[has], at[has] + 1])
            has = at > 0
            ranks[r[has], at[has] - 1] = self.pairs.get(ids[r[has], at[has] - 1], best[has])
        keep = done != PAD
        return keep.sum(axis=1), done[keep]

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One long pre-token: a round merges, from the left, all places of its
        minimum-rank pair, up to the first merge that creates a lower rank
        beside it (which must come before the places further right)."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)]
        while len(ids) > 1:
            ranks = self.pairs.get(ids[:-1], ids[1:])
            best = ranks.min()
            if best == NO_RANK:
                break
            at = np.flatnonzero(ranks == best)
            runs = np.flatnonzero(np.diff(at, prepend=-2) > 1)  # a a a: every second place of a run
            at = at[(np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))) % 2 == 0]
            prev = np.where(at > 0, ids[np.maximum(at - 1, 0)], PAD)
            prev[1:][at[1:] == at[:-1] + 2] = best  # the left neighbour has just been merged
            after = ids[np.minimum(at + 2, len(ids) - 1)]
            after = np.where(at + 2 < len(ids), after, PAD)
            new = np.full(len(at), best, np.int32)
            lower = np.flatnonzero(np.minimum(self.pairs.get(prev, new), self.pairs.get(new, after)) < best)
            if len(lower):
                at = at[:lower[0] + 1]
            ids = ids.copy()
            ids[at] = best
            ids = np.delete(ids, at + 1)
        return ids

    # -- texts -----------------------------------------------------------
    def encoder(self) -> "Encoder":
        return Encoder(self)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a token sequence, in blocks so that memory follows the
        result and not eight-byte index arrays of it."""
        out = []
        for i in range(0, len(ids), 1 << 18):
            out.append(ragged_take(self.bytes_flat, self.bytes_off, ids[i:i + (1 << 18)].astype(np.int64))[0].tobytes())
        return b"".join(out)


class Encoder:
    """Encodes batches of texts; remembers the pieces it has met."""

    def __init__(self, bpe: ByteBPE):
        self.bpe = bpe
        self.findall = regex.compile(bpe.pattern.replace(r"\s", f"[{SPACE}]").replace(r"[^[" + SPACE + "]", f"[^{SPACE}")
                                     .replace(r"(?!\S)", f"(?![^{SPACE}])")).findall
        # a lone space between other characters always starts a pre-token
        self.unsafe = regex.compile(f"[{SPACE}] | [{SPACE}]").search
        self.cut = regex.compile(f"(?<![{SPACE}]) (?![{SPACE}])").split
        self._reset()

    def _reset(self) -> None:
        self.pieces, self.words = Codes(), Codes()
        self.piece_ids, self.piece_off = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.word_ids, self.word_off = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _learn(self) -> None:
        """Encode the pieces met since the last call."""
        fresh, self.pieces.fresh = self.pieces.fresh, []
        get = self.words.__getitem__
        codes, counts = [], []
        for p in fresh:
            words = self.findall(p[0] if type(p) is tuple else " " + p)
            counts.append(len(words))
            codes.extend(map(get, words))
        new, self.words.fresh = self.words.fresh, []
        if new:
            ids, off = self.bpe.merge_words([w.encode() for w in new])
            self.word_off = np.concatenate([self.word_off, off[1:] + self.word_off[-1]])
            self.word_ids = np.concatenate([self.word_ids, ids])
        ids, lens = ragged_take(self.word_ids, self.word_off, np.array(codes, np.int64))
        ends = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        self.piece_off = np.concatenate([self.piece_off, ends[1:] + self.piece_off[-1]])
        self.piece_ids = np.concatenate([self.piece_ids, ids])

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.pieces) > CACHE or len(self.words) > CACHE:
            self._reset()
        get, coded = self.pieces.__getitem__, []
        for text in texts:
            text = text or ""
            parts = self.cut(text) if self.unsafe(text) else text.split(" ")
            parts[0] = (parts[0],)  # the first piece has no space before it
            coded.append(np.fromiter(map(get, parts), np.int64, len(parts)))
        if self.pieces.fresh:
            self._learn()
        return [ragged_take(self.piece_ids, self.piece_off, c)[0] for c in coded]


def _list_array(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text, as the rank files' library
    encodes ordinary text (no special tokens)."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(ByteBPE(read_ranks(ranks_path), pattern))  # one vocabulary file: bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = shared.value.encoder()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _list_array(enc.encode_batch(b.column(1).to_pylist()))],
                                             names=[id_col, "ids"])

    src = bounded_batches(df.select(id_col, F.col(text_col).cast("string").alias("_text")))
    kind = src.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The given columns with ``decoded`` (binary): the bytes of the ids.  Null ids are empty."""
    shared = df.sparkSession.sparkContext.broadcast(ByteBPE(read_ranks(ranks_path), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for b in batches:
            out = [bpe.decode(np.asarray(x.values)) if x.is_valid else b"" for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())],
                                             names=[id_col, "ids", "decoded"])

    src = bounded_batches(df.select(id_col, F.col(ids_col).alias("ids")))
    kind = src.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded binary")


def digests(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Length and digests of an encoded and decoded table."""
    return df.select(id_col, F.size("ids").cast("long").alias("n_tokens"),
                     F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                     F.sha2("decoded", 256).alias("decoded_sha256"))
