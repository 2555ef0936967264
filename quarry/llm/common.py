"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: Rows per Arrow batch handed to a Python worker: texts can be long, so the
#: default of 10,000 rows would let one batch grow to gigabytes.
BATCH_ROWS = 512
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: White space as the tokenizers' patterns understand it (Unicode White_Space):
#: unlike Python's, without the separators U+001C to U+001F.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def bounded_batches(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """Lower the session's Arrow batch size to at most ``rows`` and return ``df``."""
    conf = df.sparkSession.conf
    now = int(conf.get(ARROW_ROWS, "10000"))
    if now <= 0 or now > rows:
        conf.set(ARROW_ROWS, str(rows))
    return df


def ddl(df: DataFrame, first: Sequence[str], new: str, last: Sequence[str] = ()) -> str:
    """Schema text: columns of ``df``, new ones, and more columns of ``df``."""
    of = lambda names: [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names]
    return ", ".join([*of(first), new, *of(last)])


class Codes(dict):
    """Gives each new key the next number; ``fresh`` lists keys in that order."""

    def __init__(self):
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key):
        code = self[key] = len(self)
        self.fresh.append(key)
        return code


def ragged_take(values: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the rows ``codes`` of a ragged table (``values`` cut at
    ``offsets``); returns the joined values and each row's length."""
    start = offsets[codes]
    lens = offsets[codes + 1] - start
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(start - (ends - lens), lens)
    at += np.arange(total, dtype=at.dtype)
    return values[at], lens


def ragged_build(rows: list, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list of bytes-like or integer rows."""
    offsets = np.zeros(len(rows) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)), out=offsets[1:])
    if dtype == np.uint8:
        return np.frombuffer(b"".join(rows), dtype=np.uint8), offsets
    flat = [x for r in rows for x in r]
    return np.array(flat, dtype=dtype), offsets


class PairHash:
    """Open-addressing hash table from symbol pairs to an int32, looked up for
    whole arrays at once (linear probing; every probe round is vectorised)."""

    FREE = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray, none: int):
        n = max(16, len(left))
        bits = int(np.ceil(np.log2(n))) + 1
        self.shift, self.mask, self.none = np.uint64(64 - bits), np.uint64((1 << bits) - 1), np.int32(none)
        self.keys = np.full(1 << bits, self.FREE, dtype=np.uint64)
        self.vals = np.full(1 << bits, none, dtype=np.int32)
        key = self._key(left, right)
        slot, rest = self._slot(key), np.arange(len(key))
        while len(rest):
            # of the keys that want the same free slot the first gets it
            _, first = np.unique(slot[rest], return_index=True)
            win = rest[first][self.keys[slot[rest[first]]] == self.FREE]
            self.keys[slot[win]] = key[win]
            self.vals[slot[win]] = value[win]
            rest = np.setdiff1d(rest, win, assume_unique=True)
            slot[rest] = (slot[rest] + np.uint64(1)) & self.mask

    @staticmethod
    def _key(left, right) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Value of each pair, ``none`` where the table lacks it."""
        key = self._key(left, right)
        slot = self._slot(key)
        seen = self.keys[slot]
        out = np.where(seen == key, self.vals[slot], self.none)
        rest = np.flatnonzero((seen != key) & (seen != self.FREE))
        while len(rest):
            slot[rest] = (slot[rest] + np.uint64(1)) & self.mask
            seen = self.keys[slot[rest]]
            hit = seen == key[rest]
            out[rest[hit]] = self.vals[slot[rest[hit]]]
            rest = rest[~hit & (seen != self.FREE)]
        return out


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character left as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(text: Column, separators: str) -> Column:
    """Words between runs of the separator class; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{separators}]+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(word_hashes: Column, k: int) -> Column:
    """64-bit hashes of the k-word shingles, in order, repeats included."""
    n = F.size(word_hashes) - (k - 1)
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(word_hashes, i, k)))) \
        .otherwise(F.array().cast("array<bigint>"))


def integer_vector(vec: Column, scale: float) -> tuple[Column, Column]:
    """(components x as whole numbers floor(scale * x), whether the vector is
    there and all its components are finite numbers)."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))), vec.isNotNull() & F.forall(vec, finite)
