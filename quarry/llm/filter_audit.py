"""Interaction audit of five document filters on a sparse document-term matrix.

1. Documents are cut into words in tasks, and every task packs its documents
   into CSR shards of about ``SHARD_BYTES`` of text: row starts, word numbers
   within the shard (written as gaps) and counts, beside the shard's own word list.
2. The word lists are dealt by word and sorted, which gives every distinct word
   of the corpus one global number (its place in its partition, and that
   partition); the numbers go back to the shards, so the global dictionary is
   never whole in one place.
3. Each shard is rewritten in global numbers.  Row sums (words) and counts of
   nonzero columns (distinct words) decide filters A and B; C, D and the digest
   of the text travel with the rows.
4. E compares with the smallest id of each text digest.  Rows are counted by
   (digest, part, failures, labels) in the tasks before anything is dealt by
   digest, so a text of which a third of all rows are copies is a few rows.
5. What is left is a count per part and pattern of failures, on which all
   orders of the filters are played through.

Defined cases: a null text is empty, a null part is the empty string.  A null id
is no smaller id and never fails E; equal ids do not fail each other.  Rows that
repeat are documents of their own.  Labels of one id are joined by their
maximum; labels without an id belong to no document.  An empty table has no parts and gives no rows.  A text of any length
is taken whole; one longer than ``SHARD_BYTES`` closes its shard.  Only the
named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from quarry.llm.common import ARROW_ROWS, bounded_batches
from quarry.session import ensure_checkpoint_dir

FILTERS = "ABCDE"
#: A: fewer words than this.  B: fewer distinct words than this share (in 100).
#: C: more capitals than this share of the characters (in 100).  D: any of these bytes.
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT, SYMBOLS = 100, 80, 10, b"#$%&*|"
#: Bytes of text in a shard, about.
SHARD_BYTES = 1 << 24
#: Bytes of text in a shard that are cut into words and counted at once.
SLICE_BYTES = 1 << 21
#: Sizes are looked at after every row written, as a row is a shard: by default 100 of them wait in memory for the
#: first look, and come back as one batch.  A row group ends with the shard that fills it.
ROW_GROUPS = {"parquet.block.size": str(SHARD_BYTES), **{f"parquet.{of}.size.row.check.{end}": "1" for of in ("block", "page") for end in ("min", "max")}}

SHARD = pa.schema([("shard", pa.int64()), ("ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.string())),
                   ("digests", pa.list_(pa.binary())), ("flags", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())),
                   ("gaps", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("vocabulary", pa.list_(pa.string()))])
SHARD_DDL = ("shard long, ids array<long>, parts array<string>, digests array<binary>, flags array<int>, starts array<long>, "
             "gaps array<int>, counts array<int>, vocabulary array<string>")
ROW_DDL = "id long, part string, digest binary, flags int, n_words long, n_distinct long"


def _bit(name: str) -> int:
    return 1 << FILTERS.index(name)


#: What a byte counts as: 1 a capital, 2 a later byte of a character, 4 a symbol of D.
KINDS = np.zeros(256, np.uint8)
KINDS[65:91], KINDS[0x80:0xC0], KINDS[list(SYMBOLS)] = 1, 2, 4


def byte_counts(texts: pa.Array) -> np.ndarray:
    """(bytes, capitals, later bytes, symbols) of each text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    kinds = KINDS[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]]
    ends = offsets - offsets[0]
    count = lambda kind: np.bincount(np.searchsorted(ends, np.flatnonzero(kinds == kind), "right") - 1, minlength=len(texts))
    return np.stack([np.diff(ends), count(1), count(2), count(4)])


def slices(texts: pa.Array) -> list[pa.Array]:
    """The texts in order, about ``SLICE_BYTES`` at a time, or one that is longer."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
    cuts = [0]
    while cuts[-1] < len(texts):
        full = np.searchsorted(ends, (ends[cuts[-1] - 1] if cuts[-1] else 0) + SLICE_BYTES, "right")
        cuts.append(max(int(full), cuts[-1] + 1))
    return [texts.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]


def gaps_of(terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each row's ascending terms as its first and the differences, which are small."""
    gaps = np.diff(terms, prepend=0)
    full = starts[:-1][np.diff(starts) > 0]
    gaps[full] = terms[full]
    return gaps.astype(np.int32)


def terms_of(gaps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The terms again."""
    upto = np.append(0, np.cumsum(gaps, dtype=np.int64))
    return upto[1:] - np.repeat(upto[starts[:-1]], np.diff(starts))


def csr_shard(number: int, ids: pa.Array, parts: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """One shard, as one row: words are cut at 09-0D and 20 and numbered in the
    shard; each document's row of the matrix is its distinct numbers and counts.
    Only the words and their numbers are there for the whole shard at once."""
    words, rows, flags = [], [], [np.empty(0, np.int32)]
    for some in slices(texts):
        cut = pc.ascii_split_whitespace(some)
        flat = cut.flatten()
        there = pc.greater(pc.binary_length(flat), 0)
        words.append(flat.filter(there))
        rows.append(np.repeat(np.arange(len(some)), pc.list_value_length(cut).to_numpy())[there.to_numpy(zero_copy_only=False)].astype(np.int32))
        size, capitals, later, symbols = byte_counts(some)
        flags.append((_bit("C") * (100 * capitals > CAPITALS_PERCENT * (size - later)) + _bit("D") * (symbols > 0)).astype(np.int32))
    coded = pa.chunked_array(words, pa.string()).dictionary_encode().chunks  # one numbering for all slices, those without words gone
    numbers = np.concatenate([np.empty(0, np.int32), *(c.indices.to_numpy() for c in coded)])
    vocabulary = coded[0].dictionary if coded else pa.array([], pa.string())
    starts, gaps, counts = [np.zeros(1, np.int64)], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
    for row, end, part in zip(rows, np.cumsum([len(r) for r in rows]), flags[1:]):
        cells = np.sort(row.astype(np.int64) << 32 | numbers[end - len(row):end])
        first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])) if len(cells) else np.empty(0, np.int64)
        at = np.searchsorted(cells[first], np.arange(len(part) + 1) << 32)
        counts.append(np.diff(np.append(first, len(cells))).astype(np.int32))
        gaps.append(gaps_of(cells[first] & 0xFFFFFFFF, at))
        starts.append(starts[-1][-1] + at[1:])
    digests = pa.array([hashlib.sha256(t.as_buffer() or b"").digest() for t in texts], pa.binary())
    columns = [ids, parts, digests, *map(np.concatenate, (flags, starts, gaps, counts)), vocabulary]
    one = [pa.ListArray.from_arrays(np.array([0, len(c)], np.int32), pa.array(c) if isinstance(c, np.ndarray) else c) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *one], schema=SHARD)


def _columns(batches: list[pa.RecordBatch]) -> Iterator[pa.Array]:
    """The columns of some rows, each in one piece."""
    for column, kind in zip(pa.Table.from_batches(batches).columns, (pa.int64(), pa.string(), pa.string())):
        yield pa.concat_arrays([c.cast(kind) for c in column.chunks])


def csr_shards(df: DataFrame, id_col: str, part_col: str, text_col: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """CSR shards of the documents, terms numbered within each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, held = TaskContext.get().partitionId() << 24, 0, []
        for b in batches:
            ends = np.cumsum(pc.binary_length(b.column(2)).to_numpy())
            at, before = 0, 0
            while at < b.num_rows:
                # up to the row that fills the shard
                to = min(int(np.searchsorted(ends, before + shard_bytes - size)) + 1, b.num_rows)
                held.append(b.slice(at, to - at))
                size, before, at = size + int(ends[to - 1]) - before, int(ends[to - 1]), to
                if size >= shard_bytes:
                    yield csr_shard(number, *_columns(held))
                    number, size, held = number + 1, 0, []
        if held:
            yield csr_shard(number, *_columns(held))

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    src = df.select(F.col(id_col).cast("long").alias("id"), text(part_col).alias("part"), text(text_col).alias("text"))
    return src.mapInArrow(run, SHARD_DDL)


def global_numbers(shards: DataFrame) -> DataFrame:
    """(shard, at, term): the global number of each shard's word.  Equal words
    meet in one partition, sorted, where a word is at most one row a shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last = (TaskContext.get().partitionId() << 40) - 1, None
        for b in batches:
            if not b.num_rows:
                continue
            words = b.column(2).to_numpy(zero_copy_only=False)
            new = np.append(words[:1] != last, words[1:] != words[:-1]) if last is not None else np.append(True, words[1:] != words[:-1])
            at = number + np.cumsum(new)
            number, last = int(at[-1]), words[-1]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.int64())], names=["shard", "at", "term"])

    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = shards.select("shard", F.posexplode("vocabulary").alias("at", "word"))
    return words.repartition(n, "word").sortWithinPartitions("word").mapInArrow(run, "shard long, at int, term long")


ROWS = pa.schema([("id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("flags", pa.int32()), ("n_words", pa.int64()),
                  ("n_distinct", pa.int64())])


def global_terms(terms: np.ndarray, at: np.ndarray, number: np.ndarray) -> np.ndarray:
    """A shard's columns in global numbers, given the numbers of its words."""
    of = np.full(len(at), -1, np.int64)
    of[at] = number
    if len(np.unique(of)) != len(of) or (of < 0).any():
        raise ValueError("a word of the shard has no number of its own")
    return of[terms]


def matrix_rows(shards: DataFrame, numbers: DataFrame, cells: bool = False) -> DataFrame:
    """One row per document with the columns that travel along: the sum and the
    nonzero count of its row of the matrix, and with ``cells`` the row itself
    (terms: global numbers, counts)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for shard in left.drop_columns(["shard"]).to_batches():
            for i in range(shard.num_rows):
                ids, parts, digests, flags, starts, gaps, counts = (c[i].values for c in shard.columns)
                starts, counts = starts.to_numpy(), counts.to_numpy()
                terms = global_terms(terms_of(gaps.to_numpy(), starts), right["at"].to_numpy(), right["term"].to_numpy())
                upto = np.append(0, np.cumsum(counts, dtype=np.int64))
                columns = [ids, parts, digests, flags, pa.array(upto[starts[1:]] - upto[starts[:-1]]), pa.array(np.diff(starts))]
                names = list(ROWS.names)
                if cells:
                    columns += [pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(x)) for x in (terms, counts)]
                    names += ["terms", "counts"]
                out.append(pa.table(columns, names=names))
        return pa.concat_tables(out) if out else schema.empty_table()

    schema = pa.schema([*ROWS, *([("terms", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))] if cells else [])])
    ddl = ROW_DDL + (", terms array<long>, counts array<int>" if cells else "")
    # asked for by number, as partitions merged up to a size hold many shards, whose rows are large once read
    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = (x.repartition(n, "shard").groupBy("shard") for x in (shards.drop("vocabulary"), numbers))
    return next(sides).cogroup(next(sides)).applyInArrow(run, ddl)


def document_rows(df: DataFrame, id_col: str = "doc_id", part_col: str = "lang", text_col: str = "text",
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, part, digest, fails, n_words, n_distinct) of every row; ``fails`` has
    the bits of A to D.  The shards are written into the shared folder, since
    both the dictionary and the rows are made from them."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/matrix-{uuid.uuid4().hex}"
    rows = spark.conf.get(ARROW_ROWS)
    bounded_batches(df)  # of whole texts; the words that follow are short
    try:
        csr_shards(df, id_col, part_col, text_col, shard_bytes).write.options(**ROW_GROUPS).parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, rows)
    shards = spark.read.schema(SHARD_DDL).parquet(path)
    rows = matrix_rows(shards, global_numbers(shards))
    few, same = F.col("n_words") < MIN_WORDS, 100 * F.col("n_distinct") < DISTINCT_PERCENT * F.col("n_words")
    fails = F.col("flags").bitwiseOR(F.when(few, _bit("A")).otherwise(0)).bitwiseOR(F.when(same, _bit("B")).otherwise(0))
    return rows.select("id", "part", "digest", fails.alias("fails"), "n_words", "n_distinct")


def failure_counts(rows: DataFrame, labels: DataFrame, label_id: str = "doc_id") -> DataFrame:
    """(part, fails, good, toxic, n): documents by pattern of failures, E included."""
    marks = labels.groupBy(F.col(label_id).cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # one row per (id, digest, part): repeated rows are counted before any join
    docs = rows.groupBy("id", "digest", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    docs = docs.join(marks, "id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    keys = ["digest", "part", "fails", "good", "toxic"]
    groups = docs.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    # of a digest there are at most (parts x 4) groups left
    least = groups.groupBy("digest").agg(F.min("first.id").alias("least"))
    groups = groups.join(least, "digest")
    passes = F.col("nameless") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    both = F.array(F.struct(F.col("fails").alias("fails"), passes.alias("n")),
                   F.struct(F.col("fails").bitwiseOR(F.lit(_bit("E"))).alias("fails"), (F.col("n") - passes).alias("n")))
    return groups.select("part", "good", "toxic", F.explode(both).alias("x")) \
        .groupBy("part", "x.fails", "good", "toxic").agg(F.sum("x.n").alias("n"))


def steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of the earlier filters) of all orders."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        for i, name in enumerate(order):
            out.append((order, i + 1, _bit(name), sum(map(_bit, order[:i]))))
    return out


def audit(cells: DataFrame) -> DataFrame:
    """One row per part, order and step from counts by pattern of failures."""
    table = F.from_json(F.lit(json.dumps([dict(zip(("filter_order", "step", "bit", "earlier"), x)) for x in steps()])),
                        "array<struct<filter_order: string, step: int, bit: int, earlier: int>>")
    fails = F.col("fails").bitwiseAND(F.col("bit")) != 0
    gone = F.col("fails").bitwiseAND(F.col("earlier")) != 0
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    # cells are first added up by part, so that the expansion is over patterns, not documents
    played = cells.select("part", "fails", "good", "toxic", "n", F.inline(table)) \
        .groupBy("part", "filter_order", "step", "bit").agg(
            total(~gone & ~fails).alias("kept"), total(~gone & fails).alias("removed"), total(gone & fails).alias("redundant"),
            total(F.col("fails") == F.col("bit")).alias("unique_fails"),
            total(~gone & fails & (F.col("good") == 1)).alias("good_lost"),
            total(~gone & fails & (F.col("toxic") == 1)).alias("toxic_lost"))
    return played.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")


def filter_audit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", part_col: str = "lang", text_col: str = "text",
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley for every part, order and step."""
    rows = document_rows(documents, id_col, part_col, text_col, shard_bytes)
    return audit(failure_counts(rows, labels))
