"""Exact top-k search by inner product: MaxScore over shards of postings.

A vector is a bag of weighted terms: component i is the weight of term i, and a
zero component has no posting.  Weights are integers of either sign.

1. Candidates are dealt by a hash of id and vector into shards of about
   ``SHARD_ROWS`` rows; a shard is one row of the written index: ids, and for
   every term its posting list with the largest and least weight.
2. Queries are dealt into blocks.  A task takes one block and ``SHARDS`` shards,
   and carries each query's k-th best score from shard to shard as threshold.
3. In a shard a query's terms are ordered by score bound, the largest
   contribution of a posting.  The first terms up to where the bounds of the
   rest add up to less than the threshold are essential: a row in none of their
   lists cannot compete.  Their lists are traversed; the other lists are probed
   only for rows whose score so far plus the bounds still open reaches the
   threshold.  Lists that hold over a quarter of the rows are kept as whole
   columns.
4. The shards' best k per query are merged by a window with a group limit.

Work is (query blocks) x (shards); candidates travel once per query block and
queries once per group of shards, and nothing is broadcast or collected.

Defined cases: vectors that are null, or hold a null or non-finite component, and
rows without an id take no part.  Missing components of a shorter vector count
as zero; an empty vector scores 0.  Rows that repeat id and vector count once;
rows that repeat an id with other vectors are candidates of their own, and none
is a candidate of a query with that id.  Equal scores go by the smaller id.
Scores that might not fit into 64 bits raise an error.  Empty tables give no
rows.  Further columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quarry.llm.common import integer_vector
from quarry.session import ensure_checkpoint_dir

SHARD_ROWS, SHARDS, BLOCK_ROWS = 4096, 4, 256

INDEX_DDL = "shard long, ids array<long>, terms array<int>, starts array<long>, rows array<int>, weights array<long>"
HIT_DDL = "query_id long, query_key long, id long, score long"
HITS = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(shard, ids, terms, starts, rows, weights): posting lists of each shard of
    ``vectors`` (id, vec); rows of a list are places in ``ids``, ascending."""
    n = vectors.count()

    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        vec = table["vec"].combine_chunks()
        flat, lens = vec.flatten().to_numpy(), np.diff(vec.offsets.to_numpy())
        row = np.repeat(np.arange(len(ids), dtype=np.int32), lens)
        term = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        row, term, flat = (x[flat != 0] for x in (row, term, flat))
        order = np.lexsort((row, term))
        terms, starts = np.unique(term[order], return_index=True)
        columns = [[int(table["shard"][0].as_py())], [ids], [terms.astype(np.int32)], [np.append(starts, len(order)).astype(np.int64)],
                   [row[order]], [flat[order]]]
        types = [pa.int64(), *(pa.list_(t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()))]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["shard", "ids", "terms", "starts", "rows", "weights"])

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("id", "vec"), F.lit(max(1, -(-n // shard_rows)))))
    return dealt.groupBy("shard").applyInArrow(run, INDEX_DDL)


class Shard:
    """Posting lists of one shard."""

    #: A list over this share of the rows is kept as a whole column.
    DENSE = 4

    def __init__(self, ids: np.ndarray, terms: np.ndarray, starts: np.ndarray, rows: np.ndarray, weights: np.ndarray):
        self.ids, self.lists = ids, {}
        for i, t in enumerate(terms.tolist()):
            r, w = rows[starts[i]:starts[i + 1]], weights[starts[i]:starts[i + 1]]
            everywhere = len(r) == len(ids)
            least, most = int(w.min()), int(w.max())
            column = None
            if self.DENSE * len(r) >= len(ids):
                column = np.zeros(len(ids), np.int64)
                column[r] = w
            self.lists[t] = (r, w, column, least if everywhere else min(least, 0), most if everywhere else max(most, 0))

    def best(self, query: dict[int, int], own: int, k: int, threshold: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of rows that reach the threshold, the k best at least
        among them; ``own`` is no candidate."""
        terms = [(max(q * lo, q * hi), q, r, w, c) for t, q in query.items() if t in self.lists
                 for r, w, c, lo, hi in [self.lists[t]]]
        terms.sort(key=lambda x: -x[0])
        # open[i]: what terms i and later can add at most
        open_ = np.append(np.cumsum([x[0] for x in terms][::-1])[::-1], 0).astype(np.int64) if terms else np.zeros(1, np.int64)
        m = len(terms) if threshold is None else next((i for i, x in enumerate(open_.tolist()) if x < threshold), len(terms))
        score = np.zeros(len(self.ids), np.int64)
        seen = None if threshold is None or open_[m] >= threshold else np.zeros(len(self.ids), bool)
        for _, q, r, w, c in terms[:m]:
            if c is not None:
                score += q * c
            else:
                score[r] += q * w
            if seen is not None:
                seen[r] = True
        at = np.arange(len(score)) if seen is None else np.flatnonzero(seen)
        score = score[at]
        for i, (_, q, r, w, c) in enumerate(terms[m:], m):
            near = score + open_[i] >= threshold
            at, score = at[near], score[near]
            if not len(at):
                break
            if c is not None:
                score = score + q * c[at]
            else:
                place = np.minimum(np.searchsorted(r, at), len(r) - 1)
                score = score + np.where(r[place] == at, q * w[place], 0)
        ids = self.ids[at]
        near = ids != own if threshold is None else (score >= threshold) & (ids != own)
        return score[near], ids[near]


def search_group(queries: list[tuple[int, int, list[int]]], shards: list[Shard], k: int) -> list[tuple[int, int, int, int]]:
    """(query id, query key, id, score) of the k best of each query over the shards."""
    out = []
    for own, key, vec in queries:
        query = {t: w for t, w in enumerate(vec) if w}
        scores, ids, threshold = np.empty(0, np.int64), np.empty(0, np.int64), None
        for shard in shards:
            s, i = shard.best(query, own, k, threshold)
            scores, ids = np.append(scores, s), np.append(ids, i)
            if len(scores) > k:
                # rows below the k-th score go first, so that only few are sorted
                cut = np.partition(scores, len(scores) - k)[len(scores) - k]
                scores, ids = scores[scores >= cut], ids[scores >= cut]
            order = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[order], ids[order]
            threshold = int(scores[-1]) if len(scores) == k else None
        out += [(own, key, i, s) for i, s in zip(ids.tolist(), scores.tolist())]
    return out


def search(candidates: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
           scale: float = 256.0, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, id, score) of each query's ``k`` best candidates; components
    x are taken as the integers floor(scale * x)."""
    spark = candidates.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/postings-{uuid.uuid4().hex}"
    vectors = _vectors(candidates, id_col, vec_col, scale)
    asked = _vectors(queries, id_col, vec_col, scale)
    build_index(vectors, shard_rows).write.parquet(path)
    index = spark.read.schema(INDEX_DDL).parquet(path)
    size = index.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("weights", F.abs)))).first()
    ask = asked.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("vec", F.abs))), F.max(F.size("vec"))).first()
    if (size[1] or 0) * (ask[1] or 0) * (ask[2] or 0) >= 1 << 62:
        raise ValueError("scores may not fit into 64 bits")
    groups, blocks = -(-size[0] // SHARDS) or 1, -(-ask[0] // block_rows) or 1

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return HITS.empty_table()
        shards = [Shard(*(right[c].chunk(j)[i].values.to_numpy() for c in ("ids", "terms", "starts", "rows", "weights")))
                  for j in range(right["ids"].num_chunks) for i in range(len(right["ids"].chunk(j)))]
        found = search_group(list(zip(*(left[c].to_pylist() for c in ("query_id", "query_key", "vec")))), shards, k)
        return pa.table([pa.array(c, pa.int64()) for c in zip(*found)] if found else [[]] * 4, schema=HITS)

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select(F.col("id").alias("query_id"), F.xxhash64("vec").alias("query_key"), "vec") \
        .withColumn("block", F.pmod(F.xxhash64("query_id", "query_key"), F.lit(blocks)).cast("int")).withColumn("part", every(groups))
    right = index.withColumn("part", F.pmod("shard", F.lit(groups)).cast("int")).withColumn("block", every(blocks))
    hits = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(run, HIT_DDL)
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id"), "score")


def _vectors(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    vec, ok = integer_vector(F.col(vec_col), scale)
    return df.where(ok & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).distinct()


def divisible(column: str, by: int) -> Column:
    """Rows of the stated query set."""
    return F.pmod(F.col(column), F.lit(by)) == 0
