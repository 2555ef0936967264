"""Centroid clustering (Lloyd's rounds in whole numbers) over a VA-file.

1. The kept vectors are written once, each with a row key.
2. One pass over them gives every dimension's range, and the first round's
   cluster sums.  Each dimension is then cut into ``CELLS`` equal cells, and a
   vector's approximation, one cell number per dimension, is written beside it.
3. A round reads the approximations only.  For every dimension, cell and
   centroid a lookup table has the least and largest (squared distance to the
   centroid, less that to a common reference point, which no comparison of
   centroids sees); the sums over the dimensions are an interval per centroid.
   Where one interval lies below all others the vector's centroid is sure.
4. Cluster sums are carried on from round to round, so a round only needs the
   vectors that changed their centroid.  Full vectors are fetched by row key
   where intervals overlap, under the old centroids or the new ones, or where
   the sure centroids differ.  A round depends on the two sets of centroids
   alone: there is no state to lose, and no lineage that grows.
5. A last pass over the full vectors gives the exact distances.

What reaches the driver is k centroids, their sums and the ranges.  Fetching is
a join on the row key, with the vectors dealt by key and sorted once for all
rounds, so each round moves keys only.

Defined cases: vectors that are null, of another length, or hold a null or
non-finite component take no part.  A null id is text '' in the seed hash; its
vector takes part.  Rows that repeat are vectors of their own; seeds with equal
hash go by their components.  With fewer vectors than k there are as many
centroids.  An empty table gives no rows.  Components of 2**27 and more after
scaling raise an error, since distances would not fit into 64 bits.  Further
columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import integer_vector
from quarry.session import ensure_checkpoint_dir

#: Cells per dimension (6 bits; a cell number is stored in one byte).
CELLS = 64
#: Vectors handled at once in a task.
STEP = 2048
LIMIT = 1 << 27

SLOTS = pa.schema([("slot", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("total", pa.int64())])
SLOT_DDL = "slot int, low long, high long, total long"


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each row's nearest centroid; ties: the smaller number."""
    best, dist = np.zeros(len(x), np.int64), None
    for j, c in enumerate(centroids):
        d = np.square(x - c).sum(1)
        if dist is None:
            dist = d
        else:
            less = d < dist
            best[less], dist = j, np.minimum(d, dist)
    return best, dist


class Grid:
    """Equal cells over each dimension's range."""

    def __init__(self, low: np.ndarray, high: np.ndarray, cells: int = CELLS):
        self.low, self.span, self.cells = low, high - low + 1, cells
        # first[d, c]: least value in cell c (whole numbers, so cells are closed intervals)
        edge = low[:, None] - (-np.arange(cells + 1)[None, :] * self.span[:, None] // cells)
        self.first, self.last = edge[:, :-1], edge[:, 1:] - 1

    def codes(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.low) * self.cells // self.span).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) of (dimension, cell, centroid): bounds of (x-c)^2 - (x-r)^2, which is linear in x."""
        r = np.sort(centroids, axis=0)[len(centroids) // 2]
        at = lambda x: (centroids ** 2 - r ** 2).T[:, None, :] - 2 * x[:, :, None] * (centroids - r).T[:, None, :]
        a, b = at(self.first), at(self.last)
        return np.minimum(a, b), np.maximum(a, b)


def sure(codes: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The centroid of each row if its interval lies below all others, else -1."""
    low = np.zeros((len(codes), tables[0].shape[2]), np.int64)
    high = np.zeros_like(low)
    for d in range(codes.shape[1]):
        low += tables[0][d, codes[:, d]]
        high += tables[1][d, codes[:, d]]
    best = high.argmin(1)
    top = high[np.arange(len(best)), best]
    number = np.arange(low.shape[1])
    # an equal distance goes to the smaller number, so a larger one may touch
    below = (top[:, None] < low) | (top[:, None] == low) & (number > best[:, None]) | (number == best[:, None])
    return np.where(below.all(1), best, -1)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dims)


def _slots(frame: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list:
    """Each task's (low, high, total) arrays, combined by slot in Spark; a row a slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, total = make(batches)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), *(pa.array(x, pa.int64()) for x in (low, high, total))],
                                         schema=SLOTS)

    return frame.mapInArrow(run, SLOT_DDL).groupBy("slot").agg(F.min("low"), F.max("high"), F.sum("total")).orderBy("slot").collect()


def _first_pass(vectors: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(least, largest) of each dimension, and sums and sizes of the clusters."""
    k, dims = centroids.shape

    def make(batches):
        low, high = np.full(dims, LIMIT), np.full(dims, -LIMIT)
        total = np.zeros(k * dims + k, np.int64)
        for b in batches:
            x = _matrix(b.column(0), dims)
            if len(x):
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
            for i in range(0, len(x), STEP):
                _add(total, x[i:i + STEP], nearest(x[i:i + STEP], centroids)[0], 1, k, dims)
        fill = lambda v, none: np.append(v, np.full(len(total) - dims, none))
        return fill(low, LIMIT), fill(high, -LIMIT), total

    rows = _slots(vectors.select("vec"), make)
    low, high, total = (np.array([r[i] for r in rows], dtype=object) for i in (1, 2, 3))
    return low[:dims].astype(np.int64), high[:dims].astype(np.int64), total[:k * dims].reshape(k, dims), total[k * dims:]


def _add(total: np.ndarray, x: np.ndarray, cluster: np.ndarray, sign: int, k: int, dims: int) -> None:
    sums = np.zeros((k, dims), np.int64)
    np.add.at(sums, cluster, x)
    total[:k * dims] += sign * sums.ravel()
    total[k * dims:] += sign * np.bincount(cluster, minlength=k)


def _unsure(approximations: DataFrame, grid: Grid, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """Keys of vectors that changed their centroid, or may have."""
    dims, old, new = before.shape[1], grid.tables(before), grid.tables(after)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, dims)
            fetch = np.ones(len(codes), bool)
            for i in range(0, len(codes), STEP):
                one, two = sure(codes[i:i + STEP], old), sure(codes[i:i + STEP], new)
                fetch[i:i + STEP] = (one < 0) | (two < 0) | (one != two)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(fetch))], names=["key"])

    return approximations.mapInArrow(run, "key long")


def _changes(full: DataFrame, keys: DataFrame, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the sums and sizes change by from one round to the next, from fetched vectors."""
    k, dims = before.shape

    def make(batches):
        total = np.zeros(k * dims + k, np.int64)
        for b in batches:
            for i in range(0, b.num_rows, STEP):
                x = _matrix(b.column(0).slice(i, STEP), dims)
                old, new = nearest(x, before)[0], nearest(x, after)[0]
                moved = old != new
                _add(total, x[moved], new[moved], 1, k, dims)
                _add(total, x[moved], old[moved], -1, k, dims)
        return np.zeros_like(total), np.zeros_like(total), total

    rows = _slots(full.join(keys, "key").select("vec"), make)
    total = np.array([r[3] for r in rows] or [0] * (k * dims + k), dtype=object)
    return total[:k * dims].reshape(k, dims), total[k * dims:]


def _means(centroids: np.ndarray, sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Exact floors of the means; an empty cluster's centroid stays."""
    return np.array([[int(s) // int(n) for s in row] if n else c.tolist() for c, row, n in zip(centroids, sums, sizes)], np.int64)


def centroid_clusters(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, k: int = 8, rounds: int = 10,
                      scale: float = 1024.0, seed: str = "3:", cells: int = CELLS) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of every kept
    vector: components x are taken as floor(scale * x), the first centroids are
    the ``k`` vectors with the least SHA-256 of seed and id, and ``rounds``
    rounds of assignment and floored means are followed by a last assignment."""
    spark = df.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/va-{uuid.uuid4().hex}"
    vec, ok = integer_vector(F.col(vec_col), scale)
    df.where(ok & (F.size(vec_col) == dims)).select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"), vec.alias("vec")) \
        .write.parquet(f"{base}/vectors")
    vectors = spark.read.parquet(f"{base}/vectors")
    most = vectors.agg(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0]
    if (most or 0) >= LIMIT:
        raise ValueError("squared distances may not fit into 64 bits")
    seeds = vectors.select("vec", F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256).alias("h")) \
        .orderBy("h", "vec").limit(k).collect()
    schema = "cluster int, distance long"
    if not seeds:
        more = {c: F.lit(None).cast("long") for c in ("cluster_inertia", "inertia")} | {"centroid": F.lit(None).cast("array<long>")}
        return vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).withColumns(more)
    centroids = np.array([r["vec"] for r in seeds], np.int64)
    low, high, sums, sizes = _first_pass(vectors, centroids)
    grid = Grid(low, high, cells)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = grid.codes(_matrix(b.column(1), dims))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in codes], pa.binary())], names=["key", "codes"])

    vectors.select("key", "vec").mapInArrow(approximate, "key long, codes binary").write.parquet(f"{base}/approximations")
    approximations = spark.read.parquet(f"{base}/approximations")
    full = vectors.select("key", "vec").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key") \
        .sortWithinPartitions("key").persist(StorageLevel.DISK_ONLY)
    try:
        for i in range(rounds):
            before, centroids = centroids, _means(centroids, sums, sizes)
            if (before == centroids).all() or i == rounds - 1:
                break  # nothing would move any more, or the last assignment follows
            d_sums, d_sizes = _changes(full, _unsure(approximations, grid, before, centroids), before, centroids)
            sums, sizes = sums + d_sums, sizes + d_sizes
    finally:
        full.unpersist()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [nearest(_matrix(b.column(1).slice(i, STEP), dims), centroids) for i in range(0, b.num_rows, STEP)]
            number, dist = (np.concatenate([p[j] for p in parts]) if parts else np.empty(0, np.int64) for j in (0, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(number, pa.int32()), pa.array(dist, pa.int64())],
                                             names=["id", "cluster", "distance"])

    src = vectors.select("id", "vec")
    out = src.mapInArrow(assign, f"id {src.schema['id'].dataType.simpleString()}, {schema}")
    inertia = {r[0]: r[1] for r in out.groupBy("cluster").agg(F.sum("distance")).collect()}
    of = F.element_at(F.array(*[F.lit(inertia.get(j, 0)).cast("long") for j in range(len(centroids))]), F.col("cluster") + 1)
    at = F.element_at(F.array(*[F.array(*[F.lit(x).cast("long") for x in c.tolist()]) for c in centroids]), F.col("cluster") + 1)
    return out.withColumns({"cluster_inertia": of, "inertia": F.lit(sum(inertia.values())).cast("long"), "centroid": at})

