"""Exact nearest neighbours on many features by pivot distances.

A query set is searched in a table of any size.  A few pivots cut the
table into cells (every row belongs to its nearest pivot) and rings (its distance
to that pivot, in steps of ``width``).  The triangle inequality then bounds a
row's distance to a query from both sides by pivot distances alone:

1. Of each cell the k least pivot distances are kept (a group-limited window);
   with the query's own pivot distances they give an upper bound of the
   distance to its k-th neighbour.
2. Rows are numbered by cell and pivot distance and cut into blocks, queries by
   their nearest pivot into parts.  A query only meets the blocks in which a row
   may be that near: pivot distances within the bound, and the bisector between
   the cell's pivot and the query's nearest pivot no farther than it.
3. A block and the queries of one part that it may serve meet in one task, of
   bounded size on both sides.  One matrix product gives all their distances up to
   rounding; the pairs that rounding leaves in question are computed exactly, and
   the best k per query leave the task.  Of equal rows in a block k are looked at.

The pivots (``pivots`` rows, the least hashes of id) and k distances per pivot are
all that reaches the driver.  Where the bounds rule out nothing, as among many
independent features, the work is rows x queries multiplications, spread over the
blocks.

Rows whose features are null, of another length than the pivots', or hold a null
or non-finite value take no part.  Equal distances go by the smaller id.  Fewer
than k rows give fewer neighbours; an empty side gives none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.relational import with_row_index
from quarry.session import cut_lineage, ship_package

#: Room for rounding in bounds, relative to the distances compared.
SLACK = 1e-9
#: Rows of a block and queries of a part at most, and numbers in either.
BLOCK_ROWS, BLOCK_NUMBERS = 1 << 14, 1 << 22
#: Queries multiplied with a block at once, and pairs computed exactly at once.
SLICE_ROWS, EXACT_PAIRS = 256, 1 << 16
#: Tasks of the products at most.
MAX_TASKS = 4096


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def _features(df: DataFrame, id_col: str, vec: str, keep: list[str]) -> DataFrame:
    whole = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(vec).isNotNull() & (F.size(vec) > 0) & whole & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).alias("id"), F.transform(vec, lambda x: x.cast("double")).alias("x"), *keep)


def pivot_rows(train: DataFrame, pivots: int, seed: int) -> list[list[float]]:
    """Features of the rows with the least hashes of id, different ones only."""
    rows = train.select("x", F.xxhash64(F.lit(seed), "id").alias("h")).orderBy("h", "x").limit(pivots).collect()
    out: list[list[float]] = []
    for r in rows:
        if len(r["x"]) == len(rows[0]["x"]) and r["x"] not in out:
            out.append(r["x"])
    return out


def _cells(train: DataFrame, test: DataFrame, id_col: str, vec: str, k: int, pivots: int, seed: int,
           keep: tuple[str, ...]) -> tuple[list[list[float]], DataFrame, DataFrame] | None:
    """Pivots; rows (id, x, keep..., r, cell) with their nearest pivot; queries
    (query_id, qx, d, home, bound) with the distances to all pivots, the nearest, and
    an upper bound of the distance to the k-th neighbour.  None if there are no rows."""
    tr, te = _features(train, id_col, vec, list(keep)), _features(test, id_col, vec, [])
    at = pivot_rows(tr, pivots, seed)
    if not at:
        return None
    tr, te = (d.where(F.size("x") == len(at[0])) for d in (tr, te))
    lit = F.array(*[F.array(*[F.lit(float(v)) for v in p]) for p in at])
    near = F.array_min(F.transform(lit, lambda p, i: F.struct(distance(F.col("x"), p).alias("r"), i.alias("cell"))))
    cells = cut_lineage(tr.withColumn("near", near).select("id", "x", *keep, "near.r", "near.cell"))
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("r"))
    least = cells.select("cell", "r").withColumn("n", rank).where(F.col("n") <= k).groupBy("cell") \
        .agg(F.sort_array(F.collect_list("r")).alias("least")).collect()
    # per query: distances to all pivots, the nearest, and the bound
    q = te.select(F.col("id").alias("query_id"), F.col("x").alias("qx"), F.transform(lit, lambda p: distance(F.col("x"), p)).alias("d"))
    reach = [F.col("d")[r["cell"]] + F.lit(v) for r in least for v in r["least"]]
    upper = F.array_sort(F.array(*reach))
    q = q.withColumn("bound", upper[k - 1] * (1 + SLACK) if len(reach) >= k else F.lit(float("inf")))
    home = F.array_min(F.transform("d", lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    return at, cells, q.withColumn("home", home)


def _reach(at: list[list[float]], cell: Column, lo: Column, hi: Column) -> tuple[Column, Column, Column]:
    """First and last pivot distance between ``lo`` and ``hi`` at which a row of the cell
    may be as near as a query's bound, and whether the cell may hold such a row at all."""
    d = F.element_at("d", cell + 1)
    # rows of the cell lie on its side of the bisector with the query's nearest pivot
    apart = F.element_at(F.element_at(F.array(*[F.array(*[F.lit(math.dist(a, b)) for b in at]) for a in at]), cell + 1), F.col("home.i") + 1)
    behind = F.when(apart > 0, (d * d - F.col("home.v") * F.col("home.v")) / (2 * apart) * (1 - SLACK) <= F.col("bound")).otherwise(True)
    first, last = F.greatest(lo, d * (1 - SLACK) - F.col("bound")), F.least(hi, d * (1 + SLACK) + F.col("bound"))
    return first, last, behind & (first <= last)


def candidate_pairs(train: DataFrame, test: DataFrame, id_col: str, vec: str, k: int, pivots: int = 16, rings: int = 64,
                    seed: int = 42, keep: tuple[str, ...] = ()) -> DataFrame | None:
    """(query_id, qx, id, x, keep...): pairs that the bounds cannot rule out, by rings of
    equal width around the pivots; None if there are no rows."""
    got = _cells(train, test, id_col, vec, k, pivots, seed, keep)
    if got is None:
        return None
    at, cells, q = got
    most = {r["cell"]: (r["lo"], r["hi"]) for r in cells.groupBy("cell").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).collect()}
    width = max(hi for _, hi in most.values()) / rings or 1.0
    spans = []
    for c, (lo, hi) in sorted(most.items()):
        first, last, may = _reach(at, F.lit(c), F.lit(lo), F.lit(hi))
        spans.append(F.when(may, F.struct(F.lit(c).alias("cell"), F.floor(first / width).alias("from"), F.floor(last / width).alias("to"))))
    q = q.select("query_id", "qx", F.explode(F.filter(F.array(*spans), lambda s: s.isNotNull())).alias("s")) \
        .select("query_id", "qx", "s.cell", F.explode(F.sequence("s.from", "s.to")).alias("ring"))
    return q.join(cells.withColumn("ring", F.floor(F.col("r") / width)), ["cell", "ring"]).select("query_id", "qx", "id", "x", *keep)


def nearest_of_block(q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the ``k`` rows of ``x`` nearest to each row of ``q``; of
    equal distances the earlier rows.  The distance is summed feature by feature."""
    same = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel(), return_inverse=True)[1].ravel()
    by = np.argsort(same, kind="stable")
    nth = np.arange(len(x)) - np.searchsorted(same[by], same[by])
    some = np.sort(by[nth < k])  # of equal rows only the first k can be among the nearest
    x, out = x[some], []
    with np.errstate(over="ignore"):
        xx = (x * x).sum(axis=1)
    for first in range(0, len(q), SLICE_ROWS):
        a = q[first:first + SLICE_ROWS]
        with np.errstate(over="ignore", invalid="ignore"):
            near = xx[None, :] - 2 * (a @ x.T)  # less the query's own square
            room = 16 * (x.shape[1] + 4) * np.finfo(float).eps * (np.sqrt((a * a).sum(axis=1)) + np.sqrt(xx.max())) ** 2
            worst = np.partition(near, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1] + room
            row, col = np.nonzero(~(near > worst[:, None]))  # also where squares are too large to compare
        dist = np.empty(len(row))
        for i in range(0, len(row), EXACT_PAIRS):
            diff = a[row[i:i + EXACT_PAIRS]] - x[col[i:i + EXACT_PAIRS]]
            total = np.zeros(len(diff))
            with np.errstate(over="ignore"):
                for j in range(diff.shape[1]):
                    total += diff[:, j] * diff[:, j]
            dist[i:i + EXACT_PAIRS] = np.sqrt(total)
        order = np.lexsort((col, dist, row))
        row, col, dist = row[order], col[order], dist[order]
        best = np.arange(len(row)) - np.searchsorted(row, row) < k
        out.append((row[best] + first, some[col[best]], dist[best]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _matrix(table: pa.Table, name: str, dims: int) -> np.ndarray:
    return pa.concat_arrays([c.flatten() for c in table[name].chunks]).to_numpy(zero_copy_only=False).reshape(-1, dims)


def knn(train: DataFrame, test: DataFrame, id_col: str, vec: str, k: int, keep: tuple[str, ...] = (), pivots: int = 16,
        seed: int = 42, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, nn_rank, id, dist, keep...): the ``k`` nearest rows of ``train`` to
    each row of ``test``; exact."""
    ship_package(train.sparkSession)
    got = _cells(train, test, id_col, vec, k, pivots, seed, keep)
    if got is None:
        empty = train.where(F.lit(False))
        return empty.select(F.col(id_col).alias("query_id"), F.lit(0).alias("nn_rank"), F.col(id_col).alias("id"), F.lit(0.0).alias("dist"), *keep)
    at, cells, q = got
    dims = len(at[0])
    size = max(1, min(block_rows, BLOCK_NUMBERS // dims))
    nth = F.floor((F.col("_pos") - 1) / size)
    rows = with_row_index(cells, ["cell", "r", "id"], "_pos").select("id", "x", *keep, "r", "cell", nth.alias("block"))
    spans = rows.groupBy("block", "cell").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).groupBy("block") \
        .agg(F.collect_list(F.struct("cell", "lo", "hi")).alias("spans")).withColumnRenamed("block", "of")
    asked = with_row_index(q.withColumns({"_cell": F.col("home.i"), "_r": F.col("home.v")}), ["_cell", "_r", "query_id"], "_pos")
    asked = asked.join(F.broadcast(spans), F.exists("spans", lambda s: _reach(at, s["cell"], s["lo"], s["hi"])[2])) \
        .select("query_id", "qx", nth.alias("part"), F.col("of").alias("block"))
    pairs = cut_lineage(asked.select("part", "block").distinct())
    tasks = max(1, min(pairs.count(), MAX_TASKS))
    names = ["query_id", "id", "dist", *keep]
    kinds = {f.name: f.dataType.simpleString() for f in (*rows.schema, *asked.schema)} | {"dist": "double"}

    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        block = block.take(pc.sort_indices(block["id"]))
        row, col, dist = nearest_of_block(_matrix(queries, "qx", dims), _matrix(block, "x", dims), k)
        near = block.select(["id", *keep]).take(pa.array(col))
        return pa.table([queries["query_id"].take(pa.array(row)), near["id"], pa.array(dist), *(near[c] for c in keep)], names=names)

    dealt = (d.repartition(tasks, "part", "block").groupBy("part", "block")
             for d in (asked, rows.drop("r", "cell").join(F.broadcast(pairs), "block")))
    near = next(dealt).cogroup(next(dealt)).applyInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names))
    best = Window.partitionBy("query_id").orderBy("dist", "id")
    return near.withColumn("nn_rank", F.row_number().over(best)).where(F.col("nn_rank") <= k).select("query_id", "nn_rank", "id", "dist", *keep)


def vote(neighbours: DataFrame, label: str) -> DataFrame:
    """(query_id, predicted): the most frequent label; ties go to that of the nearer neighbour."""
    counts = neighbours.groupBy("query_id", label).agg(F.count(F.lit(1)).alias("n"), F.min("nn_rank").alias("first"))
    return counts.groupBy("query_id").agg(F.max_by(F.col(label), F.struct(F.col("n"), -F.col("first"))).alias("predicted"))
