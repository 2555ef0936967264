"""Exact top-n inner products of two factor tables, without their product.

Items are numbered by falling norm.  By Cauchy and Schwarz no item from some place on can
score above (norm of the user) x (norm of that item), so a user is done as soon as that
falls below its n-th best score so far; all later items are shorter still.

Items pass in slices of ``slice_rows`` rows: a slice is the only thing that is sent to
every task (``slice_rows`` x factors numbers, whatever the tables hold), users stay where
they are.  Users that are done leave after each slice, the rest is written to the
checkpoint folder with its best scores.

A task takes a slice by bands of ``BAND_ROWS`` items, and users that are done skip the rest.
A band is halved by norm and direction into blocks of like items.  What a block can score
is bounded for every user by a cone (its directions lie around a mean one, its norms in a
range) and by a ball (its items lie around their mean).  A user meets its most promising
blocks first, then only those whose bound reaches its n-th best score.  A matrix product
scores them; what comes near enough, rounding considered, is scored again factor by factor,
so rounding decides nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.relational import with_row_index
from quarry.session import cut_lineage, ship_package

#: Items sent to the tasks at once, items bounded at once in a task, and items of a block at most.
SLICE_ROWS, BAND_ROWS, BLOCK_ROWS = 1 << 18, 1 << 14, 1 << 7
#: Users scored at once in a task.
USER_ROWS = 1 << 11
#: Blocks that a user meets first, whatever their bounds.
FIRST_BLOCKS = 2
#: Candidates per user that wait for a merge.
SETTLE = 4
#: Room for rounding in bounds and matrix products, relative to the product of the norms.
SLACK = 1e-9

STATE = "u long, x array<double>, ids array<long>, scores array<double>, done boolean"


class Blocks:
    """The items of a band, laid out by blocks, and the bounds of every block."""

    def __init__(self, items: np.ndarray, v: np.ndarray, block: int):
        norm = np.sqrt((v * v).sum(axis=1))
        way = v / np.where(norm > 0, norm, 1)[:, None]
        like = np.column_stack([way * norm.mean(), norm])
        parts, todo = [], [np.arange(len(v))]
        while todo:
            part = todo.pop()
            if len(part) <= block:
                parts.append(part)
                continue
            half = len(part) // 2
            by = np.argpartition(like[part, np.argmax(like[part].var(axis=0))], half)
            todo += [part[by[:half]], part[by[half:]]]
        parts.sort(key=lambda p: -norm[p].max())
        order = np.concatenate(parts)
        self.ends = np.cumsum([len(p) for p in parts])
        self.starts = np.append(0, self.ends[:-1])
        self.items, self.v = items[order], v[order]
        self.longest, self.shortest = np.array([norm[p].max() for p in parts]), np.array([norm[p].min() for p in parts])
        (self.mean, self.reach), (self.way, self.spread) = self._balls(v, parts), self._balls(way, parts)

    @staticmethod
    def _balls(x: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        mean = np.array([x[p].mean(axis=0) for p in parts])
        return mean, np.array([np.sqrt(((x[p] - m) ** 2).sum(axis=1).max()) for p, m in zip(parts, mean)])

    def bounds(self, x: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """What the items of each block (row) can score for each user (column) at most."""
        cone = self.way @ x.T + self.spread[:, None] * norm
        cone = np.maximum(cone * self.longest[:, None], cone * self.shortest[:, None])
        top = self.longest[:, None] * norm
        return np.minimum(np.minimum(cone, self.mean @ x.T + self.reach[:, None] * norm), top) + SLACK * top


def _merge(x: np.ndarray, ids: np.ndarray, scores: np.ndarray, row: np.ndarray, items: np.ndarray, v: np.ndarray) -> None:
    """Take items (one for each of ``row``, a row of ``x``) into the best lists (rows of
    ``ids``, ``scores``, unused places at -inf) in place; equal scores go to the smaller id."""
    new = np.zeros(len(row))
    for k in range(v.shape[1]):  # factor by factor, so equal items get equal scores
        new += x[row, k] * v[:, k]
    some = np.unique(row)
    row = np.concatenate([np.repeat(some, ids.shape[1]), row])
    i, s = np.concatenate([ids[some].ravel(), items]), np.concatenate([scores[some].ravel(), new])
    used = s > -np.inf
    row, i, s = row[used], i[used], s[used]
    order = np.lexsort((i, -s, row))
    row, s, i = row[order], s[order], i[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    kept = place < ids.shape[1]
    scores[some], ids[some] = -np.inf, -1
    scores[row[kept], place[kept]], ids[row[kept], place[kept]] = s[kept], i[kept]


def _score(x: np.ndarray, norm: np.ndarray, ids: np.ndarray, scores: np.ndarray, blocks: Blocks) -> int:
    """Take a band into the best lists of some users in place; returns the products computed."""
    bound = blocks.bounds(x, norm)
    worst = scores[:, -1].copy()
    near, found, n_found, n_products = SLACK * norm, [], 0, 0

    def meet(b: int, todo: np.ndarray, own: bool = False) -> None:
        nonlocal n_found, n_products
        at = blocks.starts[b]
        s = x[todo] @ blocks.v[at:blocks.ends[b]].T
        n_products += s.size
        least = worst[todo]
        if own and s.shape[1] > ids.shape[1]:  # no list yet: the block's own n best will do
            least = np.maximum(least, np.partition(s, -ids.shape[1], axis=1)[:, -ids.shape[1]])
        row, col = np.divmod(np.flatnonzero(~(s < (least - 2 * near[todo] * blocks.longest[b])[:, None])), s.shape[1])
        found.append((todo[row], at + col))
        n_found += len(row)
        if n_found > SETTLE * len(x):
            settle()

    def settle() -> None:
        nonlocal n_found
        if n_found:
            row, item = (np.concatenate(c) for c in zip(*found))
            _merge(x, ids, scores, row, blocks.items[item], blocks.v[item])
            worst[:] = scores[:, -1]
        found.clear()
        n_found = 0

    first = min(FIRST_BLOCKS, len(bound))
    best = np.argpartition(-bound, first - 1, axis=0)[:first]
    for nth in best:
        by = np.argsort(nth, kind="stable")
        names, at = np.unique(nth[by], return_index=True)
        for b, todo in zip(names.tolist(), np.split(by, at[1:])):
            meet(b, todo[~(bound[b, todo] < worst[todo])], own=True)
    settle()
    np.put_along_axis(bound, best, np.nan, axis=0)  # met already
    for b in range(len(bound)):
        todo = np.flatnonzero(bound[b] >= worst)
        if len(todo):
            meet(b, todo)
    settle()
    return n_products


def _take_slice(items: np.ndarray, v: np.ndarray, after: float, n: int, block: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands: list[Blocks] = []
        for whole in batches:
            for at in range(0, len(whole), USER_ROWS):
                pdf = whole.iloc[at:at + USER_ROWS]
                x = np.array(pdf["x"].tolist(), dtype=float)
                ids, scores = np.full((len(x), n), -1, dtype=np.int64), np.full((len(x), n), -np.inf)
                for r, (i, s) in enumerate(zip(pdf["ids"], pdf["scores"])):
                    ids[r, :len(i)], scores[r, :len(s)] = i, s
                norm = np.sqrt((x * x).sum(axis=1)) * (1 + SLACK)
                for b, first in enumerate(range(0, len(v), BAND_ROWS)):
                    todo = np.flatnonzero(~(norm * np.sqrt((v[first] * v[first]).sum()) < scores[:, n - 1]))
                    if not len(todo):
                        break
                    if b == len(bands):
                        bands.append(Blocks(items[first:first + BAND_ROWS], v[first:first + BAND_ROWS], block))
                    i, s = ids[todo], scores[todo]
                    _score(x[todo], norm[todo], i, s, bands[b])
                    ids[todo], scores[todo] = i, s
                used = (scores > -np.inf).sum(axis=1)
                yield pd.DataFrame({"u": pdf["u"].to_numpy(), "x": list(x), "ids": [i[:k] for i, k in zip(ids, used)],
                                    "scores": [s[:k] for s, k in zip(scores, used)],
                                    "done": (norm * after < scores[:, n - 1]) | (after < 0)})
    return run


def top_products(users: DataFrame, items: DataFrame, n: int, slice_rows: int = SLICE_ROWS, block: int = BLOCK_ROWS,
                 slices: list[int] | None = None) -> DataFrame:
    """(u, rank, i, score): the ``n`` items with the largest inner products for every user;
    equal scores go to the smaller id, fewer items give shorter lists.  Both tables hold
    (id long, features array) with finite features of one length.  ``slices`` collects
    the number of users that each slice was scored for."""
    if n < 1 or slice_rows < 1 or block < 1:
        raise ValueError("n, slice_rows and block must be positive")
    ship_package(users.sparkSession)
    v = items.select(F.col("id").cast("long").alias("id"), F.transform("features", lambda f: f.cast("double")).alias("v"))
    v = v.withColumn("short", -F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, f: s + f * f)))
    v = cut_lineage(with_row_index(v, ["short", "id"], "pos"))
    # spread over the tasks of a shuffle: factors come in as few partitions as the fit has blocks
    users = users.repartition(int(users.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), "id")
    left = users.select(F.col("id").cast("long").alias("u"), F.transform("features", lambda f: f.cast("double")).alias("x"),
                        F.array().cast("array<long>").alias("ids"), F.array().cast("array<double>").alias("scores"), F.lit(False).alias("done"))
    ready, first = [], 1
    part = _slice(v, first, slice_rows + 1)
    while part:
        part, after = part[:slice_rows], part[slice_rows:]
        run = _take_slice(np.array([r["id"] for r in part]), np.array([r["v"] for r in part]),
                          -after[0]["short"] if after else -1.0, n, block)
        if slices is not None:
            slices.append(left.count())
        state = cut_lineage(left.mapInPandas(run, STATE))
        ready.append(state.where("done"))
        left = state.where(~F.col("done"))
        first += slice_rows
        part = _slice(v, first, slice_rows + 1) if after and not left.isEmpty() else []
    out = left.where(F.lit(False)) if not ready else ready[0]
    for more in ready[1:]:
        out = out.union(more)
    return out.select("u", F.posexplode(F.arrays_zip("ids", "scores")).alias("k", "best")) \
        .select("u", (F.col("k") + 1).alias("rank"), F.col("best.ids").alias("i"), F.col("best.scores").alias("score"))


def _slice(v: DataFrame, first: int, rows: int) -> list:
    """At most ``rows`` items from position ``first`` on, in order."""
    return sorted(v.where(F.col("pos").between(first, first + rows - 1)).select("pos", "id", "v", "short").collect())
