"""Recurrences along a series without holding the series in one task.

A smoothing recurrence is an affine map of its state per row, and maps compose.
Rows are cut into blocks by their position in the series; a block gives the map
of all its rows at once, so only one row per block has to be taken in order:

* ``decayed_sums``: scalar state s' = decay * s + value.  The value of every row is
  asked for, so it is a window sum inside the block plus the block's carry.  The
  carries are the same recurrence over the blocks with decay ** size, until that
  is so small that only a few blocks back still count.
* ``holt_fits``: state (level, trend).  Only the last state and the sum of squared
  errors are asked for; the errors are affine in the state a block starts from, so
  their squares are a quadratic form of it, kept by its six coefficients.  It is
  taken around the block's first value, which keeps the terms small.

Positions number the rows of a series 1, 2, ... without gaps.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.columns import join_null_safe
from quarry.operators.windows import BLOCK_ROWS, running_sums
from quarry.session import cut_lineage

#: Powers of the decay inside a block stay above exp(-REACH), so their inverses are finite.
REACH = 230.0
#: exp(-VANISHED) is 0 in double precision.
VANISHED = 745.0


def decayed_sums(df: DataFrame, by: Sequence[str], pos: str, value: str, decay: float, name: str,
                 block: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``name``: the state before each row, 0 at the first one, then
    decay * (state before the previous row) + (value of the previous row).
    ``value`` holds finite doubles, 0 < ``decay`` < 1; ``df`` is read twice."""
    if not 0 < decay < 1:
        raise ValueError("decay must lie between 0 and 1")
    rate = -math.log(decay)
    size = max(1, min(block, int(REACH / rate)))
    k = F.expr(f"(`{pos}` - 1) % {size}")
    d = df.withColumn("_blk", F.expr(f"(`{pos}` - 1) div {size}"))
    before = Window.partitionBy(*by, "_blk").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(F.col(value) * F.exp(k * rate)).over(before), F.lit(0.0)) * F.exp((1 - k) * rate)
    ends = d.groupBy(*by, "_blk").agg(F.sum(F.col(value) * F.exp((k - (size - 1)) * rate)).alias("_c"))
    if REACH / rate <= block:
        # few blocks back still count: each adds to the carries of the next ones
        ahead = F.explode(F.sequence(F.lit(1), F.lit(1 + math.ceil(VANISHED / (rate * size))))).alias("_i")
        carry = ends.select(*by, "_blk", "_c", ahead).groupBy(*by, (F.col("_blk") + F.col("_i")).alias("_blk")) \
            .agg(F.sum(F.col("_c") * F.exp((1 - F.col("_i")) * rate * size)).alias("_carry"))
    else:
        blocks = cut_lineage(ends.select(*by, (F.col("_blk") + 1).alias("_n"), "_c"))
        carry = decayed_sums(blocks, by, "_n", "_c", math.exp(-rate * size), "_state", block) \
            .select(*by, (F.col("_n") - 1).alias("_blk"), F.col("_state").alias("_carry"))
    out = join_null_safe(d.withColumn("_local", local), carry, [*by, "_blk"], "left")
    return out.withColumn(name, F.col("_local") + F.coalesce(F.col("_carry"), F.lit(0.0)) * F.exp(-k * rate)) \
        .drop("_blk", "_local", "_carry")


def _holt_block(v: Column, first: Column) -> Column:
    """Fold of one block's values: the path from (first, 0), the answers of level and
    trend to a unit more of either, and the coefficients of the squared errors."""
    zero, one = F.lit(0.0), F.lit(1.0)
    start = F.struct(first.alias("l"), zero.alias("b"), one.alias("ll"), zero.alias("lb"), zero.alias("bl"), one.alias("bb"),
                     *[zero.alias(c) for c in ("s0", "s1", "s2", "q11", "q12", "q22")])
    alpha, beta = F.col("alpha"), F.col("beta")

    def move(level: Column, trend: Column, x: Column | None) -> tuple[Column, Column]:
        new = (1 - alpha) * (level + trend) if x is None else alpha * x + (1 - alpha) * (level + trend)
        return new, beta * (new - level) + (1 - beta) * trend

    def step(s: Column, x: Column) -> Column:
        e, p1, p2 = x - (s["l"] + s["b"]), s["ll"] + s["lb"], s["bl"] + s["bb"]
        (l, b), (ll, lb), (bl, bb) = move(s["l"], s["b"], x), move(s["ll"], s["lb"], None), move(s["bl"], s["bb"], None)
        return F.struct(l.alias("l"), b.alias("b"), ll.alias("ll"), lb.alias("lb"), bl.alias("bl"), bb.alias("bb"),
                        (s["s0"] + e * e).alias("s0"), (s["s1"] + e * p1).alias("s1"), (s["s2"] + e * p2).alias("s2"),
                        (s["q11"] + p1 * p1).alias("q11"), (s["q12"] + p1 * p2).alias("q12"), (s["q22"] + p2 * p2).alias("q22"))
    return F.aggregate(v, start, step)


def holt_fits(series: DataFrame, t: str, y: str, by: Sequence[str], alphas: Sequence[float], betas: Sequence[float],
              block: int = BLOCK_ROWS) -> DataFrame:
    """(by..., alpha, beta, sse, level, trend) for every pair of the grid: Holt's linear
    trend started at the first value and the first difference, one-step errors from the
    second value on.  Null values take no part; a series of one value has trend 0 and
    no error.  One row per block and pair of a series meets in one task."""
    size = max(block, 2)
    rows = series.where(F.col(y).isNotNull()).select(*by, t, F.col(y).cast("double").alias("_y"))
    p = running_sums(rows, by, [t], {"_at": F.lit(1)}).withColumn("_blk", F.expr(f"(_at - 1) div {size}"))
    b = p.groupBy(*by, "_blk").agg(F.array_sort(F.collect_list(F.struct("_at", "_y"))).alias("_v")) \
        .withColumn("_v", F.transform("_v", lambda e: e["_y"]))
    first, second = F.col("_v")[0], F.try_element_at("_v", F.lit(2))
    g = b.withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas]))) \
        .withColumn("beta", F.explode(F.array(*[F.lit(float(x)) for x in betas])))
    # the first value only starts the series
    v = F.when(F.col("_blk") == 0, F.slice("_v", 2, size)).otherwise(F.col("_v"))
    maps = g.select(*by, "alpha", "beta", F.struct("_blk", first.alias("y0"), (second - first).alias("d0"), _holt_block(v, first).alias("m")).alias("k"))
    whole = maps.groupBy(*by, "alpha", "beta").agg(F.array_sort(F.collect_list("k")).alias("ks"))
    start = F.struct(F.col("ks")[0]["y0"].alias("l"), F.coalesce(F.col("ks")[0]["d0"], F.lit(0.0)).alias("b"), F.lit(0.0).alias("sse"))

    def join(s: Column, k: Column) -> Column:
        m, dl, db = k["m"], s["l"] - k["y0"], s["b"]
        sse = m["s0"] - 2 * (dl * m["s1"] + db * m["s2"]) + dl * dl * m["q11"] + 2 * dl * db * m["q12"] + db * db * m["q22"]
        return F.struct((m["l"] + dl * m["ll"] + db * m["bl"]).alias("l"), (m["b"] + dl * m["lb"] + db * m["bb"]).alias("b"),
                        (s["sse"] + F.greatest(sse, F.lit(0.0))).alias("sse"))
    return whole.withColumn("st", F.aggregate("ks", start, join)) \
        .select(*by, "alpha", "beta", F.col("st.sse").alias("sse"), F.col("st.l").alias("level"), F.col("st.b").alias("trend"))
