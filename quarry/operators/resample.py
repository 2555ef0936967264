"""Resampling.

Replicates are generated without driver loops: every row is expanded over
the replicate index with a hash-derived Poisson(1) multiplicity (the
bootstrap of a large table), or random draws are keys joined to a row
index.  Hashes make every draw repeatable after executor loss.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.quantiles import quantiles
from quarry.operators.relational import with_row_index

# Cumulative Poisson(1) probabilities P(K <= k), as far as double precision
# tells them from 1: no uniform number lies beyond the last one.
POISSON1_CDF = tuple(p for p in itertools.accumulate(math.exp(-1) / math.factorial(k) for k in range(25)) if p < 1.0)


def _uniform(seed: int, *cols: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 40)).cast("double") / float(1 << 40)


def poisson_weight(u: Column) -> Column:
    expr = None
    for k, c in enumerate(POISSON1_CDF):
        expr = F.when(u < c, k) if expr is None else expr.when(u < c, k)
    return expr.otherwise(len(POISSON1_CDF))


def bootstrap_quantile(df: DataFrame, value: str, id_cols: Sequence[str], prob: float, reps: int,
                       seed: int = 42, uniform: Callable[..., Column] | None = None) -> DataFrame:
    """Poisson bootstrap of the ``prob`` quantile: each row appears k ~
    Poisson(1) times in each replicate; exact quantile per replicate
    (distributed); mean and sd over replicates.  ``uniform(rep, *ids)``
    overrides the default xxhash64-based draw."""
    u = uniform or (lambda *cs: _uniform(seed, *cs))
    r = df.select(F.col(value).alias("x"), *id_cols).withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
    r = r.withColumn("k", poisson_weight(u(F.col("rep"), *[F.col(c) for c in id_cols]))).where(F.col("k") > 0)
    r = r.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("k"))))
    q = quantiles(r, "x", [prob], by=["rep"])
    return q.agg(F.count(F.lit(1)).alias("replicates"), F.avg("q").alias("mean_q"), F.stddev_samp("q").alias("sd_q"))


def resample_with_replacement(df: DataFrame, order_by: Sequence[str], n_draws: int, seed: int = 42,
                              uniform: Callable[..., Column] | None = None) -> DataFrame:
    """``sample(x, n, replace = TRUE)``: draw indices by hash and join them
    to the row index (both sides distributed)."""
    u = uniform or (lambda *cs: _uniform(seed, *cs))
    ix = with_row_index(df, order_by, "_pos")
    n = ix.count()
    draws = df.sparkSession.range(n_draws).withColumn("_pos", F.floor(u(F.col("id")) * n).cast("long") + 1)
    return draws.join(ix, "_pos").drop("_pos")


def historical_var(df: DataFrame, r: str, order_by: Sequence[str], n_draws: int, alpha: float = 0.05,
                   seed: int = 42, uniform: Callable[..., Column] | None = None) -> DataFrame:
    """Historical simulation: resampled returns -> VaR (alpha quantile) and
    ES (mean below it)."""
    s = resample_with_replacement(df.select(*order_by, r), order_by, n_draws, seed, uniform)
    q = quantiles(s, r, [alpha]).select(F.col("q").alias("var"))
    v = q.scalar()
    return s.where(F.col(r) <= v).agg(F.count(F.lit(1)).alias("n_tail"), F.avg(r).alias("es")).select(v.alias("var"), "n_tail", "es")


def block_bootstrap(df: DataFrame, t: str, r: str, block: int, n_draws: int, seed: int = 42,
                    uniform: Callable[..., Column] | None = None) -> DataFrame:
    """Random start + the following block-1 periods, summed; distribution
    of the block sums (mean, sd, 5 % quantile)."""
    from quarry.operators.windows import over_halo, rolling_columns
    ix = with_row_index(df.select(t, r), [t], "_pos")
    rs = over_halo(ix, [], "_pos", 0, block - 1, rolling_columns(r, block, "block_sum")).where(F.col("block_sum").isNotNull())
    n_start = rs.count()
    u = uniform or (lambda *cs: _uniform(seed, *cs))
    starts = df.sparkSession.range(n_draws).withColumn("_pos", F.floor(u(F.col("id")) * n_start).cast("long") + 1)
    s = starts.join(rs.select("_pos", "block_sum"), "_pos")
    q = quantiles(s, "block_sum", [0.05]).select("q").scalar()
    return s.agg(F.count(F.lit(1)).alias("draws"), F.avg("block_sum").alias("mean"), F.stddev_samp("block_sum").alias("sd")) \
        .select("draws", "mean", "sd", q.alias("q05"))
