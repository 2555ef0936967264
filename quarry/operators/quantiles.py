"""Exact quantiles by selection, without ordering a whole group.

``percentile()`` keeps every value of a group in one aggregation buffer, so
a global median -- or a group holding a third of the rows -- lands in a
single task.  Here values are first counted per (group, distinct value), which
combines ties in every task.  The wanted ranks are then followed down:

1. buckets of the logarithm (2^-10 of an octave, the same for every input) are
   counted; running counts over the buckets tell which of them hold a rank;
2. those buckets are cut into 2^20 equal parts between their own least and
   greatest value, which are counted in the same way;
3. only the parts that hold a rank are ordered.

Each step is monotone in the value, so the order statistics are exact however
the values lie.  A part of a bucket has at most about 2^22 different doubles and a group
at most 2^22 buckets, which bounds every ordered window whatever the size of
the group.  One path whatever the size, nothing is written while the query is
built; infinities and NaN sort like R's and DuckDB's doubles (NaN last).

Quantiles use R type 7 / Spark ``percentile`` / DuckDB ``quantile_cont``:
h = (n-1)p, q = v[floor h] + (h - floor h)(v[floor h + 1] - v[floor h]);
where both order statistics are equal, as with two infinities, q is that value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.columns import join_null_safe

_KEY = "__grp"
#: Buckets per octave in the first step, parts of a bucket in the second.
PER_OCTAVE, PARTS = 1 << 10, 1 << 20
_LAST_OCTAVE = 1100  # beyond the exponents of a double, -1074 to 1024


def _octave_bucket(x: Column) -> Column:
    """Bucket number, never falling as ``x`` rises: 0 for zero, mirrored for
    negative values, one bucket for each infinity, the last one for NaN."""
    size = F.abs(x)
    step = F.floor((F.log2(size) + _LAST_OCTAVE) * PER_OCTAVE) + 1
    top = F.lit(2 * _LAST_OCTAVE * PER_OCTAVE).cast("long")
    return F.when(F.isnan(x), top + 1).when(size == float("inf"), F.signum(x).cast("long") * top) \
        .when(x == 0, F.lit(0).cast("long")).otherwise(F.signum(x).cast("long") * step)


def _part(x: Column, lo: Column, hi: Column) -> Column:
    """Which of the equal parts of [lo, hi] holds ``x``; 0 if there is one value."""
    return F.when(lo == hi, F.lit(0).cast("long")).otherwise(F.floor((x - lo) / (hi - lo) * PARTS))


def _holding(ranks: Column, before: Column, count: Column) -> Column:
    """The wanted entries with an order statistic among ``count`` rows that come after ``before`` others."""
    here = lambda k: (k >= before) & (k < before + count)
    return F.filter(ranks, lambda w: here(w["k0"]) | here(w["k1"]))


def _up_to_here(over: Sequence[str], order: str) -> Column:
    """Rows that come before the current one's, in ``order``."""
    w = Window.partitionBy(*over).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_c").over(w), F.lit(0))


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
              partitions: int | None = None) -> DataFrame:
    """Exact type-7 quantiles of ``value`` per ``by`` group.

    Returns ``by`` + ``p`` (double) + ``q`` (double); NULLs are ignored and a
    group with no values has no rows.  ``partitions`` deals the distinct values
    over that many tasks instead of the session's number."""
    keys = list(by) if by else [_KEY]
    data = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_x"))
    if not by:
        data = data.withColumn(_KEY, F.lit(0))
    cells = data.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c"))
    if partitions:
        cells = cells.repartition(partitions, *keys, "_x")
    cells = cells.withColumn("_b", _octave_bucket(F.col("_x")))

    last = F.col("_n") - 1
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), (last * float(p)).alias("h"),
                                F.floor(last * float(p)).alias("k0"),
                                F.least(F.floor(last * float(p)) + 1, last).alias("k1")) for p in probs])
    octaves = cells.groupBy(*keys, "_b").agg(F.sum("_c").alias("_c"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    octaves = octaves.withColumn("_before", _up_to_here(keys, "_b")) \
        .withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys))) \
        .withColumn("_w", _holding(wanted, F.col("_before"), F.col("_c"))).where(F.size("_w") > 0)

    near = join_null_safe(cells, octaves.select(*keys, "_b", "_lo", "_hi", "_before", "_w"), [*keys, "_b"]) \
        .withColumn("_part", _part(F.col("_x"), F.col("_lo"), F.col("_hi")))
    parts = near.groupBy(*keys, "_b", "_part", "_before", "_w").agg(F.sum("_c").alias("_c"))
    parts = parts.withColumn("_before", F.col("_before") + _up_to_here([*keys, "_b"], "_part")) \
        .withColumn("_w", _holding(F.col("_w"), F.col("_before"), F.col("_c"))).where(F.size("_w") > 0)

    held = join_null_safe(near.select(*keys, "_b", "_part", "_x", "_c"), parts.select(*keys, "_b", "_part", "_before", "_w"),
                          [*keys, "_b", "_part"])
    held = held.withColumn("_before", F.col("_before") + _up_to_here([*keys, "_b", "_part"], "_x")) \
        .select(*keys, "_x", "_before", "_c", F.explode(_holding(F.col("_w"), F.col("_before"), F.col("_c"))).alias("_w"))
    at = lambda k: F.max(F.when((F.col(k) >= F.col("_before")) & (F.col(k) < F.col("_before") + F.col("_c")), F.col("_x")))
    q = held.groupBy(*keys, "_w.p").agg(F.first("_w.h").alias("h"), F.first("_w.k0").alias("k0"),
                                        at("_w.k0").alias("v0"), at("_w.k1").alias("v1"))
    between = F.col("v0") + (F.col("h") - F.col("k0")) * (F.col("v1") - F.col("v0"))
    out = q.select(*keys, "p", F.when((F.col("h") == F.col("k0")) | (F.col("v0") == F.col("v1")), F.col("v0"))
                   .otherwise(between).alias("q"))
    return out.drop(_KEY) if not by else out


def quantile_wide(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                  by: Sequence[str] = ()) -> DataFrame:
    """One row per group, one column per probability (named by ``names``)."""
    long = quantiles(df, value, probs, by)
    aggs = [F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(n) for p, n in zip(probs, names)]
    if by:
        return long.groupBy(*by).agg(*aggs)
    return long.agg(*aggs)


def median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return quantile_wide(df, value, [0.5], [name], by)


def approx_quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                     by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """One-pass approximate quantiles (``percentile_approx``, a mergeable
    sketch per group: rank error about n / accuracy) for when the exact
    multi-pass form is not needed."""
    q = F.percentile_approx(F.col(value).cast("double"), list(probs), accuracy)
    g = df.groupBy(*by) if by else df
    return g.agg(q.alias("_q")).select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
