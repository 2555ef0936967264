"""Grouped aggregation operators.

All are ``groupBy().agg()`` plans with partial (map-side) aggregation, so a
hot key is combined on the map side before the shuffle.  Exact quantiles go
through :mod:`quarry.operators.quantiles`; statistics that need a global
value use a one-row scalar subquery.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.columns import col_of
from quarry.operators.quantiles import quantile_wide, quantiles


def count_group(df: DataFrame, *keys: str | Column, name: str = "n", sort: bool = False) -> DataFrame:
    """``count(k)`` / ``table(x)``; NULL is its own group (``exclude=NULL``).
    ``sort=True`` is ``count(k, sort = TRUE)``."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.col(name).desc(), *[col_of(k) for k in keys]) if sort else out


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str] | None = None) -> DataFrame:
    """Two-way ``table(x, y)`` as a wide table (0 for empty cells).  Passing
    ``values`` avoids the extra job that discovers the pivot levels."""
    return df.groupBy(row).pivot(col, list(values) if values else None).count().na.fill(0)


def crosstab_long(df: DataFrame, row: str, col: str, name: str = "n") -> DataFrame:
    return df.groupBy(row, col).agg(F.count(F.lit(1)).alias(name))


def crosstab_row_share(df: DataFrame, row: str, col: str) -> DataFrame:
    """``prop.table(table(x, y), margin = 1)`` in long form."""
    t = crosstab_long(df, row, col)
    return t.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(row)))


def strict_mean(c: str | Column) -> Column:
    """``mean(x)`` without ``na.rm``: NULL when any value is NULL."""
    x = col_of(c)
    return F.when(F.count_if(x.isNull()) > 0, F.lit(None)).otherwise(F.avg(x))


def r_any(p: Column) -> Column:
    """R ``any``: TRUE if any TRUE, else NA if any NA, else FALSE."""
    return F.when(F.bool_or(p), True).when(F.count_if(p.isNull()) > 0, F.lit(None)).otherwise(False)


def r_all(p: Column) -> Column:
    """R ``all``: FALSE if any FALSE, else NA if any NA, else TRUE."""
    return F.when(~F.bool_and(F.coalesce(p, F.lit(True))), False) \
        .when(F.count_if(p.isNull()) > 0, F.lit(None)).otherwise(True)


def kurtosis_raw(c: str | Column) -> Column:
    """R ``moments::kurtosis`` (population, not excess)."""
    return F.kurtosis(col_of(c)) + 3


def argmax(value: str | Column, key: str | Column) -> Column:
    """``names(which.max(x))``: first key (smallest) among ties of the max."""
    return F.max_by(col_of(key), F.struct(col_of(value), -col_of(key)))


def argmin(value: str | Column, key: str | Column) -> Column:
    return F.min_by(col_of(key), F.struct(col_of(value), col_of(key)))


def first_in_group(value: str | Column, order: str | Column) -> Column:
    """Deterministic ``first(x)``: value at the smallest order key."""
    return F.min_by(col_of(value), col_of(order))


def standard_error(c: str | Column) -> Column:
    x = col_of(c)
    return F.stddev_samp(x) / F.sqrt(F.count(x))


def weighted_mean(x: str | Column, w: str | Column) -> Column:
    return F.sum(col_of(x) * col_of(w)) / F.sum(F.when(col_of(x).isNotNull(), col_of(w)))


def multi_stat(df: DataFrame, by: Sequence[str], cols: Sequence[str],
               stats: Mapping[str, callable]) -> DataFrame:
    """``summarize_all`` / ``aggregate(. ~ g, c(mean, sd))``: one generated
    aggregate list, one pass."""
    aggs = [fn(F.col(c)).alias(f"{c}_{s}") for c in cols for s, fn in stats.items()]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``cor(df)`` as long (x, y, r) for x<y, from one aggregation pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) as (x, y, r)")


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], aggs: Sequence[Column]) -> DataFrame:
    """Many group-bys of one table in one pass (``Expand`` + one aggregate);
    ``gid`` identifies the grouping set."""
    cols = sorted({c for s in sets for c in s})
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]) \
        .agg(*aggs, F.grouping_id().alias("gid"))


def simpson_rates(df: DataFrame, treatment: str, stratum: str, success: Column) -> DataFrame:
    """Success rate per treatment, pooled and within each stratum.

    One aggregation at the finest grain (treatment x stratum, map-side
    combined); the pooled level is summed from those few rows.  Output:
    treatment, stratum ('ALL' for pooled), n, successes, rate,
    share_of_treatment (stratum's share of the treatment's rows)."""
    fine = df.groupBy(treatment, stratum).agg(
        F.count(F.lit(1)).alias("n"), F.sum(success.cast("long")).alias("successes"))
    pooled = fine.groupBy(treatment).agg(F.sum("n").alias("n"), F.sum("successes").alias("successes")) \
        .withColumn(stratum, F.lit("ALL"))
    both = fine.unionByName(pooled)
    tot = Window.partitionBy(treatment, F.col(stratum) == "ALL")
    return (both.withColumn("rate", F.col("successes") / F.col("n"))
                .withColumn("share_of_treatment", F.col("n") / F.sum("n").over(tot)))


def hist_bins(df: DataFrame, col: str, width: float, weight: str | None = None, origin: float = 0.0,
              by: Sequence[str] = ()) -> DataFrame:
    """``hist`` / ``geom_histogram(binwidth)``: bin start, count (or weight sum)."""
    b = (F.floor((F.col(col) - origin) / width) * width + origin).alias("bin")
    agg = F.sum(weight).alias("weight") if weight else F.count(F.lit(1)).alias("n")
    return df.where(F.col(col).isNotNull()).groupBy(*by, b).agg(agg)


def box_stats(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Five-number summary with 1.5 IQR fences, whisker ends and outlier
    count per group (exact quartiles, distributed)."""
    q = quantile_wide(df, col, [0.0, 0.25, 0.5, 0.75, 1.0], ["min", "q1", "median", "q3", "max"], by)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lo_fence", F.col("q1") - 1.5 * F.col("iqr")) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * F.col("iqr"))
    x = F.col(col)
    aggs = [F.count_if((x < F.col("lo_fence")) | (x > F.col("hi_fence"))).alias("n_outliers"),
            F.min(F.when(x >= F.col("lo_fence"), x)).alias("whisker_lo"),
            F.max(F.when(x <= F.col("hi_fence"), x)).alias("whisker_hi")]
    if by:
        joined = df.select(*by, col).join(q.select(*by, "lo_fence", "hi_fence"), on=list(by))
        return q.drop("lo_fence", "hi_fence").join(joined.groupBy(*by).agg(*aggs), on=list(by))
    cols = ["min", "q1", "median", "q3", "max", "iqr", "lo_fence", "hi_fence"]
    one = q.select(F.struct(*cols).alias("s")).scalar()  # one-row scalar subquery
    out = df.select(col, one.getField("lo_fence").alias("lo_fence"), one.getField("hi_fence").alias("hi_fence")) \
        .agg(*aggs)
    return out.select(*[one.getField(c).alias(c) for c in cols[:6]], "n_outliers", "whisker_lo", "whisker_hi")


def bin2d(df: DataFrame, x: str, y: str, wx: float, wy: float, value: str | None = None,
          min_count: int = 15) -> DataFrame:
    """Count (or mean of ``value``) per 2-D bin; the mean is suppressed
    (NULL) in bins with fewer than ``min_count`` rows."""
    g = df.groupBy((F.floor(F.col(x) / wx) * wx).alias("x_bin"), (F.floor(F.col(y) / wy) * wy).alias("y_bin"))
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.when(F.count(F.lit(1)) >= min_count, F.avg(value)).alias("mean_value"))
    return g.agg(*aggs)


def density_curve(df: DataFrame, col: str, grid: Sequence[float], bandwidth: float, by: Sequence[str] = ()) -> DataFrame:
    """Gaussian kernel density at grid points: every row contributes to every
    one (the grid is a short literal list), summed in the tasks first."""
    step, g0 = grid[1] - grid[0], grid[0]
    x = F.col(col)
    idx = F.explode(F.sequence(F.lit(0), F.lit(len(grid) - 1)))
    rows = df.where(x.isNotNull()).select(*by, x.alias("_x"), idx.alias("gi"))
    n = df.where(x.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    gx = F.lit(g0) + F.col("gi") * step
    k = F.exp(-0.5 * F.pow((gx - F.col("_x")) / bandwidth, 2)) / (bandwidth * math.sqrt(2 * math.pi))
    dens = rows.groupBy(*by, "gi").agg(F.sum(k).alias("_s"))
    dens = dens.join(n, on=list(by)) if by else dens.withColumn("_n", F.lit(n.select("_n").scalar()))
    return dens.select(*by, gx.alias("x"), (F.col("_s") / F.col("_n")).alias("density"))


def entropy_by(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Shannon entropy (bits) of each string's character distribution; an empty
    string has none.  Characters are counted per row before the shuffle, so a row
    sends as many counts as it has different characters, however long it is."""
    chars = F.explode(F.split(F.col(text), ""))
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col), F.col(text))
    counts = rows.select("_row", id_col, chars.alias("_c")).where(F.col("_c") != "") \
        .groupBy("_row", id_col, "_c").agg(F.count(F.lit(1)).cast("double").alias("_k"))
    # - sum of p log2 p over characters = log2 n - (sum of k log2 k) / n
    bits = F.log2(F.sum("_k")) - F.sum(F.col("_k") * F.log2("_k")) / F.sum("_k")
    return counts.groupBy("_row", id_col).agg(bits.alias("entropy")).drop("_row")


def matrix_margins(long: DataFrame, row: str, col: str, value: str) -> tuple[DataFrame, DataFrame]:
    """``rowMeans/rowSums/rowCounts`` and ``colMeans/colCounts`` of a sparse
    matrix held long; never densified."""
    rows = long.groupBy(row).agg(F.count(value).alias("n"), F.sum(value).alias("sum"), F.avg(value).alias("mean"))
    cols = long.groupBy(col).agg(F.count(value).alias("n"), F.sum(value).alias("sum"), F.avg(value).alias("mean"))
    return rows, cols


def array_position_stats(df: DataFrame, arr: str) -> DataFrame:
    """Per-position mean / sd of an array column (features held as arrays)."""
    e = df.select(F.posexplode(arr).alias("pos", "v"))
    return e.groupBy("pos").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd"))


def top_variance_positions(df: DataFrame, arr: str, k: int) -> DataFrame:
    """Positions (columns) with the ``k`` largest standard deviations."""
    return array_position_stats(df, arr).orderBy(F.col("sd").desc(), "pos").limit(k)


def qq_points(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """``qqnorm``: sample value vs normal quantile of its plotting position
    (i - a)/(n + 1 - 2a), a = 3/8 for n <= 10 else 1/2 (R ``ppoints``)."""
    from quarry.functions.distributions import norm_ppf
    from quarry.operators.relational import with_row_index
    n = df.where(F.col(col).isNotNull()).count()
    a = 0.375 if n <= 10 else 0.5
    ix = with_row_index(df.where(F.col(col).isNotNull()).select(id_col, col), [col, id_col], "i")
    p = (F.col("i") - a) / (n + 1 - 2 * a)
    return ix.select(id_col, F.col(col).alias("sample"), norm_ppf(p).alias("theoretical"))


def summarize_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``summary(df)``: min, quartiles, mean, max, NA count per column, long
    form (one row per column).  The columns are unpivoted once and all
    quartiles come from one grouped exact-quantile computation."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    q = quantile_wide(long, "value", [0.0, 0.25, 0.5, 0.75, 1.0], ["min", "q1", "median", "q3", "max"], ["column"])
    m = long.groupBy("column").agg(F.avg("value").alias("mean"), F.count_if(F.col("value").isNull()).alias("nulls"))
    return q.join(m, "column").select("column", "min", "q1", "median", "mean", "q3", "max", "nulls")


def profile_table(df: DataFrame, exact: bool = True) -> DataFrame:
    """``glimpse``/``str`` as a table: column, type, rows, nulls, distinct.
    One aggregation pass over all columns, then an unpivot.  ``exact=False``
    counts distinct values with HyperLogLog++ (no per-column expansion)."""
    fields = df.schema.fields
    distinct = F.count_distinct if exact else (lambda c: F.approx_count_distinct(c, 0.01))
    aggs = []
    for f in fields:
        aggs += [F.count(F.when(F.col(f.name).isNull(), 1)).alias(f"{f.name}__nulls"),
                 distinct(F.col(f.name)).alias(f"{f.name}__distinct")]
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    stack = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', `{f.name}__nulls`, `{f.name}__distinct`"
                      for f in fields)
    return wide.selectExpr(f"stack({len(fields)}, {stack}) as (column, type, nulls, n_distinct)", "__rows as n_rows")


__all__ = [n for n in dir() if not n.startswith("_")] + ["quantiles"]
