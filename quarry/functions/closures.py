"""User-defined functions as closures over Columns and DataFrames.

R passes closures to verbs; here a scalar closure is a Python function
Column -> Column (stays in the JVM, no row-at-a-time UDF), an aggregate
closure builds from aggregate Columns, and a table-returning closure per
group is decomposed into partial results per Arrow batch (``mapInPandas``,
numpy inside the task) that Spark combines with a grouped sum -- so no
group, however large, has to fit in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rescale(lo: float, hi: float) -> Callable[[Column], Column]:
    """Closure factory: linear map of [lo, hi] onto [0, 1]."""
    def f(c: Column) -> Column:
        return (c - F.lit(lo)) / F.lit(hi - lo)
    return f


def guarded_mean(min_n: int) -> Callable[[Column], Column]:
    """Aggregate closure: mean only where the group has ``min_n`` rows."""
    def f(c: Column) -> Column:
        return F.when(F.count(c) >= min_n, F.avg(c))
    return f


def group_table_closure(df: DataFrame, by: Sequence[str], partial: Callable[[pd.DataFrame], pd.DataFrame],
                        partial_schema: str, finalize: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Table-returning closure per group, decomposed: ``partial`` maps one
    Arrow batch (any rows of any groups) to additive statistics keyed by
    ``by``; Spark sums them per group; ``finalize`` turns the sums into
    the result with Column expressions."""
    from quarry.session import ship_package
    ship_package(df.sparkSession)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield partial(pdf)
    parts = df.mapInPandas(run, partial_schema)
    stats = [c for c in parts.columns if c not in by]
    sums = parts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in stats])
    return finalize(sums)


def ols_partial(by: Sequence[str], y: str, x: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Partial sums for y ~ x per group inside one batch (pandas)."""
    def f(pdf: pd.DataFrame) -> pd.DataFrame:
        d = pdf[list(by) + [x, y]].dropna()
        d = d.assign(_xx=d[x] * d[x], _xy=d[x] * d[y], _n=1.0)
        g = d.groupby(list(by), as_index=False).agg(n=("_n", "sum"), sx=(x, "sum"), sy=(y, "sum"), sxx=("_xx", "sum"),
                                                    sxy=("_xy", "sum"))
        return g
    return f


def ols_finalize(sums: DataFrame) -> DataFrame:
    n, sx, sy, sxx, sxy = (F.col(c) for c in ("n", "sx", "sy", "sxx", "sxy"))
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    return sums.withColumn("slope", slope).withColumn("intercept", (sy - F.col("slope") * sx) / n)


def table_function(fn: Callable[..., DataFrame], *args, **kwargs) -> Callable[[DataFrame], DataFrame]:
    """Parameterised table function for ``DataFrame.transform``."""
    def apply(df: DataFrame) -> DataFrame:
        return fn(df, *args, **kwargs)
    return apply
