"""Join operators.

Equi-joins are left to Catalyst / AQE (broadcast under the runtime size
threshold, otherwise sort-merge, skew splitting on).  Range-type joins
(interval containment, radius) are turned into equi-joins on coarse buckets
plus an exact filter, so they never become nested-loop joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.dates import ntz_epoch_seconds


def join_by(left: DataFrame, right: DataFrame, by: Sequence[str] | Mapping[str, str] | None = None,
            how: str = "inner") -> DataFrame:
    """dplyr ``*_join``.  ``by=None`` is a natural join on all common names;
    a mapping joins differently named keys (left -> right) and keeps the
    left key only."""
    if by is None:
        by = sorted(set(left.columns) & set(right.columns))
    if isinstance(by, Mapping):
        r = right.withColumnsRenamed({rk: lk for lk, rk in by.items()})
        return left.join(r, on=list(by.keys()), how=how)
    return left.join(right, on=list(by), how=how)


def join_natural(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    return join_by(left, right, None, how)


def merge_base(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """base ``merge(x, y, by)``: inner, result sorted by the key."""
    return left.join(right, on=list(by), how="inner").orderBy(*by)


def align_series(frames: Mapping[str, DataFrame], on: str) -> DataFrame:
    """``merge.xts``: outer-align several (on, value) series; each value
    column is renamed to its series name."""
    out = None
    for name, f in frames.items():
        v = [c for c in f.columns if c != on]
        g = f.select(on, F.col(v[0]).alias(name))
        out = g if out is None else out.join(g, on=on, how="full")
    return out


def interval_point_join(points: DataFrame, ts: str, intervals: DataFrame, start: str, end: str,
                        bucket: str = "1 hour", how: str = "left",
                        keys: Mapping[str, str] | None = None) -> DataFrame:
    """Attach to each point the interval(s) [start, end] (closed) holding it.

    Each interval is exploded to the coarse time buckets it touches, points
    get their bucket, the join is an equi-join on the bucket with the exact
    bounds as a residual filter.  Work is O(points + intervals x buckets
    spanned), never points x intervals.  ``keys`` adds equality keys
    (point column -> interval column), e.g. the same user."""
    unit_s = {"1 minute": 60, "10 minutes": 600, "1 hour": 3600, "1 day": 86400}[bucket]
    def sec(c):
        return ntz_epoch_seconds(c)
    ib = intervals.withColumn("_b", F.explode(F.sequence(F.floor(sec(start) / unit_s).cast("long"),
                                                         F.floor(sec(end) / unit_s).cast("long"))))
    pb = points.withColumn("_b", F.floor(sec(ts) / unit_s).cast("long"))
    cond = [pb["_b"] == ib["_b"], pb[ts] >= ib[start], pb[ts] <= ib[end]]
    cond += [pb[a] == ib[b] for a, b in (keys or {}).items()]
    return pb.join(ib, cond, how).drop(pb["_b"]).drop(ib["_b"])


def filter_within_any(df: DataFrame, ts: str, intervals: Sequence[tuple[Any, Any]]) -> DataFrame:
    """``d %within% v1 | ... | vk`` for a short literal interval list."""
    cond = None
    for a, b in intervals:
        c = F.col(ts).between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz"))
        cond = c if cond is None else cond | c
    return df.where(cond)


def expand_grid(df: DataFrame, grid: Mapping[str, Sequence[Any]]) -> DataFrame:
    """``expand.grid``: every row combined with every parameter value.  The
    grid is a literal list exploded per row (work = rows x grid size)."""
    out = df
    for name, values in grid.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def compare_to_baseline(stats: DataFrame, key: str, baseline: Any, cols: Sequence[str],
                        suffix: str = "_vs_base") -> DataFrame:
    """Compare every group's statistics with one baseline group's: the
    baseline row enters as a one-row scalar subquery (no cross join)."""
    base = stats.where(F.col(key) == F.lit(baseline)).select(F.struct(*cols).alias("b")).scalar()
    return stats.withColumns({f"{c}{suffix}": F.col(c) - base.getField(c) for c in cols})


def grid_cell_join(points: DataFrame, x: str, y: str, cells: DataFrame, cx: str, cy: str, res: float,
                   how: str = "left") -> DataFrame:
    """Raster value at a point: the point's cell index floor(x/res),
    floor(y/res) equi-joined to the cell table."""
    p = points.withColumns({"_cx": F.floor(F.col(x) / res), "_cy": F.floor(F.col(y) / res)})
    c = cells.withColumnsRenamed({cx: "_cx", cy: "_cy"})
    return p.join(c, on=["_cx", "_cy"], how=how)


def key_audit(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Anti joins both ways: keys present on one side only."""
    lk, rk = left.select(*on).distinct(), right.select(*on).distinct()
    return (lk.join(rk, on=list(on), how="left_anti").withColumn("side", F.lit("left_only"))
            .unionByName(rk.join(lk, on=list(on), how="left_anti").withColumn("side", F.lit("right_only"))))


def add_condition(df: DataFrame, cond: Column) -> DataFrame:
    return df.where(cond)
