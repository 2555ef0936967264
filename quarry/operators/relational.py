"""Projection, filtering, missing values, recoding, sampling.

Each operator is DataFrame in, DataFrame out and is expressed with built-in
expressions so that Catalyst can prune columns and push filters into the
scan.  Global statistics (median, percentile thresholds) enter as one-row
scalar subqueries, never through a one-partition window or a cross join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.columns import col_of, join_null_safe
from quarry.session import cut_lineage
from quarry.operators.quantiles import quantile_wide

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# ---------------------------------------------------------------- projection
def select_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


def select_drop(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def select_range(df: DataFrame, start: str | int, end: str | int | None = None,
                 extra: Sequence[int | str] = ()) -> DataFrame:
    """``select(a:b)`` by name or 1-based position, plus single extra picks."""
    names = df.columns

    def pos(x):
        return names.index(x) if isinstance(x, str) else x - 1
    lo = pos(start)
    hi = pos(end) if end is not None else lo
    picked = names[lo:hi + 1] + [names[pos(x)] for x in extra]
    return df.select(*picked)


def select_by_type(df: DataFrame, kinds: tuple = NUMERIC) -> DataFrame:
    """``select_if(is.numeric)``: keep columns whose type is one of ``kinds``."""
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, kinds)])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``rename(new = old)``: mapping is old -> new."""
    return df.withColumnsRenamed(dict(mapping))


def lowercase_columns(df: DataFrame) -> DataFrame:
    """``rename_all(tolower)``."""
    return df.toDF(*[c.lower() for c in df.columns])


def transmute(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    return df.select(*[e.alias(n) for n, e in exprs.items()])


def derive(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """``mutate``: add or replace columns in one projection."""
    return df.withColumns(dict(exprs))


def map_columns(df: DataFrame, fn: Callable[[Column], Column], cols: Iterable[str] | None = None,
                predicate: Callable[[T.StructField], bool] | None = None) -> DataFrame:
    """``mutate_at`` / ``mutate_if``: apply ``fn`` to chosen columns in place."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if predicate is None or predicate(f)]
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def cast_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``as.numeric`` etc.  ``try_cast`` so malformed text becomes NULL as in
    R (ANSI mode would raise)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


# ------------------------------------------------------------------- filters
def filter_all(df: DataFrame, *preds: Column) -> DataFrame:
    """``filter(p1, p2, ...)``: conjunction (pushed into the scan)."""
    cond = preds[0]
    for p in preds[1:]:
        cond = cond & p
    return df.where(cond)


def filter_in(df: DataFrame, col: str, values: Sequence[Any], negate: bool = False) -> DataFrame:
    """``x %in% values`` / ``!x %in% values``.  R's ``%in%`` is never NA, so a
    NULL ``x`` is kept by the negated form (SQL ``NOT IN`` would drop it)."""
    hit = F.coalesce(F.col(col).isin(list(values)), F.lit(False))
    return df.where(~hit if negate else hit)


def filter_not_in_table(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """``!x %in% other$x`` for a table-sized list: an anti join."""
    return df.join(other.select(*([on] if isinstance(on, str) else on)).distinct(), on=on, how="left_anti")


def filter_between(df: DataFrame, col: str, lo: Any, hi: Any) -> DataFrame:
    return df.where(F.col(col).between(lo, hi))


def filter_regex(df: DataFrame, col: str, pattern: str, negate: bool = False) -> DataFrame:
    hit = F.col(col).rlike(pattern)
    return df.where(~hit if negate else hit)


def filter_date_range(df: DataFrame, col: str, start: str | None = None, end: str | None = None,
                      inclusive_end: bool = True) -> DataFrame:
    """xts ``"a/b"`` range (both ends inclusive) or half-open ``[a, b)``."""
    c = F.col(col)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        e = F.lit(end).cast("timestamp_ntz")
        cond = cond & ((c <= e) if inclusive_end else (c < e))
    return df.where(cond)


def filter_quantile_threshold(df: DataFrame, col: str, prob: float, strict: bool = True) -> DataFrame:
    """Keep rows whose ``col`` exceeds its ``prob`` quantile.  The threshold
    is an exact distributed quantile applied as a scalar subquery."""
    thr = quantile_wide(df, col, [prob], ["thr"]).scalar()
    return df.where(F.col(col) > thr if strict else F.col(col) >= thr)


def with_row_index(df: DataFrame, order_by: Sequence[str], name: str = "row_idx",
                   partitions: int | None = None, prefix_counts: Mapping[str, Column] | None = None) -> DataFrame:
    """1-based position under ``order_by`` without a one-partition window.

    Rows are range-partitioned and sorted (distributed); the id from
    ``monotonically_increasing_id`` carries the partition number in its
    upper bits and the row's place in the partition in the lower 33 bits.
    Per-partition counts (one row per partition: a proven bound) give the
    offsets, which are broadcast back.  The tagged rows are checkpointed
    once (shared folder) so counts and positions come from the same
    materialisation -- range bounds are sampled and may differ between two
    recomputations.

    ``prefix_counts`` ({name: boolean column}) adds, per row, how many rows
    up to and including it satisfy each flag (a window per partition plus
    the same per-partition offsets)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = [F.col(c) for c in order_by]
    flags = dict(prefix_counts or {})
    s = (df.withColumns({f"_f_{k}": c.cast("long") for k, c in flags.items()})
         .repartitionByRange(n, *keys).sortWithinPartitions(*keys)
         .withColumn("_mid", F.monotonically_increasing_id())
         .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
         .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    s = cut_lineage(s)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"), *[F.sum(f"_f_{k}").alias(f"_c_{k}") for k in flags])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                         *[F.coalesce(F.sum(f"_c_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in flags])
    out = s.join(F.broadcast(offs), on="_pid").withColumn(name, F.col("_off") + F.col("_loc") + 1)
    if flags:
        local = Window.partitionBy("_pid").orderBy("_loc").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumns({k: F.col(f"_o_{k}") + F.sum(f"_f_{k}").over(local) for k in flags})
    return out.drop("_mid", "_pid", "_loc", "_off", *[f"_f_{k}" for k in flags], *[f"_o_{k}" for k in flags])


def filter_positions(df: DataFrame, order_by: Sequence[str], keep: Callable[[Column], Column]) -> DataFrame:
    """Positional mask (``x[-1]``, ``which``) under an explicit order."""
    return with_row_index(df, order_by, "_pos").where(keep(F.col("_pos"))).drop("_pos")


# ------------------------------------------------------------ missing values
def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``na.omit``: drop rows with a NULL in any (chosen) column."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def sentinel_to_null(df: DataFrame, col: str, sentinel: Any) -> DataFrame:
    """``na_if(x, -999)``."""
    return df.withColumn(col, F.nullif(F.col(col), F.lit(sentinel)))


def coalesce_missing(df: DataFrame, col: str, fallback: Column | Any) -> DataFrame:
    fb = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return df.withColumn(col, F.coalesce(F.col(col), fb))


def impute_median(df: DataFrame, col: str) -> DataFrame:
    """Missing -> column median (exact, distributed; applied as a scalar)."""
    med = quantile_wide(df, col, [0.5], ["m"]).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), med))


# ----------------------------------------------------------------- recoding
def case_when(branches: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """``case_when``: first matching branch wins, ``default`` otherwise."""
    expr = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return expr.otherwise(d) if default is not None else expr


def recode_levels(df: DataFrame, col: str, mapping: Mapping[str, str], out: str | None = None,
                  order: Sequence[str] | None = None, keep_unmatched: bool = True) -> DataFrame:
    """``recode`` / ``factor(levels, labels)``.  With ``order`` the result is
    an ordered factor: an extra ``<out>_level`` integer sort key (1-based)."""
    out = out or col
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    val = F.element_at(m, F.col(col))
    if keep_unmatched:
        val = F.coalesce(val, F.col(col))
    res = df.withColumn(out, val)
    if order:
        lv = F.create_map(*[x for i, lab in enumerate(order) for x in (F.lit(lab), F.lit(i + 1))])
        res = res.withColumn(f"{out}_level", F.element_at(lv, F.col(out)))
    return res


def reorder_levels(df: DataFrame, col: str, stat: Column, name: str = "level_order",
                   descending: bool = False) -> DataFrame:
    """``reorder(f, x)``: order categories by a per-category statistic.
    The statistic is aggregated per level (map-side combined) and the dense
    rank over the small level table is joined back."""
    levels = df.groupBy(col).agg(stat.alias("_stat"))
    o = F.col("_stat").desc() if descending else F.col("_stat").asc()
    ranked = levels.withColumn(name, F.dense_rank().over(Window.orderBy(o, F.col(col))))
    return df.join(ranked.select(col, "_stat", name), on=col, how="left")


def distinct_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset)) if subset else df.distinct()


# ------------------------------------------------------------------ sampling
def hash_order(cols: Sequence[str], seed: int) -> Column:
    """Deterministic pseudo-random order key (repeatable across runs and
    executor loss, unlike ``rand``)."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])


def sample_n_per_group(df: DataFrame, by: Sequence[str], n: int, id_cols: Sequence[str], seed: int = 42,
                       key: Column | None = None) -> DataFrame:
    """``group_by(g) %>% sample_n(n)`` without replacement, repeatable.
    ``key`` overrides the pseudo-random order (default xxhash64 of ids).
    Planned as a group limit, so each map task keeps n rows per group."""
    k = key if key is not None else hash_order(id_cols, seed)
    w = Window.partitionBy(*by).orderBy(k, *[F.col(c) for c in id_cols])
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def random_split(df: DataFrame, weights: Sequence[float], id_cols: Sequence[str], seed: int = 42,
                 name: str = "split", uniform: Column | None = None) -> DataFrame:
    """Repeatable split: a hash value in [0,1) assigned to consecutive
    weight intervals; returns the table with a ``split`` index column.
    ``uniform`` overrides the default xxhash64-based value."""
    tot = float(sum(weights))
    u = uniform if uniform is not None else (F.pmod(hash_order(id_cols, seed), F.lit(1_000_000)).cast("double") / 1_000_000)
    acc, expr = 0.0, None
    for i, w in enumerate(weights[:-1]):
        acc += w / tot
        expr = F.when(u < acc, i) if expr is None else expr.when(u < acc, i)
    expr = F.lit(len(weights) - 1) if expr is None else expr.otherwise(len(weights) - 1)
    return df.withColumn(name, expr)


def stratified_split(df: DataFrame, strata: str, frac: float, id_cols: Sequence[str], seed: int = 42,
                     name: str = "is_train", key: Column | None = None) -> DataFrame:
    """``createDataPartition(y, p)``: exactly ceil(p*n_s) training rows per
    stratum, chosen by hash order (the share is exact, not Bernoulli).
    Positions inside a stratum come from the skew-safe running count (a
    stratum is typically a huge group)."""
    from quarry.operators.windows import running_sums
    d = df.withColumn("_h", key if key is not None else hash_order(id_cols, seed))
    pos = running_sums(d, [strata], ["_h", *id_cols], {"_r": F.lit(1)})
    n = d.groupBy(strata).agg(F.count(F.lit(1)).alias("_n"))
    return join_null_safe(pos, n, [strata]).withColumn(name, F.col("_r") <= F.ceil(F.col("_n") * frac)) \
        .drop("_r", "_n", "_h")


def sample_background(presence: DataFrame, background: DataFrame, by: str, ratio: int,
                      id_cols: Sequence[str], seed: int = 42, label: str = "pseudo_absence",
                      key: Column | None = None) -> DataFrame:
    """Per group draw ``ratio`` x (presence count) background rows (hash
    order, without replacement) and stack them under the presences.  The
    draw position inside a group is a skew-safe running count."""
    from quarry.operators.windows import running_sums
    need = presence.groupBy(by).agg((F.count(F.lit(1)) * ratio).alias("_need"))
    b = background.join(need, on=by).withColumn("_h", key if key is not None else hash_order(id_cols, seed))
    bg = running_sums(b, [by], ["_h", *id_cols], {"_r": F.lit(1)}) \
        .where(F.col("_r") <= F.col("_need")).drop("_r", "_need", "_h").withColumn("kind", F.lit(label))
    return presence.withColumn("kind", F.lit("presence")).unionByName(bg)


# --------------------------------------------------------- sort and slicing
def sort_rows(df: DataFrame, *keys: str | Column, descending: Sequence[bool] | None = None) -> DataFrame:
    """``arrange``: R places NA last in both directions."""
    desc = descending or [False] * len(keys)
    order = [(col_of(k).desc_nulls_last() if d else col_of(k).asc_nulls_last()) for k, d in zip(keys, desc)]
    return df.orderBy(*order)


def head_rows(df: DataFrame, n: int, *keys: str | Column) -> DataFrame:
    """``head(n)`` under an explicit order (TakeOrderedAndProject)."""
    return df.orderBy(*[col_of(k).asc_nulls_last() for k in keys]).limit(n)


def tail_rows(df: DataFrame, n: int, *keys: str | Column) -> DataFrame:
    """``tail(n)``: reverse order, limit, then restore the order."""
    last = df.orderBy(*[col_of(k).desc_nulls_first() for k in keys]).limit(n)
    return last.orderBy(*[col_of(k).asc_nulls_last() for k in keys])


def row_range(df: DataFrame, first: int, last: int, *keys: str | Column) -> DataFrame:
    """``x[first:last, ]`` (1-based, inclusive) under an explicit order."""
    return df.orderBy(*[col_of(k).asc_nulls_last() for k in keys]).offset(first - 1).limit(last - first + 1)
