"""Window operators.

* Statistics over the whole table (z-score, min-max, offset from min) come
  from a one-row scalar subquery instead of an empty ``partitionBy``.
* Per-group statistics without an order (share of group, centring, group
  filters) are a map-side-combined aggregate joined back on the key, so a
  hot key is combined before the shuffle and the join can be split by AQE.
* Ordered per-group windows (row number, lag / lead, running sums) have a
  skew-safe form (``skew_safe=True``): rows are range-partitioned on
  (group, order) -- which splits a hot group across partitions -- and
  tagged with their partition; a window per (partition, group) gives local
  values and per-(partition, group) totals give the carry from earlier
  partitions.  This is the default; ``skew_safe=False`` gives the plain
  single Window (one task per group) for data known to have no hot key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quarry.functions.columns import col_of, join_null_safe
from quarry.session import cut_lineage

UNB = Window.unboundedPreceding

#: Rows of a group that one block of a moving window holds, edge copies aside.
BLOCK_ROWS = 1 << 14


def _w(by: Sequence[str], order: Sequence[str | Column] = ()):
    w = Window.partitionBy(*by)
    return w.orderBy(*[col_of(o) for o in order]) if order else w


def range_tagged(df: DataFrame, by: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition on (by + order) and tag rows with ``_pid``; the tags
    are materialised once (checkpoint) because range bounds are sampled."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = [F.col(c) for c in (*by, *order)]
    return cut_lineage(df.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()))


def running_sums(df: DataFrame, by: Sequence[str], order: Sequence[str], sums: dict[str, Column],
                 partitions: int | None = None, last: int = 0) -> DataFrame:
    """Skew-safe running sums (rows from the group's first row to the
    current one, in ``order``; give a unique tie-breaker in ``order``).
    ``last=-1`` leaves the current row out; the first row then has 0."""
    vals = {f"_v{i}": c for i, c in enumerate(sums.values())}
    t = range_tagged(df.withColumns(vals), by, order, partitions)
    local = Window.partitionBy("_pid", *by).orderBy(*order).rowsBetween(UNB, last)
    tot = t.groupBy("_pid", *by).agg(*[F.sum(v).alias(f"_t{v}") for v in vals])
    cw = Window.partitionBy(*by).orderBy("_pid").rowsBetween(UNB, -1)
    carry = tot.select("_pid", *by, *[F.coalesce(F.sum(f"_t{v}").over(cw), F.lit(0)).alias(f"_c{v}") for v in vals])
    here = (lambda c: c) if last == 0 else (lambda c: F.coalesce(c, F.lit(0)))
    out = t.withColumns({f"_l{v}": here(F.sum(v).over(local)) for v in vals})
    out = join_null_safe(out, carry, ["_pid", *by])
    return out.withColumns({name: F.col(f"_l{v}") + F.col(f"_c{v}") for name, v in zip(sums, vals)}) \
        .drop("_pid", *vals, *[f"_l{v}" for v in vals], *[f"_c{v}" for v in vals])


def shifted(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, k: int, name: str) -> DataFrame:
    """Skew-safe lag (k > 0) / lead (k < 0): the value ``k`` rows earlier in
    the group, by an equi-join on (group, position) -- positions of a hot
    group are distinct, so the join spreads it."""
    p = running_sums(df, by, order, {"_pos": F.lit(1)})
    prev = p.select(*by, (F.col("_pos") + k).alias("_pos"), F.col(col).alias(name))
    return join_null_safe(p, prev, [*by, "_pos"], "left")


def row_number_in_group(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str = "rn",
                        skew_safe: bool = True) -> DataFrame:
    if skew_safe:
        return running_sums(df, by, order, {name: F.lit(1)}).withColumn(name, F.col(name).cast("int"))
    return df.withColumn(name, F.row_number().over(_w(by, order)))


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], n: int,
                    ties: bool = False, name: str = "rank") -> DataFrame:
    """First ``n`` rows per group; ``ties=True`` keeps ties (``rank``).
    Planned as ``WindowGroupLimit`` so each partition keeps only n rows
    per group before the final window."""
    fn = F.rank() if ties else F.row_number()
    return df.withColumn(name, fn.over(_w(by, order))).where(F.col(name) <= n)


def rank_average_ties(df: DataFrame, by: Sequence[str], value: str, descending: bool = True,
                      name: str = "rank", skew_safe: bool = True) -> DataFrame:
    """R ``rank(-x)``: tied values share the average of their positions.
    ``skew_safe``: positions from the range-partitioned running count, the
    average over each (group, value) tie block by aggregate + join."""
    if skew_safe:
        d = df.withColumn("_o", -F.col(value) if descending else F.col(value)) \
            .withColumn("_id", F.monotonically_increasing_id())
        p = running_sums(cut_lineage(d), list(by), ["_o", "_id"], {"_p": F.lit(1)})
        blk = p.groupBy(*by, "_o").agg(((F.min("_p") + F.max("_p")) / 2.0).alias(name))
        return join_null_safe(p, blk, [*by, "_o"]).drop("_o", "_id", "_p")
    o = F.col(value).desc() if descending else F.col(value).asc()
    tie = Window.partitionBy(*by, value)
    return df.withColumn(name, F.rank().over(_w(by, [o])) + (F.count(F.lit(1)).over(tie) - 1) / 2.0)


def top_n_with_ties(df: DataFrame, n: int, value: str, by: Sequence[str] = (), name: str = "_rk") -> DataFrame:
    """dplyr ``top_n(n, x)``: largest n (ties kept); negative n = smallest.
    Ungrouped, it is a top-k: a bounded sort then ``rank`` over <= k+ties rows."""
    o = F.col(value).desc() if n > 0 else F.col(value).asc()
    k = abs(n)
    if by:
        return df.withColumn(name, F.rank().over(_w(by, [o]))).where(F.col(name) <= k).drop(name)
    # the k-th value is found with a bounded top-k; every row tied with it is kept
    kth = df.where(F.col(value).isNotNull()).orderBy(o).limit(k).agg(
        (F.min(value) if n > 0 else F.max(value)).alias("t")).scalar()
    return df.where(F.col(value) >= kth if n > 0 else F.col(value) <= kth)


def lead_pairs(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], col: str,
               sep: str = " ", name: str = "pair", skew_safe: bool = True) -> DataFrame:
    """``paste(x, lead(x))`` within a partition (the partition replaces the
    'same song' guard)."""
    if skew_safe:
        s = shifted(df, by, order, col, -1, "_next")
        return s.withColumn(name, F.when(F.col("_next").isNotNull(), F.concat_ws(sep, F.col(col), F.col("_next")))) \
            .drop("_next", "_pos")
    nxt = F.lead(col).over(_w(by, order))
    return df.withColumn(name, F.when(nxt.isNotNull(), F.concat_ws(sep, F.col(col), nxt)))


def lag_diff(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], col: str, name: str = "diff",
             lag: int = 1, skew_safe: bool = True) -> DataFrame:
    if skew_safe:
        s = shifted(df, by, order, col, lag, "_prev")
        return s.withColumn(name, F.col(col) - F.col("_prev")).drop("_prev", "_pos")
    return df.withColumn(name, F.col(col) - F.lag(col, lag).over(_w(by, order)))


def cumulative(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], col: str | Column,
               name: str = "cum", fn=F.sum, skew_safe: bool = True) -> DataFrame:
    """Running aggregate from the first row of the partition (skew-safe for
    sums)."""
    if skew_safe and fn is F.sum:
        return running_sums(df, by, order, {name: col_of(col)})
    return df.withColumn(name, fn(col_of(col)).over(_w(by, order).rowsBetween(UNB, 0)))


def cumprod(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], col: str, name: str = "cumprod",
            skew_safe: bool = True) -> DataFrame:
    """Running product of positive values: exp(running sum of ln x)."""
    if skew_safe:
        return running_sums(df, by, order, {name: F.ln(col)}).withColumn(name, F.exp(name))
    return df.withColumn(name, F.exp(F.sum(F.ln(col)).over(_w(by, order).rowsBetween(UNB, 0))))


def _join_group_stats(df: DataFrame, by: Sequence[str], aggs: list[Column]) -> DataFrame:
    """Per-group aggregates (partial aggregation before the shuffle) joined
    back on the key."""
    return join_null_safe(df, df.groupBy(*by).agg(*aggs), list(by))


def share_of_group(df: DataFrame, by: Sequence[str], col: str, name: str = "share") -> DataFrame:
    g = _join_group_stats(df, by, [F.sum(col).alias("_tot")])
    return g.withColumn(name, F.try_divide(F.col(col), F.col("_tot"))).drop("_tot")


def share_of_total(df: DataFrame, col: str, name: str = "share") -> DataFrame:
    tot = df.agg(F.sum(col)).scalar()
    return df.withColumn(name, F.try_divide(F.col(col), tot))


def group_filter(df: DataFrame, by: Sequence[str], stat: Column, keep) -> DataFrame:
    """``group_by(g) %>% filter(stat >= k)``: groups whose aggregate ``stat``
    satisfies ``keep`` (a Column -> boolean Column), by a semi join."""
    ok = df.groupBy(*by).agg(stat.alias("_stat")).where(keep(F.col("_stat"))).select(*by)
    return join_null_safe(df, ok, list(by), "left_semi")


def zscore(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), suffix: str = "_z") -> DataFrame:
    """``scale(x)``: (x - mean) / sd (n-1).  Grouped: window per group;
    global: one-row scalar subquery of all means and sds."""
    if by:
        g = _join_group_stats(df, by, [F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)]
                              + [F.stddev_samp(c).alias(f"_s{i}") for i, c in enumerate(cols)])
        return g.withColumns({f"{c}{suffix}": F.try_divide(F.col(c) - F.col(f"_m{i}"), F.col(f"_s{i}"))
                              for i, c in enumerate(cols)}) \
            .drop(*[f"_m{i}" for i in range(len(cols))], *[f"_s{i}" for i in range(len(cols))])
    st = df.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                         *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(cols)])).scalar()
    return df.withColumns({f"{c}{suffix}": F.try_divide(F.col(c) - st.getField(f"m{i}"), st.getField(f"s{i}"))
                           for i, c in enumerate(cols)})


def minmax_scale(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), suffix: str = "_mm") -> DataFrame:
    if by:
        g = _join_group_stats(df, by, [F.min(c).alias(f"_lo{i}") for i, c in enumerate(cols)]
                              + [F.max(c).alias(f"_hi{i}") for i, c in enumerate(cols)])
        return g.withColumns({f"{c}{suffix}": F.try_divide(F.col(c) - F.col(f"_lo{i}"), F.col(f"_hi{i}") - F.col(f"_lo{i}"))
                              for i, c in enumerate(cols)}) \
            .drop(*[f"_lo{i}" for i in range(len(cols))], *[f"_hi{i}" for i in range(len(cols))])
    st = df.agg(F.struct(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
                         *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)])).scalar()
    return df.withColumns({f"{c}{suffix}": F.try_divide(F.col(c) - st.getField(f"lo{i}"),
                                                        st.getField(f"hi{i}") - st.getField(f"lo{i}")) for i, c in enumerate(cols)})


def center_by_group(df: DataFrame, by: Sequence[str], col: str, name: str = "centered") -> DataFrame:
    g = _join_group_stats(df, by, [F.avg(col).alias("_m")])
    return g.withColumn(name, F.col(col) - F.col("_m")).drop("_m")


def offset_from_min(df: DataFrame, col: str, name: str = "offset", by: Sequence[str] = ()) -> DataFrame:
    if by:
        g = _join_group_stats(df, by, [F.min(col).alias("_lo")])
        return g.withColumn(name, F.col(col) - F.col("_lo")).drop("_lo")
    return df.withColumn(name, F.col(col) - df.agg(F.min(col)).scalar())


def over_halo(df: DataFrame, by: Sequence[str], pos: str, back: int, ahead: int,
              columns: Callable[[WindowSpec], dict[str, Column]], block: int = BLOCK_ROWS) -> DataFrame:
    """Columns over moving windows that reach ``back`` rows before and ``ahead``
    rows after a row, whatever the size of its group.

    ``pos`` numbers the rows of a group 1, 2, ... without gaps.  Rows are cut into
    blocks of equal length by it, and a block also gets the last ``back`` rows of
    the one before and the first ``ahead`` rows of the one after; a block is never
    shorter than either, so its neighbours hold all it needs.  ``columns`` gets a
    window over a block in the order of ``pos``."""
    size = max(block, back, ahead, 1)
    blk, at = F.expr(f"(`{pos}` - 1) div {size}"), F.expr(f"(`{pos}` - 1) % {size}")
    homes = F.array(F.struct(blk.alias("blk"), F.lit(True).alias("own")),
                    F.when(at >= size - back, F.struct((blk + 1).alias("blk"), F.lit(False).alias("own"))),
                    F.when((at < ahead) & (blk > 0), F.struct((blk - 1).alias("blk"), F.lit(False).alias("own"))))
    h = df.withColumn("_h", F.explode(F.array_compact(homes))).withColumns({"_blk": F.col("_h.blk"), "_own": F.col("_h.own")})
    return h.withColumns(columns(Window.partitionBy(*by, "_blk").orderBy(pos))).where("_own").drop("_h", "_blk", "_own")


def _moving(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], back: int, ahead: int,
            columns: Callable[[WindowSpec], dict[str, Column]], skew_safe: bool, block: int) -> DataFrame:
    if not skew_safe:
        return df.withColumns(columns(_w(by, order)))
    return over_halo(running_sums(df, by, order, {"_at": F.lit(1)}), by, "_at", back, ahead, columns, block).drop("_at")


def expanding_mean(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], col: str,
                   name: str = "expanding_mean", min_rows: int = 3, skew_safe: bool = True) -> DataFrame:
    """Mean of all earlier rows (``stretch_tsibble``), NULL until ``min_rows``
    earlier rows with a value exist."""
    if skew_safe:
        sums = {"_es": F.coalesce(F.col(col), F.lit(0)), "_en": F.col(col).isNotNull().cast("long")}
        s = running_sums(df, by, order, sums, last=-1)
        return s.withColumn(name, F.when(F.col("_en") >= min_rows, F.try_divide("_es", "_en"))).drop("_es", "_en")
    w = _w(by, order).rowsBetween(UNB, -1)
    return df.withColumn(name, F.when(F.count(col).over(w) >= min_rows, F.avg(col).over(w)))


def rolling_columns(col: str, size: int, name: str) -> Callable[[WindowSpec], dict[str, Column]]:
    def columns(w: WindowSpec) -> dict[str, Column]:
        w = w.rowsBetween(0, size - 1)
        return {name: F.when(F.count(col).over(w) == size, F.sum(col).over(w))}
    return columns


def rolling_sum(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], col: str, size: int,
                name: str = "rolling_sum", skew_safe: bool = True, block: int = BLOCK_ROWS) -> DataFrame:
    """Sum of this and the next ``size-1`` rows; NULL where fewer remain."""
    return _moving(df, by, order, 0, size - 1, rolling_columns(col, size, name), skew_safe, block)


def centered_ma(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], col: str, period: int,
                name: str = "trend", skew_safe: bool = True, block: int = BLOCK_ROWS) -> DataFrame:
    """Classical-decomposition centred moving average: for even period m a
    2 x m MA (half weights on the two ends), for odd m a plain m-MA."""
    h = period // 2

    def columns(w: WindowSpec) -> dict[str, Column]:
        full = w.rowsBetween(-h, h)
        n = F.count(col).over(full)
        if period % 2 == 1:
            return {name: F.when(n == period, F.avg(col).over(full))}
        s = F.sum(col).over(full) - 0.5 * F.lag(col, h).over(w) - 0.5 * F.lead(col, h).over(w)
        return {name: F.when(n == 2 * h + 1, s / period)}
    return _moving(df, by, order, h, h, columns, skew_safe, block)
