"""Time-series operators.

A series is a (key..., t, value) table.  Calendar aggregation shrinks raw
rows to one row per period first (map-side combined), so the per-series
windows below run over a table bounded by the number of periods, never by
the raw row count.  Windows are partitioned by the series key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.quantiles import quantile_wide
from quarry.operators.relational import with_row_index
from quarry.operators.scans import decayed_sums, holt_fits
from quarry.operators.windows import BLOCK_ROWS, centered_ma, expanding_mean, over_halo, running_sums


def _w(by, t):
    return Window.partitionBy(*by).orderBy(t)


def resample(df: DataFrame, ts: str, value: str, unit: str, by: Sequence[str] = (), fn=F.avg,
             name: str = "value") -> DataFrame:
    """Floor timestamps to ``unit`` and aggregate (period mean by default)."""
    return df.groupBy(*by, F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("period")).agg(fn(value).alias(name))


def log_returns(series: DataFrame, t: str, price: str, by: Sequence[str] = ()) -> DataFrame:
    """r_t = ln p_t - ln p_{t-1}; discrete return exp(r) - 1."""
    lp = F.ln(F.col(price))
    r = lp - F.lag(lp).over(_w(by, t))
    return series.withColumn("log_return", r).withColumn("simple_return", F.exp("log_return") - 1)


def period_sums(df: DataFrame, t: str, value: str, units: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sums of (log) returns per week / month / quarter / year."""
    parts = [df.groupBy(*by, F.lit(u).alias("unit"), F.date_trunc(u, F.col(t)).cast("date").alias("period"))
             .agg(F.sum(value).alias("total")) for u in units]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def var_es_parametric(df: DataFrame, r: str, alpha: float = 0.05) -> DataFrame:
    """Normal VaR = mu + sigma z_alpha and ES = mu - sigma phi(z_alpha)/alpha.
    z_alpha depends on the parameter only, so it is computed exactly once
    (standard library) and enters as a literal."""
    from statistics import NormalDist
    z = NormalDist().inv_cdf(alpha)
    phi = NormalDist().pdf(z)
    m = df.agg(F.avg(r).alias("mu"), F.stddev_samp(r).alias("sigma"))
    return m.select("mu", "sigma", (F.col("mu") + F.col("sigma") * z).alias("var"),
                    (F.col("mu") - F.col("sigma") * phi / alpha).alias("es"))


def var_es_empirical(df: DataFrame, r: str, alpha: float = 0.05) -> DataFrame:
    """Empirical VaR = alpha quantile (type 7, exact) and ES = mean of the
    returns at or below it."""
    q = quantile_wide(df, r, [alpha], ["var"])
    v = q.select("var").scalar()
    return df.where(F.col(r) <= v).agg(F.avg(r).alias("es")).select(v.alias("var"), "es")


def autocorrelation(series: DataFrame, t: str, x: str, max_lag: int) -> DataFrame:
    """acf(x): sum (x_t - m)(x_{t-k} - m) / sum (x_t - m)^2 for k = 1..K.

    Positions come from the distributed row index; the lagged copy is a
    key shift (pos + k) joined on position, so no single-partition window
    over the series is needed."""
    d = series.where(F.col(x).isNotNull())
    m = d.agg(F.avg(x)).scalar()
    ix = with_row_index(d.select(t, x), [t], "pos").withColumn("c", F.col(x) - m)
    den = ix.agg(F.sum(F.col("c") * F.col("c"))).scalar()
    shifted = ix.select(F.explode(F.sequence(F.lit(1), F.lit(max_lag))).alias("lag"), F.col("c").alias("c_prev"),
                        F.col("pos").alias("p0")).withColumn("pos2", F.col("p0") + F.col("lag"))
    j = ix.select("pos", "c").join(shifted, F.col("pos") == F.col("pos2"))
    return j.groupBy("lag").agg((F.sum(F.col("c") * F.col("c_prev")) / den).alias("acf"))


def fill_calendar(series: DataFrame, t: str, unit: str = "month", by: Sequence[str] = ()) -> DataFrame:
    """Regular calendar from the first to the last period (per series) left
    joined with the values: gaps become NULL."""
    step = {"month": "1 month", "day": "1 day", "week": "7 days"}[unit]
    span = series.groupBy(*by).agg(F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    cal = span.select(*by, F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.expr(f"INTERVAL {step}"))).alias(t))
    return cal.join(series, [*by, t], "left")


def simple_forecasts(series: DataFrame, t: str, y: str, h: int, m: int) -> DataFrame:
    """MEAN, NAIVE, SNAIVE(m) and RW-with-drift forecasts for steps 1..h of
    one series (the summary values are one-row scalars)."""
    st = series.agg(F.struct(F.avg(y).alias("mean"), F.max_by(y, t).alias("last"), F.min_by(y, t).alias("first"),
                             F.count(y).alias("n")).alias("s")).scalar()
    steps = series.sparkSession.range(1, h + 1).select(F.col("id").cast("int").alias("h"))
    lastm = series.orderBy(F.col(t).desc()).limit(m).withColumn(
        "back", F.row_number().over(Window.orderBy(F.col(t).desc())))  # m rows (a bounded top-m)
    sn = steps.withColumn("back", F.lit(m) - F.pmod(F.col("h") - 1, F.lit(m))).join(lastm.select("back", F.col(y).alias("sn")), "back")
    drift = (st.getField("last") - st.getField("first")) / (st.getField("n") - 1)
    base = sn.select("h", F.col("sn").cast("double").alias("snaive"))
    return base.select("h", st.getField("mean").alias("mean"), st.getField("last").cast("double").alias("naive"), "snaive",
                       (st.getField("last") + F.col("h") * drift).alias("drift")) \
        .unpivot(["h"], ["mean", "naive", "snaive", "drift"], "method", "forecast")


def backtest_expanding_mean(series: DataFrame, t: str, y: str, by: Sequence[str] = (), min_rows: int = 3) -> DataFrame:
    """Rolling-origin one-step forecasts by the mean of all earlier values;
    accuracy ME, RMSE, MAE, MPE, MAPE."""
    f = expanding_mean(series, list(by), [t], y, "f", min_rows).where(F.col("f").isNotNull())
    e = F.col(y) - F.col("f")
    return f.groupBy(*by).agg(F.avg(e).alias("me"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                              F.avg(F.try_divide(100 * e, F.col(y))).alias("mpe"),
                              F.avg(F.try_divide(100 * F.abs(e), F.col(y))).alias("mape"))


def decompose_additive(series: DataFrame, t: str, y: str, period: int, season: Column, by: Sequence[str] = ()) -> DataFrame:
    """Classical additive decomposition: centred MA trend, seasonal index =
    mean detrended value per season position (centred to sum 0), remainder."""
    d = centered_ma(series.withColumn("_season", season), list(by), [t], y, period, "trend")
    d = d.withColumn("detrended", F.col(y) - F.col("trend"))
    idx = d.groupBy(*by, "_season").agg(F.avg("detrended").alias("_raw"))
    idx = idx.withColumn("seasonal", F.col("_raw") - F.avg("_raw").over(Window.partitionBy(*by)))
    out = d.join(idx.select(*by, "_season", "seasonal"), [*by, "_season"])
    return out.withColumn("remainder", F.col(y) - F.col("trend") - F.col("seasonal")).drop("_season", "detrended")


def holt_grid(series: DataFrame, t: str, y: str, by: Sequence[str], alphas: Sequence[float], betas: Sequence[float]) -> DataFrame:
    """Holt linear trend smoothing for every (alpha, beta) of a fixed grid;
    one-step SSE per series and parameter pair, best pair per series.  A series
    is folded in blocks (``scans.holt_fits``), whatever its length."""
    w = Window.partitionBy(*by).orderBy("sse", "alpha", "beta")
    return holt_fits(series, t, y, by, alphas, betas).withColumn("rank", F.row_number().over(w))


def ar_fit(series: DataFrame, t: str, y: str, by: Sequence[str], p: int = 2, d: int = 0) -> DataFrame:
    """AR(p) on the d-times differenced series, least squares per series
    (numpy inside ``applyInPandas``; each group is one series of periods)."""
    from quarry.session import ship_package
    ship_package(series.sparkSession)
    keys = list(by)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        s = pdf.sort_values(t)[y].to_numpy(dtype=float)
        for _ in range(d):
            s = np.diff(s)
        rows = {k: [pdf[k].iloc[0]] for k in keys}
        if len(s) <= p + 1:
            return pd.DataFrame({**rows, "term": ["const"], "coef": [np.nan], "sigma2": [np.nan]})
        x = np.column_stack([np.ones(len(s) - p)] + [s[p - j - 1:len(s) - j - 1] for j in range(p)])
        beta, *_ = np.linalg.lstsq(x, s[p:], rcond=None)
        resid = s[p:] - x @ beta
        terms = ["const"] + [f"ar{j + 1}" for j in range(p)]
        out = pd.DataFrame({"term": terms, "coef": beta, "sigma2": float(resid @ resid / max(len(resid) - p - 1, 1))})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[keys + ["term", "coef", "sigma2"]]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in series.schema.fields if f.name in keys]
                       + ["term string", "coef double", "sigma2 double"])
    return series.select(*keys, t, y).groupBy(*keys).applyInPandas(fit, schema)


def ewma_volatility(series: DataFrame, t: str, r: str, lam: float = 0.94, by: Sequence[str] = (),
                    window: int = 20, block: int = BLOCK_ROWS) -> DataFrame:
    """EWMA (RiskMetrics) volatility sigma2_t = lam sigma2_{t-1} + (1 - lam)
    r_{t-1}^2 started at r_0^2; also a rolling sd over ``window`` rows and the
    standardised residual (NULL at sigma 0).  Blocks of a series are scanned in
    parallel (``scans.decayed_sums``).  Null and non-finite returns take no part."""
    x = F.col(r).cast("double")
    d = series.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))).select(*by, t, x.alias(r))
    p = running_sums(d, by, [t], {"_at": F.lit(1)})
    sq = F.col(r) * F.col(r)
    # the first square starts the series, so it counts in full
    s = decayed_sums(p.withColumn("_sq", F.when(F.col("_at") == 1, sq).otherwise((1 - lam) * sq)), by, "_at", "_sq", lam, "_s2", block)
    s = s.withColumn("ewma_sigma", F.sqrt(F.when(F.col("_at") == 1, sq).otherwise(F.col("_s2"))))
    roll = over_halo(s, by, "_at", window - 1, 0, lambda w: {"rolling_sd": F.stddev_samp(r).over(w.rowsBetween(-window + 1, 0))}, block)
    return roll.select(*by, t, r, "ewma_sigma", "rolling_sd", F.try_divide(r, "ewma_sigma").alias("std_resid"))
