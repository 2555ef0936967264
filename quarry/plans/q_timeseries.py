"""Bindings for SURVEY 2.14 (resampling) and 2.15 (time series).

The harness series are calendar aggregates of the fact tables (daily order
revenue, daily order counts, monthly totals per nation): one row per
period, so per-series windows stay bounded by the calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.columns import mix_uniform, mix_uniform_sql
from quarry.operators import resample as rsm
from quarry.operators import timeseries as ts
from quarry.plans.registry import register
from quarry.session import load

S = "2.15"
REV_SQL = "SELECT 1 AS g, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS revenue FROM orders GROUP BY 2"
RET_SQL = f"SELECT g, day, ln(revenue) - lag(ln(revenue)) OVER (ORDER BY day) AS r FROM ({REV_SQL})"
CNT_SQL = "SELECT 1 AS g, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 2"


def daily_revenue(spark, sf):
    return load(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")) \
        .agg(F.sum("o_totalprice").alias("revenue")).withColumn("g", F.lit(1))


def daily_returns(spark, sf):
    return ts.log_returns(daily_revenue(spark, sf), "day", "revenue", ["g"]).select(
        "g", "day", F.col("log_return").alias("r"))


def daily_counts(spark, sf):
    return load(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")) \
        .agg(F.count(F.lit(1)).alias("n")).withColumn("g", F.lit(1))


@register("ts_log_returns", section=S, sql=f"""
SELECT day, round(ln(revenue) - lag(ln(revenue)) OVER (ORDER BY day), 10) AS log_return,
       round(exp(ln(revenue) - lag(ln(revenue)) OVER (ORDER BY day)) - 1, 10) AS simple_return FROM ({REV_SQL})""")
def ts_log_returns(spark, sf):
    r = ts.log_returns(daily_revenue(spark, sf), "day", "revenue", ["g"])
    return r.select("day", F.round("log_return", 10).alias("log_return"), F.round("simple_return", 10).alias("simple_return"))


@register("ts_period_returns", section=S, sql=f"""
SELECT unit, period, round(total, 8) AS total FROM (
  SELECT 'week' AS unit, CAST(date_trunc('week', day) AS DATE) AS period, sum(r) AS total FROM ({RET_SQL}) GROUP BY 1, 2
  UNION ALL SELECT 'month', CAST(date_trunc('month', day) AS DATE), sum(r) FROM ({RET_SQL}) GROUP BY 1, 2
  UNION ALL SELECT 'quarter', CAST(date_trunc('quarter', day) AS DATE), sum(r) FROM ({RET_SQL}) GROUP BY 1, 2
  UNION ALL SELECT 'year', CAST(date_trunc('year', day) AS DATE), sum(r) FROM ({RET_SQL}) GROUP BY 1, 2)""")
def ts_period_returns(spark, sf):
    p = ts.period_sums(daily_returns(spark, sf), "day", "r", ["week", "month", "quarter", "year"])
    return p.select("unit", "period", F.round("total", 8).alias("total"))


@register("ts_var_es_parametric", section=S, sql=f"""
WITH m AS (SELECT avg(r) AS mu, stddev_samp(r) AS sigma FROM ({RET_SQL}))
SELECT round(mu, 10) AS mu, round(sigma, 10) AS sigma, round(mu + sigma * -1.6448536269514722, 8) AS var,
       round(mu - sigma * 0.10313564037537128 / 0.05, 8) AS es FROM m""")
def ts_var_es_parametric(spark, sf):
    v = ts.var_es_parametric(daily_returns(spark, sf), "r")
    return v.select(F.round("mu", 10).alias("mu"), F.round("sigma", 10).alias("sigma"), F.round("var", 8).alias("var"),
                    F.round("es", 8).alias("es"))


@register("ts_var_es_empirical", section=S, sql=f"""
WITH r AS ({RET_SQL}), q AS (SELECT quantile_cont(r, 0.05) AS v FROM r)
SELECT round(v, 10) AS var, round(avg(r), 10) AS es FROM r, q WHERE r <= v GROUP BY v""")
def ts_var_es_empirical(spark, sf):
    v = ts.var_es_empirical(daily_returns(spark, sf), "r")
    return v.select(F.round("var", 10).alias("var"), F.round("es", 10).alias("es"))


@register("ts_autocorrelation", section=S, sql=f"""
WITH r AS (SELECT day, r FROM ({RET_SQL}) WHERE r IS NOT NULL),
     c AS (SELECT row_number() OVER (ORDER BY day) AS pos, r - (SELECT avg(r) FROM r) AS c FROM r),
     l AS (SELECT unnest(range(1, 11)) AS lag)
SELECT CAST(l.lag AS INTEGER) AS lag, round(sum(a.c * b.c) / (SELECT sum(c * c) FROM c), 8) AS acf
FROM l JOIN c a ON true JOIN c b ON b.pos = a.pos - l.lag GROUP BY l.lag""")
def ts_autocorrelation(spark, sf):
    a = ts.autocorrelation(daily_returns(spark, sf), "day", "r", 10)
    return a.select(F.col("lag").cast("int").alias("lag"), F.round("acf", 8).alias("acf"))


@register("ts_resample", section=S, sql="""
SELECT event_type, date_trunc('hour', ts) AS period, round(avg(value), 9) AS value FROM events GROUP BY 1, 2""")
def ts_resample(spark, sf):
    r = ts.resample(load(spark, sf, "events"), "ts", "value", "hour", ["event_type"])
    return r.select("event_type", "period", F.round("value", 9).alias("value"))


@register("ts_monthly_median", section=S, sql="""
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, quantile_cont(o_totalprice, 0.5) AS median FROM orders
           WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' GROUP BY 1),
     cal AS (SELECT CAST(unnest(range(min(month), max(month) + INTERVAL 1 DAY, INTERVAL 1 MONTH)) AS DATE) AS month FROM m)
SELECT month, round(median, 4) AS median FROM cal LEFT JOIN m USING (month)""")
def ts_monthly_median(spark, sf):
    o = load(spark, sf, "orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")) \
        .withColumn("month", F.trunc("o_orderdate", "month"))
    from quarry.operators.quantiles import quantile_wide
    med = quantile_wide(o, "o_totalprice", [0.5], ["median"], ["month"])
    return ts.fill_calendar(med, "month", "month").select("month", F.round("median", 4).alias("median"))


@register("ts_simple_forecast", section=S, sql=f"""
WITH d AS ({CNT_SQL}), s AS (SELECT avg(n) AS mean, arg_max(n, day) AS last, arg_min(n, day) AS first, count(n) AS cnt FROM d),
     lastm AS (SELECT n, row_number() OVER (ORDER BY day DESC) AS back FROM d ORDER BY day DESC LIMIT 7),
     h AS (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS h),
     f AS (SELECT h.h, mean, CAST(last AS DOUBLE) AS naive, CAST(lastm.n AS DOUBLE) AS snaive,
                  last + h.h * (last - first) / (cnt - 1) AS drift FROM h, s JOIN lastm ON true WHERE lastm.back = 7 - (h.h - 1) % 7)
SELECT h, method, round(forecast, 6) AS forecast FROM f UNPIVOT (forecast FOR method IN (mean, naive, snaive, drift))""")
def ts_simple_forecast(spark, sf):
    f = ts.simple_forecasts(daily_counts(spark, sf), "day", "n", 14, 7)
    return f.select("h", "method", F.round("forecast", 6).alias("forecast"))


@register("ts_backtest_accuracy", section=S, sql=f"""
WITH d AS ({CNT_SQL}),
     f AS (SELECT n, CASE WHEN count(n) OVER w >= 3 THEN avg(n) OVER w END AS f FROM d
           WINDOW w AS (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT round(avg(n - f), 6) AS me, round(sqrt(avg((n - f) * (n - f))), 6) AS rmse, round(avg(abs(n - f)), 6) AS mae,
       round(avg(100 * (n - f) / n), 6) AS mpe, round(avg(100 * abs(n - f) / n), 6) AS mape FROM f WHERE f IS NOT NULL""")
def ts_backtest_accuracy(spark, sf):
    b = ts.backtest_expanding_mean(daily_counts(spark, sf), "day", "n", ["g"])
    return b.select(*[F.round(c, 6).alias(c) for c in ("me", "rmse", "mae", "mpe", "mape")])


@register("ts_decompose", section=S, sql=f"""
WITH d AS ({CNT_SQL}),
     t AS (SELECT day, n, dayofweek(day) AS season, CASE WHEN count(n) OVER w = 7 THEN avg(n) OVER w END AS trend FROM d
           WINDOW w AS (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
     i AS (SELECT season, avg(n - trend) AS raw FROM t GROUP BY 1),
     s AS (SELECT season, raw - avg(raw) OVER () AS seasonal FROM i)
SELECT day, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, round(n - trend - seasonal, 6) AS remainder FROM t JOIN s USING (season)""")
def ts_decompose(spark, sf):
    d = ts.decompose_additive(daily_counts(spark, sf), "day", "n", 7, F.dayofweek("day"), ["g"])
    return d.select("day", F.round("trend", 6).alias("trend"), F.round("seasonal", 6).alias("seasonal"),
                    F.round("remainder", 6).alias("remainder"))


def nation_monthly(spark, sf):
    o = load(spark, sf, "orders").join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.groupBy(F.col("c_nationkey").alias("nation"), F.trunc("o_orderdate", "month").alias("month")) \
        .agg(F.sum("o_totalprice").alias("revenue"))


NATION_MONTHLY_SQL = """SELECT c_nationkey AS nation, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(o_totalprice) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
ALPHAS_H, BETAS_H = [0.1, 0.3, 0.5, 0.8], [0.05, 0.1, 0.3]


@register("ts_holt", section=S, sql=f"""
WITH RECURSIVE v AS (SELECT nation, revenue AS y, row_number() OVER (PARTITION BY nation ORDER BY month) - 1 AS i FROM ({NATION_MONTHLY_SQL})),
     g AS (SELECT CAST(alpha AS DOUBLE) AS alpha, CAST(beta AS DOUBLE) AS beta
           FROM (VALUES {", ".join(f"({a!r})" for a in ALPHAS_H)}) a(alpha), (VALUES {", ".join(f"({b!r})" for b in BETAS_H)}) b(beta)),
     h(nation, alpha, beta, i, l, b, sse) AS (
       SELECT v0.nation, alpha, beta, CAST(1 AS BIGINT), v0.y, v1.y - v0.y, CAST(0.0 AS DOUBLE) FROM v v0 JOIN v v1 ON v0.nation = v1.nation AND v0.i = 0 AND v1.i = 1, g
       UNION ALL
       SELECT h.nation, alpha, beta, h.i + 1, alpha * v.y + (1 - alpha) * (h.l + h.b),
              beta * ((alpha * v.y + (1 - alpha) * (h.l + h.b)) - h.l) + (1 - beta) * h.b,
              h.sse + (v.y - (h.l + h.b)) * (v.y - (h.l + h.b))
       FROM h JOIN v ON v.nation = h.nation AND v.i = h.i),
     last AS (SELECT h.* FROM h JOIN (SELECT nation, max(i) AS mi FROM v GROUP BY 1) m ON h.nation = m.nation AND h.i = m.mi + 1),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY sse, alpha, beta) AS rank FROM last)
SELECT nation, alpha, beta, round(sse / 1e6, 3) AS sse_m, round(l, 4) AS level, round(b, 4) AS trend FROM ranked WHERE rank = 1""")
def ts_holt(spark, sf):
    h = ts.holt_grid(nation_monthly(spark, sf), "month", "revenue", ["nation"], ALPHAS_H, BETAS_H)
    return h.where(F.col("rank") == 1).select("nation", "alpha", "beta", F.round(F.col("sse") / 1e6, 3).alias("sse_m"),
                                               F.round("level", 4).alias("level"), F.round("trend", 4).alias("trend"))


@register("ts_ar_p", section=S, sql=f"""
WITH d AS (SELECT nation, month, revenue - lag(revenue) OVER (PARTITION BY nation ORDER BY month) AS y FROM ({NATION_MONTHLY_SQL})),
     x AS (SELECT nation, y, lag(y) OVER w AS x1, lag(y, 2) OVER w AS x2 FROM d WINDOW w AS (PARTITION BY nation ORDER BY month)),
     c AS (SELECT * FROM x WHERE y IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL),
     g AS (SELECT nation, count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, covar_samp(x1, x1) AS s11, covar_samp(x2, x2) AS s22,
                  covar_samp(x1, x2) AS s12, covar_samp(x1, y) AS s1y, covar_samp(x2, y) AS s2y FROM c GROUP BY 1),
     b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM g),
     f AS (SELECT *, my - b1 * m1 - b2 * m2 AS a FROM b),
     e AS (SELECT f.nation, sum(power(c.y - f.a - f.b1 * c.x1 - f.b2 * c.x2, 2)) / (any_value(f.n) - 3) AS sigma2 FROM c JOIN f USING (nation) GROUP BY 1)
SELECT nation, term, CASE WHEN term = 'const' THEN round(coef, 0) ELSE round(coef, 6) END AS coef, round(sqrt(sigma2), 0) AS sigma
FROM f JOIN e USING (nation), (SELECT unnest(['const', 'ar1', 'ar2']) AS term)
CROSS JOIN LATERAL (SELECT CASE term WHEN 'const' THEN f.a WHEN 'ar1' THEN f.b1 ELSE f.b2 END AS coef)""")
def ts_ar_p(spark, sf):
    r = ts.ar_fit(nation_monthly(spark, sf), "month", "revenue", ["nation"], p=2, d=1)
    return r.select("nation", "term", F.when(F.col("term") == "const", F.round("coef", 0)).otherwise(F.round("coef", 6)).alias("coef"),
                    F.round(F.sqrt("sigma2"), 0).alias("sigma"))


@register("ts_ewma_volatility", section=S, sql=f"""
WITH x AS (SELECT day, r, row_number() OVER (ORDER BY day) - 1 AS t FROM ({RET_SQL}) WHERE r IS NOT NULL),
     f AS (SELECT day, r, t, first(r * r) OVER (ORDER BY t) AS r0sq,
                  coalesce(sum(CASE WHEN t >= 1 THEN power(0.94, -t) * r * r END)
                           OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS acc,
                  stddev_samp(r) OVER (ORDER BY t ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS rolling_sd FROM x),
     s AS (SELECT day, r, rolling_sd, CASE WHEN t = 0 THEN abs(r) ELSE sqrt(power(0.94, t - 1) * (r0sq + (1 - 0.94) * acc)) END AS sig FROM f)
SELECT day, round(sig, 8) AS ewma_sigma, round(rolling_sd, 8) AS rolling_sd, round(r / sig, 8) AS std_resid FROM s""")
def ts_ewma_volatility(spark, sf):
    e = ts.ewma_volatility(daily_returns(spark, sf), "day", "r", 0.94, ["g"])
    return e.select("day", *[F.round(c, 8).alias(c) for c in ("ewma_sigma", "rolling_sd", "std_resid")])


# ------------------------------------------------------------ 2.14 resampling
# Draws use the portable pseudo-uniform so the oracle reproduces them.
POIS = " ".join(f"WHEN u < {c!r} THEN {k}" for k, c in enumerate(rsm.POISSON1_CDF))
RETS_NN = f"SELECT day, r FROM ({RET_SQL}) WHERE r IS NOT NULL"


@register("bootstrap_quantile", section="2.14", sql=f"""
WITH w AS (SELECT rep, value, CASE {POIS} ELSE {len(rsm.POISSON1_CDF)} END AS k
           FROM (SELECT rep, value, {mix_uniform_sql(["rep", "event_id"], 42)} AS u FROM events, (SELECT unnest(range(20)) AS rep))),
     x AS (SELECT rep, value, unnest(range(k)) AS i FROM w WHERE k > 0),
     q AS (SELECT rep, quantile_cont(value, 0.75) AS q FROM x GROUP BY rep)
SELECT count(*) AS replicates, round(avg(q), 8) AS mean_q, round(stddev_samp(q), 8) AS sd_q FROM q""")
def bootstrap_quantile(spark, sf):
    b = rsm.bootstrap_quantile(load(spark, sf, "events"), "value", ["event_id"], 0.75, 20,
                               uniform=lambda *cs: mix_uniform(*cs, seed=42))
    return b.select("replicates", F.round("mean_q", 8).alias("mean_q"), F.round("sd_q", 8).alias("sd_q"))


@register("historical_resample_var", section="2.14", sql=f"""
WITH ix AS (SELECT r, row_number() OVER (ORDER BY day) AS pos FROM ({RETS_NN})), n AS (SELECT count(*) AS n FROM ix),
     d AS (SELECT CAST(floor({mix_uniform_sql(["i"], 42)} * n) + 1 AS BIGINT) AS pos FROM range(100000) t(i), n),
     s AS (SELECT r FROM d JOIN ix USING (pos)), q AS (SELECT quantile_cont(r, 0.05) AS v FROM s)
SELECT round(v, 10) AS var, count(*) AS n_tail, round(avg(r), 10) AS es FROM s, q WHERE r <= v GROUP BY v""")
def historical_resample_var(spark, sf):
    r = daily_returns(spark, sf).where(F.col("r").isNotNull())
    h = rsm.historical_var(r, "r", ["day"], 100_000, uniform=lambda c: mix_uniform(c, seed=42))
    return h.select(F.round("var", 10).alias("var"), "n_tail", F.round("es", 10).alias("es"))


@register("block_bootstrap", section="2.14", sql=f"""
WITH ix AS (SELECT r, row_number() OVER (ORDER BY day) AS pos FROM ({RETS_NN})),
     rs AS (SELECT pos, CASE WHEN count(r) OVER w = 10 THEN sum(r) OVER w END AS bs FROM ix
            WINDOW w AS (ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
     v AS (SELECT * FROM rs WHERE bs IS NOT NULL), n AS (SELECT count(*) AS n FROM v),
     d AS (SELECT CAST(floor({mix_uniform_sql(["i"], 42)} * n) + 1 AS BIGINT) AS pos FROM range(1000) t(i), n),
     s AS (SELECT bs FROM d JOIN v USING (pos))
SELECT count(*) AS draws, round(avg(bs), 10) AS mean, round(stddev_samp(bs), 10) AS sd, round(quantile_cont(bs, 0.05), 10) AS q05 FROM s""")
def block_bootstrap(spark, sf):
    r = daily_returns(spark, sf).where(F.col("r").isNotNull())
    b = rsm.block_bootstrap(r, "day", "r", 10, 1000, uniform=lambda c: mix_uniform(c, seed=42))
    return b.select("draws", *[F.round(c, 10).alias(c) for c in ("mean", "sd", "q05")])
