"""Bindings for SURVEY 2.13: statistical tests and regression.

P-values come from numeric helpers DuckDB cannot reproduce, so each S query
selects the oracle-checkable columns; the p-value path has unit tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.columns import mix_uniform_sql
from quarry.functions.distributions import norm_cdf_sql, norm_pdf_sql, norm_ppf_sql
from quarry.operators import stats as stt
from quarry.operators import ml, survey
from quarry.plans.registry import register
from quarry.session import load

S = "2.13"


def _simpson_sql(upper: str, density: str) -> str:
    """Two-sided tail beyond ``upper``: 1 less twice the integral of a density
    of x over [0, upper], by Simpson's rule with 2000 steps."""
    x = f"(least(abs({upper}), 40.0) * i / 2000.0)"
    return (f"greatest(0.0, 1 - 2 * (SELECT sum((CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * "
            f"{density.format(x=x)}) FROM range(0, 2001) steps(i)) * least(abs({upper}), 40.0) / 6000.0)")


def _normal_tail_sql(z: str) -> str:
    return _simpson_sql(z, "exp(-0.5 * power({x}, 2)) / sqrt(2 * pi())")


def _t_tail_sql(t: str, df: str) -> str:
    return _simpson_sql(t, f"exp(lgamma((({df}) + 1) / 2.0) - lgamma(({df}) / 2.0) - 0.5 * ln(({df}) * pi()) "
                           f"- (({df}) + 1) / 2.0 * ln(1 + power({{x}}, 2) / ({df})))")


@register("t_test_welch", section=S, sql=f"""
WITH m AS (SELECT l_linestatus AS g, count(*) AS n, avg(l_quantity) AS mean, var_samp(l_quantity) AS v FROM lineitem GROUP BY 1),
     a AS (SELECT * FROM m WHERE g = 'O'), b AS (SELECT * FROM m WHERE g = 'F'),
     s AS (SELECT (a.mean - b.mean) / sqrt(a.v / a.n + b.v / b.n) AS t,
       power(a.v / a.n + b.v / b.n, 2) / (power(a.v / a.n, 2) / (a.n - 1) + power(b.v / b.n, 2) / (b.n - 1)) AS df FROM a, b)
SELECT round(t, 8) AS t, round(df, 6) AS df, round({_t_tail_sql("t", "df")}, 6) AS p_value FROM s""")
def t_test_welch(spark, sf):
    r = stt.t_test_welch(load(spark, sf, "lineitem"), "l_quantity", "l_linestatus", "O", "F")
    return r.select(F.round("t", 8).alias("t"), F.round("df", 6).alias("df"), F.round("p_value", 6).alias("p_value"))


@register("t_test_many_columns", section=S, sql=f"""
WITH x AS (SELECT label < 5 AS g, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
     m AS (SELECT pos, count(v) FILTER (WHERE g) AS na, count(v) FILTER (WHERE NOT g) AS nb, avg(v) FILTER (WHERE g) AS ma,
                  avg(v) FILTER (WHERE NOT g) AS mb, var_samp(v) FILTER (WHERE g) AS va, var_samp(v) FILTER (WHERE NOT g) AS vb FROM x GROUP BY pos)
SELECT pos, round((ma - mb) / sqrt(va / na + vb / nb), 6) AS t, round(p, 6) AS p_value FROM (SELECT *, {_t_tail_sql("((ma - mb) / sqrt(va / na + vb / nb))", "(power(va / na + vb / nb, 2) / (power(va / na, 2) / (na - 1) + power(vb / nb, 2) / (nb - 1)))")} AS p FROM m)""")
def t_test_many_columns(spark, sf):
    r = stt.t_test_per_position(load(spark, sf, "embeddings"), "embedding", F.col("label") < 5)
    return r.select("pos", F.round("t", 6).alias("t"), F.round("p_value", 6).alias("p_value"))


@register("chi_square_test", section=S, sql=f"""
WITH c AS (SELECT l_linestatus AS x, l_discount > 0.05 AS y, count(*) AS o FROM lineitem GROUP BY 1, 2),
     r AS (SELECT x, sum(o) AS rx FROM c GROUP BY 1), k AS (SELECT y, sum(o) AS cy FROM c GROUP BY 1), n AS (SELECT sum(o) AS n FROM c)
SELECT round(x2, 6) AS statistic, CAST(1 AS BIGINT) AS df, round({_normal_tail_sql("sqrt(x2)")}, 6) AS p_value FROM (
SELECT sum(power(abs(o - rx * cy / n) - least(0.5, abs(o - rx * cy / n)), 2) / (rx * cy / n)) AS x2
FROM c JOIN r USING (x) JOIN k USING (y), n)""")
def chi_square_test(spark, sf):
    r = stt.chi_square_test(load(spark, sf, "lineitem"), "l_linestatus", F.col("l_discount") > 0.05)
    return r.select(F.round("statistic", 6).alias("statistic"), "df", F.round("p_value", 6).alias("p_value"))


@register("chi_square_test_rxc", section=S, sql="""
WITH c AS (SELECT l_returnflag AS x, l_linestatus AS y, count(*) AS o FROM lineitem GROUP BY 1, 2),
     r AS (SELECT x, sum(o) AS rx FROM c GROUP BY 1), k AS (SELECT y, sum(o) AS cy FROM c GROUP BY 1), n AS (SELECT sum(o) AS n FROM c)
SELECT round(x2, 6) AS statistic, CAST(2 AS BIGINT) AS df, round(exp(-x2 / 2), 6) AS p_value FROM (
SELECT sum(o * o / (rx * cy / n)) - (SELECT n FROM n) AS x2 FROM c JOIN r USING (x) JOIN k USING (y), n)""")
def chi_square_test_rxc(spark, sf):
    r = stt.chi_square_test(load(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", yates=False)
    return r.select(F.round("statistic", 6).alias("statistic"), "df", F.round("p_value", 6).alias("p_value"))


@register("prop_test_two_sample", section=S, sql=f"""
WITH c AS (SELECT event_type, count(*) FILTER (WHERE value > 100) AS x, count(*) AS n FROM events GROUP BY 1),
     a AS (SELECT x AS x1, n AS n1 FROM c WHERE event_type = 'click'), b AS (SELECT x AS x2, n AS n2 FROM c WHERE event_type = 'view'),
     p AS (SELECT x1 / n1 AS p1, x2 / n2 AS p2, (x1 + x2) / (n1 + n2) AS pp, n1, n2 FROM a, b)
SELECT round(p1, 8) AS estimate1, round(p2, 8) AS estimate2, round(power(p1 - p2, 2) / (pp * (1 - pp) * (1 / n1 + 1 / n2)), 8) AS statistic,
       round(p1 - p2 - 1.959963984540054 * sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2), 8) AS ci_lo,
       round(p1 - p2 + 1.959963984540054 * sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2), 8) AS ci_hi,
       round({_normal_tail_sql("((p1 - p2) / sqrt(pp * (1 - pp) * (1 / n1 + 1 / n2)))")}, 6) AS p_value FROM p""")
def prop_test_two_sample(spark, sf):
    c = load(spark, sf, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 100).alias("x"),
                                                            F.count(F.lit(1)).alias("n"))
    r = stt.prop_test_two(c, "event_type", "x", "n", "click", "view")
    return r.select(*[F.round(k, 8).alias(k) for k in ("estimate1", "estimate2", "statistic", "ci_lo", "ci_hi")],
                    F.round("p_value", 6).alias("p_value"))


@register("jarque_bera", section=S, sql="""
WITH m AS (SELECT event_type, avg(value) AS mu, count(value) AS n FROM events GROUP BY 1),
     c AS (SELECT event_type, any_value(n) AS n, avg(power(value - mu, 2)) AS m2, avg(power(value - mu, 3)) AS m3, avg(power(value - mu, 4)) AS m4
           FROM events JOIN m USING (event_type) GROUP BY 1)
SELECT event_type, n, round(n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4), 6) AS jb,
       round(exp(-n / 12.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4)), 6) AS p_value FROM c""")
def jarque_bera(spark, sf):
    r = stt.jarque_bera(load(spark, sf, "events"), "value", ["event_type"])
    return r.select("event_type", "n", F.round("jb", 6).alias("jb"), F.round("p_value", 6).alias("p_value"))


@register("anova_one_way", section=S, sql="""
WITH m AS (SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS s, sum(l_quantity * l_quantity) AS ss FROM lineitem GROUP BY 1),
     g AS (SELECT sum(n) AS nn, sum(s) AS st, sum(ss) AS sst, sum(s * s / n) AS br, count(*) AS k FROM m)
SELECT round(br - st * st / nn, 4) AS ss_between, round(sst - br, 4) AS ss_within, k - 1 AS df_between, CAST(nn - k AS BIGINT) AS df_within,
       round(((br - st * st / nn) / (k - 1)) / ((sst - br) / (nn - k)), 6) AS f,
       round(exp(-(nn - k) / 2.0 * ln(1 + (br - st * st / nn) / (sst - br))), 6) AS p_value FROM g""")
def anova_one_way(spark, sf):
    r = stt.anova_one_way(load(spark, sf, "lineitem"), "l_quantity", "l_returnflag")
    return r.select(F.round("ss_between", 4).alias("ss_between"), F.round("ss_within", 4).alias("ss_within"),
                    "df_between", "df_within", F.round("f", 6).alias("f"), F.round("p_value", 6).alias("p_value"))


@register("posthoc_pairwise", section=S, sql=f"""
WITH m AS (SELECT l_returnflag AS g, count(*) AS n, avg(l_quantity) AS mean, var_samp(l_quantity) AS v FROM lineitem GROUP BY 1),
     p AS (SELECT sum((n - 1) * v) / (sum(n) - count(*)) AS mse, sum(n) - count(*) AS dfw FROM m),
     s AS (SELECT a.g AS g1, b.g AS g2, a.mean - b.mean AS diff, sqrt(mse * (1.0 / a.n + 1.0 / b.n)) AS se, dfw FROM m a JOIN m b ON a.g < b.g, p)
SELECT g1, g2, round(diff, 8) AS diff, round(se, 8) AS se, round(diff / se, 6) AS t, round({_t_tail_sql("(diff / se)", "dfw")}, 6) AS p_value FROM s""")
def posthoc_pairwise(spark, sf):
    r = stt.posthoc_pairwise(load(spark, sf, "lineitem"), "l_quantity", "l_returnflag")
    return r.select("g1", "g2", F.round("diff", 8).alias("diff"), F.round("se", 8).alias("se"), F.round("t", 6).alias("t"),
                    F.round("p_value", 6).alias("p_value"))


@register("lm_simple", section=S, sql="""
SELECT l_returnflag, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 8) AS r2
FROM lineitem GROUP BY 1""")
def lm_simple(spark, sf):
    r = stt.simple_regression(load(spark, sf, "lineitem"), "l_extendedprice", "l_quantity", ["l_returnflag"])
    return r.select("l_returnflag", "n", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
                    F.round("r2", 8).alias("r2"))


def _lm_rows_sql(terms: list[tuple[str, str, str]], df: str, frm: str) -> str:
    """Summary rows of (term, estimate, standard error) expressions.  The interval's
    t quantile is the expansion around the normal one in 1 / df (error ~ df^-3)."""
    z = "1.959963984540054"
    q = f"({z} + (power({z}, 3) + {z}) / (4.0 * df) + (5 * power({z}, 5) + 16 * power({z}, 3) + 3 * {z}) / (96.0 * df * df))"
    rows = " UNION ALL ".join(f"SELECT {t} AS term, {e} AS b, {s} AS se, {df} AS df FROM {frm}" for t, e, s in terms)
    return f"""SELECT term, round(b, 4) AS estimate, round(se, 4) AS std_error, round(b / se, 5) AS t_value,
       round({_t_tail_sql("(b / se)", "df")}, 6) AS p_value, round(b - {q} * se, 4) AS lo, round(b + {q} * se, 4) AS hi FROM ({rows})"""


def _lm_rounded(t):
    return t.select("term", *[F.round(c, 6 if c == "p_value" else 5 if c == "t_value" else 4).alias(c)
                              for c in ("estimate", "std_error", "t_value", "p_value", "lo", "hi")])


@register("lm_multiple", section=S, sql=f"""
WITH g AS (SELECT count(*) AS n, avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2,
                  covar_samp(l_quantity, l_quantity) AS s11, covar_samp(l_discount, l_discount) AS s22, covar_samp(l_quantity, l_discount) AS s12,
                  covar_samp(l_quantity, l_extendedprice) AS s1y, covar_samp(l_discount, l_extendedprice) AS s2y FROM lineitem),
     b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2,
                  (s11 * s22 - s12 * s12) * (n - 1) AS det FROM g),
     r AS (SELECT b.*, sum(power(l_extendedprice - my - b1 * (l_quantity - m1) - b2 * (l_discount - m2), 2)) OVER () / (n - 3) AS v
           FROM lineitem, b LIMIT 1)
{_lm_rows_sql([("'l_quantity'", "b1", "sqrt(v * s22 / det)"), ("'l_discount'", "b2", "sqrt(v * s11 / det)"),
               ("'(Intercept)'", "my - b1 * m1 - b2 * m2", "sqrt(v * (1.0 / n + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det))")], "(n - 3)", "r")}""")
def lm_multiple(spark, sf):
    return _lm_rounded(stt.lm_summary(load(spark, sf, "lineitem"), "l_extendedprice", {"l_quantity": "l_quantity", "l_discount": "l_discount"}))


@register("lm_per_group", section=S, sql="""
WITH g AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS slope,
                  regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_sxx(l_extendedprice, l_quantity) AS sxx,
                  regr_syy(l_extendedprice, l_quantity) AS syy, regr_sxy(l_extendedprice, l_quantity) AS sxy FROM lineitem GROUP BY 1)
SELECT year, n, round(slope, 4) AS slope, round(intercept, 4) AS intercept, round(sqrt((syy - slope * sxy) / (n - 2) / sxx), 4) AS slope_se FROM g""")
def lm_per_group(spark, sf):
    li = load(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    r = stt.simple_regression(li, "l_extendedprice", "l_quantity", ["year"])
    return r.select("year", "n", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
                    F.round("slope_se", 4).alias("slope_se"))


@register("lm_per_group_trend", section=S, sql="""
WITH g AS (SELECT CAST(year(l_shipdate) AS DOUBLE) AS year, regr_slope(l_extendedprice, l_quantity) AS slope FROM lineitem GROUP BY 1)
SELECT count(*) AS n_groups, round(regr_slope(slope, year), 6) AS slope_trend, round(regr_intercept(slope, year), 4) AS trend_intercept FROM g""")
def lm_per_group_trend(spark, sf):
    """Second stage of ``do(tidy(lm()))``: a regression on the per-group
    coefficients (how the price-per-unit slope moves across years)."""
    li = load(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate").cast("double"))
    g = stt.simple_regression(li, "l_extendedprice", "l_quantity", ["year"])
    return g.agg(F.count(F.lit(1)).alias("n_groups"), F.round(F.regr_slope("slope", "year"), 6).alias("slope_trend"),
                 F.round(F.regr_intercept("slope", "year"), 4).alias("trend_intercept"))


DAILY_T_SQL = ("SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1")


@register("lm_diagnostics", section=S, sql=f"""
WITH d AS ({DAILY_T_SQL}), t AS (SELECT day, n, CAST(day - (SELECT min(day) FROM d) AS DOUBLE) AS t FROM d),
     c AS (SELECT regr_slope(n, t) AS b, regr_intercept(n, t) AS a FROM t)
SELECT day, round(a + b * t, 6) AS fitted, round(n - (a + b * t), 6) AS residual FROM t, c""")
def lm_diagnostics(spark, sf):
    d = load(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    first = d.agg(F.min("day")).scalar()
    d = d.withColumn("t", F.datediff("day", first).cast("double"))
    r = stt.fitted_residuals(d, "n", "t")
    return r.select("day", F.round("fitted", 6).alias("fitted"), F.round("residual", 6).alias("residual"))


@register("mixed_effects_shrunken_slopes", section=S, sql="""
WITH c AS (SELECT l_suppkey, CAST(year(l_shipdate) AS DOUBLE) AS yr, CAST(count(*) AS DOUBLE) AS n_lines FROM lineitem GROUP BY 1, 2),
     g AS (SELECT l_suppkey, count(*) AS n, regr_slope(n_lines, yr) AS slope, regr_sxx(n_lines, yr) AS sxx, regr_syy(n_lines, yr) AS syy,
                  regr_sxy(n_lines, yr) AS sxy FROM c GROUP BY 1),
     r AS (SELECT l_suppkey, n, slope, (syy - slope * sxy) / (n - 2) / sxx AS v FROM g WHERE n > 2),
     r2 AS (SELECT * FROM r WHERE v > 0),
     s AS (SELECT sum(slope / v) / sum(1 / v) AS b, greatest(0.0, var_samp(slope) - avg(v)) AS tau2 FROM r2)
SELECT l_suppkey, n, round(slope, 6) + 0.0 AS slope, round(b, 6) + 0.0 AS overall, round(b + tau2 / (tau2 + v) * (slope - b), 6) + 0.0 AS shrunk FROM r2, s""")
def mixed_effects_shrunken_slopes(spark, sf):
    c = load(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").cast("double").alias("yr")) \
        .agg(F.count(F.lit(1)).cast("double").alias("n_lines"))
    r = stt.shrunken_slopes(c, "n_lines", "yr", "l_suppkey")
    return r.select("l_suppkey", "n", (F.round("slope", 6) + 0.0).alias("slope"), (F.round("overall", 6) + 0.0).alias("overall"),
                    (F.round("shrunk", 6) + 0.0).alias("shrunk"))


ALPHAS = [10.0, 25.0, 50.0, 100.0, 150.0, 200.0, 250.0]


@register("shrunken_group_mean", section=S, sql=f"""
WITH tr AS (SELECT * FROM orders WHERE o_orderkey % 5 <> 0), te AS (SELECT * FROM orders WHERE o_orderkey % 5 = 0),
     mu AS (SELECT avg(o_totalprice) AS mu FROM tr),
     g AS (SELECT o_custkey, sum(o_totalprice - mu) AS dev, count(*) AS n FROM tr, mu GROUP BY 1),
     a AS (SELECT * FROM (VALUES {", ".join(f"({a})" for a in ALPHAS)}) v(alpha)),
     p AS (SELECT o_custkey, alpha, mu + dev / (n + alpha) AS pred FROM g, a, mu),
     ta AS (SELECT o_custkey, o_totalprice, CAST(alpha AS DOUBLE) AS alpha FROM te, a)
SELECT alpha, round(sqrt(avg(power(o_totalprice - coalesce(pred, (SELECT mu FROM mu)), 2))), 4) AS rmse
FROM ta LEFT JOIN p USING (o_custkey, alpha) GROUP BY alpha""")
def shrunken_group_mean(spark, sf):
    o = load(spark, sf, "orders")
    test = F.pmod(F.col("o_orderkey"), F.lit(5)) == 0
    r = stt.shrunken_means(o.where(~test), o.where(test), "o_custkey", "o_totalprice", ALPHAS)
    return r.select("alpha", F.round("rmse", 4).alias("rmse"))


@register("survey_design_mean_se", section=S, sql="""
WITH d AS (SELECT l_linestatus AS domain, l_discount AS x, l_quantity AS w, l_returnflag AS h, l_suppkey AS j FROM lineitem),
     e AS (SELECT domain, sum(w * x) / sum(w) AS mean, sum(w) AS ww FROM d GROUP BY 1),
     p AS (SELECT domain, h, j, sum(w * (x - mean) / ww) AS zt FROM d JOIN e USING (domain) GROUP BY 1, 2, 3),
     nh AS (SELECT l_returnflag AS h, count(DISTINCT l_suppkey) AS nh FROM lineitem GROUP BY 1),
     st AS (SELECT domain, h, sum(zt) AS zs, sum(zt * zt) AS zz FROM p GROUP BY 1, 2),
     v AS (SELECT domain, sum(CASE WHEN nh > 1 THEN nh / (nh - 1.0) * (zz - zs * zs / nh) ELSE 0.0 END) AS var FROM st JOIN nh USING (h) GROUP BY 1)
SELECT domain, round(mean, 10) AS mean, round(sqrt(var), 10) AS se FROM e JOIN v USING (domain)""")
def survey_design_mean_se(spark, sf):
    r = stt.survey_mean(load(spark, sf, "lineitem"), "l_discount", "l_quantity", "l_returnflag", "l_suppkey", "l_linestatus")
    return r.select("domain", F.round("mean", 10).alias("mean"), F.round("se", 10).alias("se"))


LIFE_SQL = """SELECT user_id, arg_min(event_type, (ts, event_id)) AS cohort,
  CAST(date_diff('day', min(ts), max(ts)) AS INTEGER) AS time, CASE WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN 1 ELSE 0 END AS status
FROM events GROUP BY user_id"""


def lifetimes(spark, sf):
    ev = load(spark, sf, "events")
    order = F.struct("ts", "event_id")
    return ev.groupBy("user_id").agg(
        F.min_by("event_type", order).alias("cohort"),
        F.datediff(F.max("ts"), F.min("ts")).alias("time"),
        F.when(F.max_by("event_type", order) == "error", 1).otherwise(0).alias("status"))


@register("kaplan_meier", section=S, sql=f"""
WITH l AS ({LIFE_SQL}),
     t AS (SELECT cohort, time, count(*) AS n_exit, CAST(sum(status) AS BIGINT) AS n_event FROM l GROUP BY 1, 2),
     r AS (SELECT *, CAST(sum(n_exit) OVER (PARTITION BY cohort ORDER BY time DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n_risk FROM t)
SELECT cohort, time, n_exit, n_event, n_risk,
  round(CASE WHEN max(CASE WHEN n_event >= n_risk THEN 1 ELSE 0 END) OVER w = 1 THEN 0.0
        ELSE exp(sum(CASE WHEN n_event < n_risk THEN ln(1 - n_event / n_risk) ELSE 0.0 END) OVER w) END, 8) AS surv
FROM r WINDOW w AS (PARTITION BY cohort ORDER BY time ROWS UNBOUNDED PRECEDING)""")
def kaplan_meier(spark, sf):
    k = stt.kaplan_meier(lifetimes(spark, sf), "time", "status", ["cohort"])
    return k.select("cohort", "time", "n_exit", "n_event", "n_risk", F.round("surv", 8).alias("surv"))


@register("log_rank_test", section=S, sql=f"""
WITH l AS ({LIFE_SQL}), d AS (SELECT *, CASE WHEN cohort = 'click' THEN 1 ELSE 0 END AS a FROM l WHERE cohort IN ('click', 'view')),
     t AS (SELECT time, count(*) AS m, sum(a) AS m_a, sum(status) AS dd, sum(status * a) AS d_a FROM d GROUP BY 1),
     r AS (SELECT *, sum(m) OVER w AS n, sum(m_a) OVER w AS n_a FROM t WINDOW w AS (ORDER BY time DESC ROWS UNBOUNDED PRECEDING)),
     s AS (SELECT sum(d_a) AS observed, sum(dd * n_a / n) AS expected,
                  sum(CASE WHEN n > 1 THEN dd * (n_a / n) * (1 - n_a / n) * (n - dd) / (n - 1) ELSE 0.0 END) AS variance FROM r)
SELECT CAST(observed AS BIGINT) AS observed, round(expected, 8) AS expected,
       CASE WHEN variance > 0 THEN round(power(observed - expected, 2) / variance, 6) END AS chisq,
       CASE WHEN variance > 0 THEN round({_normal_tail_sql("((observed - expected) / sqrt(variance))")}, 6) END AS p_value FROM s""")
def log_rank_test(spark, sf):
    r = stt.log_rank(lifetimes(spark, sf), "time", "status", "cohort", "click", "view")
    return r.select("observed", F.round("expected", 8).alias("expected"), F.round("chisq", 6).alias("chisq"), F.round("p_value", 6).alias("p_value"))


@register("normal_tail_columns", section=S, sql=f"""
WITH st AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events),
     z AS (SELECT event_id, value, (value - m) / s AS z, m, s FROM events, st)
SELECT event_id, value, round({norm_cdf_sql("z")}, 8) AS p_lower, round({norm_pdf_sql("z")} / s, 10) AS density,
       round(m + s * {norm_ppf_sql("0.05")}, 8) AS cutoff FROM z""")
def normal_tail_columns(spark, sf):
    r = stt.normal_tail_columns(load(spark, sf, "events").select("event_id", "value"), "value")
    return r.select("event_id", "value", F.round("p_lower", 8).alias("p_lower"), F.round("density", 10).alias("density"),
                    F.round("cutoff", 8).alias("cutoff"))


# ---------------------------------------------------- solver-based (rows checks)
@register("anova_nested_models", section=S, sql=f"""
WITH g AS (SELECT count(*) AS n, regr_syy(l_extendedprice, l_quantity) AS syy0, regr_slope(l_extendedprice, l_quantity) AS b0,
                  regr_sxy(l_extendedprice, l_quantity) AS sxy0,
                  covar_samp(l_quantity, l_quantity) AS s11, covar_samp(l_discount, l_discount) AS s22, covar_samp(l_quantity, l_discount) AS s12,
                  covar_samp(l_quantity, l_extendedprice) AS s1y, covar_samp(l_discount, l_extendedprice) AS s2y,
                  var_samp(l_extendedprice) AS syy FROM lineitem),
     b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM g),
     r AS (SELECT n, syy0 - b0 * sxy0 AS rss0, (n - 1) * (syy - b1 * s1y - b2 * s2y) AS rss1 FROM b)
SELECT round(rss0 / 1e6, 3) AS rss_small_m, round(rss1 / 1e6, 3) AS rss_large_m, 1 AS df1, CAST(n - 3 AS INTEGER) AS df2,
       round(((rss0 - rss1) / 1) / (rss1 / (n - 3)), 6) AS f,
       round({_t_tail_sql("sqrt((rss0 - rss1) / (rss1 / (n - 3)))", "n - 3")}, 6) AS p_value FROM r""")
def anova_nested_models(spark, sf):
    li = load(spark, sf, "lineitem").select("l_extendedprice", "l_quantity", "l_discount")
    t = ml.nested_model_f(li, "l_extendedprice", ["l_quantity"], ["l_quantity", "l_discount"])
    return t.select(F.round(F.col("rss_small") / 1e6, 3).alias("rss_small_m"), F.round(F.col("rss_large") / 1e6, 3).alias("rss_large_m"),
                    "df1", "df2", F.round("f", 6).alias("f"), F.round("p_value", 6).alias("p_value"))


@register("lm_interaction", section=S, sql=f"""
WITH g AS (SELECT l_returnflag AS lv, count(*) AS n, avg(l_quantity) AS m, avg(l_extendedprice) AS my, regr_slope(l_extendedprice, l_quantity) AS b,
                  var_pop(l_quantity) * count(*) AS sxx FROM lineitem GROUP BY 1),
     rss AS (SELECT sum(power(l_extendedprice - my - b * (l_quantity - m), 2)) AS rss, count(*) AS rows FROM lineitem JOIN g ON l_returnflag = lv),
     s AS (SELECT *, my - b * m AS a, rss / (rows - 2 * (SELECT count(*) FROM g)) AS v, rows - 2 * (SELECT count(*) FROM g) AS df FROM g, rss),
     base AS (SELECT * FROM s WHERE lv = (SELECT min(lv) FROM g)),
     d AS (SELECT s.lv, s.a - base.a AS da, s.b - base.b AS db, sqrt(s.v * (1.0 / s.n + s.m * s.m / s.sxx + 1.0 / base.n + base.m * base.m / base.sxx)) AS sa,
                  sqrt(s.v * (1 / s.sxx + 1 / base.sxx)) AS sb, s.df FROM s, base WHERE s.lv <> base.lv),
     f AS (SELECT 'l_quantity' AS term, b, sqrt(v / sxx) AS se, df FROM base UNION ALL SELECT '(Intercept)', a, sqrt(v * (1.0 / n + m * m / sxx)), df FROM base
           UNION ALL SELECT 'l_returnflag' || lv, da, sa, df FROM d UNION ALL SELECT 'l_quantity:l_returnflag' || lv, db, sb, df FROM d)
{_lm_rows_sql([("term", "b", "se")], "df", "f")}""")
def lm_interaction(spark, sf):
    li = load(spark, sf, "lineitem").select("l_extendedprice", "l_quantity", "l_returnflag")
    return _lm_rounded(stt.lm_summary(li, "l_extendedprice", stt.treatment_columns(li, "l_quantity", "l_returnflag")))


@register("rmse_repeated_holdout", section=S, sql=f"""
WITH x AS (SELECT rep, l_extendedprice AS y, l_quantity AS x, {mix_uniform_sql(["rep", "l_orderkey", "l_linenumber"], 0)} < 0.5 AS train
           FROM lineitem, (SELECT unnest(range(100)) AS rep)),
     s AS (SELECT rep, train, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(y * y) AS syy, sum(x * y) AS sxy FROM x GROUP BY 1, 2),
     tr AS (SELECT rep, n, sx, sy, sxx, sxy FROM s WHERE train), te AS (SELECT * FROM s WHERE NOT train),
     f AS (SELECT rep, (tr.n * tr.sxy - tr.sx * tr.sy) / (tr.n * tr.sxx - tr.sx * tr.sx) AS b, tr.sy AS try, tr.sx AS trx, tr.n AS trn FROM tr),
     g AS (SELECT rep, b, (try - b * trx) / trn AS a FROM f),
     per AS (SELECT sqrt((syy - 2 * a * sy - 2 * b * sxy + a * a * n + 2 * a * b * sx + b * b * sxx) / n) AS rmse FROM te JOIN g USING (rep))
SELECT count(*) AS replicates, round(avg(rmse), 3) AS mean_rmse, round(stddev_samp(rmse), 3) AS sd_rmse FROM per""")
def rmse_repeated_holdout(spark, sf):
    from quarry.functions.columns import mix_uniform
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    r = ml.repeated_holdout_rmse(li, "l_extendedprice", "l_quantity", ["l_orderkey", "l_linenumber"], 100,
                                 uniform=lambda *cs: mix_uniform(*cs, seed=0))
    return r.select("replicates", F.round("mean_rmse", 3).alias("mean_rmse"), F.round("sd_rmse", 3).alias("sd_rmse"))


def _doc_features(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "lang", "n_chars",
                                            F.size(F.regexp_extract_all("text", F.lit("[0-9]"), 0)).alias("n_digits"))
    lb = load(spark, sf, "labels")
    return lb.join(d, "doc_id").withColumn("log_chars", F.log1p("n_chars")).withColumn(
        "digit_share", F.col("n_digits") / F.greatest(F.col("n_chars"), F.lit(1)))


DOC_FEAT_SQL = """SELECT quality AS y, ln(1 + n_chars) AS x1, len(regexp_extract_all(text, '[0-9]')) / greatest(n_chars, 1) AS x2
FROM labels JOIN documents USING (doc_id)"""
CUST_POIS_SQL = """SELECT CAST(coalesce(n, 0) AS DOUBLE) AS y, c_acctbal / 1000 AS x1, CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END AS x2
FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders GROUP BY 1) USING (c_custkey)"""


VIF_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _det_sql(m):
    """Determinant of a small symbolic matrix (Leibniz expansion) as SQL."""
    import itertools
    n = len(m)
    terms = []
    for perm in itertools.permutations(range(n)):
        inv = sum(1 for i in range(n) for j in range(i + 1, n) if perm[i] > perm[j])
        prod = " * ".join(m[i][perm[i]] for i in range(n))
        terms.append(("- " if inv % 2 else "+ ") + f"({prod})")
    return "(" + " ".join(terms).lstrip("+ ") + ")"


def _vif_sql(cols):
    k = len(cols)
    r = [["1.0" if i == j else f"c{min(i, j)}_{max(i, j)}" for j in range(k)] for i in range(k)]
    corr = ", ".join(f"corr({cols[i]}, {cols[j]}) AS c{i}_{j}" for i in range(k) for j in range(i + 1, k))
    det = _det_sql(r)
    rows = []
    for i, c in enumerate(cols):
        minor = [[r[a][b] for b in range(k) if b != i] for a in range(k) if a != i]
        rows.append(f"SELECT '{c}' AS term, round({_det_sql(minor)} / {det}, 8) AS vif FROM c")
    return f"WITH c AS (SELECT {corr} FROM lineitem) " + " UNION ALL ".join(rows)


@register("vif", section=S, sql=_vif_sql(VIF_COLS))
def vif(spark, sf):
    v = ml.vif(load(spark, sf, "lineitem"), VIF_COLS)
    return v.select("term", F.round("vif", 8).alias("vif"))


def _irls_sql(data_sql: str, family: str, iters: int = 30) -> str:
    """IRLS for y ~ 1 + x1 + x2 (binomial/logit or poisson/log) unrolled into
    non-recursive CTE stages; each solves the 3x3 weighted normal equations
    by cofactors.  Returns the final stage with coefficients and SEs."""
    m = [["s00", "s01", "s02"], ["s01", "s11", "s12"], ["s02", "s12", "s22"]]
    det = _det_sql(m)

    def cof(i, j):
        minor = [[m[a][b] for b in range(3) if b != j] for a in range(3) if a != i]
        sign = "-" if (i + j) % 2 else ""
        return f"({sign}{_det_sql(minor)})"
    inv = [[f"({cof(j, i)} / {det})" for j in range(3)] for i in range(3)]  # inverse = adjugate / det
    if family == "binomial":
        mu, w = "(1 / (1 + exp(-eta)))", "(mu * (1 - mu))"
    else:
        mu, w = "exp(eta)", "mu"
    parts = [f"d AS ({data_sql})", "b0 AS (SELECT 0.0 AS c0, 0.0 AS c1, 0.0 AS c2)"]
    if family == "poisson":
        parts[-1] = "b0 AS (SELECT ln((SELECT avg(y) FROM d)) AS c0, 0.0 AS c1, 0.0 AS c2)"
    for k in range(1, iters + 1):
        stats = (f"SELECT sum(w) AS s00, sum(w * x1) AS s01, sum(w * x2) AS s02, sum(w * x1 * x1) AS s11, "
                 f"sum(w * x1 * x2) AS s12, sum(w * x2 * x2) AS s22, sum(w * z) AS t0, sum(w * x1 * z) AS t1, "
                 f"sum(w * x2 * z) AS t2 FROM (SELECT x1, x2, w, eta + (y - mu) / w AS z FROM "
                 f"(SELECT x1, x2, y, eta, mu, {w} AS w FROM (SELECT x1, x2, y, eta, {mu} AS mu FROM "
                 f"(SELECT x1, x2, y, c0 + c1 * x1 + c2 * x2 AS eta FROM d, b{k - 1}))))")
        sol = ", ".join(f"{inv[i][0]} * t0 + {inv[i][1]} * t1 + {inv[i][2]} * t2 AS c{i}" for i in range(3))
        ses = ", ".join(f"sqrt({inv[i][i]}) AS se{i}" for i in range(3))
        parts.append(f"b{k} AS (SELECT {sol}, {ses} FROM ({stats}))")
    return "WITH " + ",\n".join(parts) + f"\nSELECT * FROM b{iters}"


def _glm_oracle(data_sql: str, family: str, names: list[str], digits: int = 5) -> str:
    rows = [f"SELECT '{n}' AS term, round(c{i}, {digits}) AS estimate, round(se{i}, {digits}) AS std_error FROM f"
            for i, n in [(1, names[0]), (2, names[1]), (0, "(Intercept)")]]
    return f"WITH f AS ({_irls_sql(data_sql, family)}) " + " UNION ALL ".join(rows)


@register("glm_binomial", section=S, sql=_glm_oracle(DOC_FEAT_SQL, "binomial", ["log_chars", "digit_share"]))
def glm_binomial(spark, sf):
    t = ml.glm_table(_doc_features(spark, sf), "quality ~ log_chars + digit_share", "binomial")
    return t.select("term", F.round("estimate", 5).alias("estimate"), F.round("std_error", 5).alias("std_error"))


def _customer_counts(spark, sf):
    o = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    c = load(spark, sf, "customer").join(o, "c_custkey", "left")
    return c.select(F.coalesce("n", F.lit(0)).cast("double").alias("n_orders"), (F.col("c_acctbal") / 1000).alias("acctbal_k"),
                    (F.col("c_mktsegment") == "BUILDING").cast("double").alias("building"))


@register("glm_poisson", section=S, sql=_glm_oracle(CUST_POIS_SQL, "poisson", ["acctbal_k", "building"]))
def glm_poisson(spark, sf):
    t = ml.glm_table(_customer_counts(spark, sf), "n_orders ~ acctbal_k + building", "poisson")
    return t.select("term", F.round("estimate", 5).alias("estimate"), F.round("std_error", 5).alias("std_error"))


DOC_FEAT_PCT_SQL = DOC_FEAT_SQL.replace("AS x2", "* 100 AS x2")


@register("odds_ratios", section=S, sql=f"""
WITH f AS ({_irls_sql(DOC_FEAT_PCT_SQL, "binomial")}),
     t AS (SELECT 'log_chars' AS term, c1 AS b, se1 AS se FROM f UNION ALL SELECT 'digit_pct', c2, se2 FROM f
           UNION ALL SELECT '(Intercept)', c0, se0 FROM f)
SELECT term, round(exp(b), 4) AS odds_ratio, round(exp(b - 1.959963984540054 * se), 4) AS lo,
       round(exp(b + 1.959963984540054 * se), 4) AS hi FROM t""")
def odds_ratios(spark, sf):
    d = _doc_features(spark, sf).withColumn("digit_pct", F.col("digit_share") * 100)  # per percentage point
    t = ml.glm_table(d, "quality ~ log_chars + digit_pct", "binomial")
    o = ml.odds_ratio_table(t)
    return o.select("term", *[F.round(c, 4).alias(c) for c in ("odds_ratio", "lo", "hi")])


@register("logit_linearity", section=S, sql=f"""
WITH f AS ({_irls_sql(DOC_FEAT_SQL, "binomial")})
SELECT round(x1, 1) AS x_bin, round(avg(c0 + c1 * x1 + c2 * x2), 4) AS mean_logit, count(*) AS n FROM ({DOC_FEAT_SQL}), f GROUP BY 1""")
def logit_linearity(spark, sf):
    r = ml.logit_linearity(_doc_features(spark, sf), "quality", ["log_chars", "digit_share"], "log_chars", maxIter=300, tol=1e-13)
    return r.select("x_bin", F.round("mean_logit", 4).alias("mean_logit"), "n")


def _survey_sql() -> str:
    """Sandwich of the two-column fit by cofactors, and that of the one-column t-test."""
    cov = lambda a, b: (f"sum(CASE WHEN n > 1 THEN n / (n - 1.0) * (q{a}{b} - s{a} * s{b} / n) ELSE 0.0 END) AS b{a}{b}")
    pairs = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]
    fit = lambda res, fro: f"""SELECT h, j, sum(w * e) AS z0, sum(w * d1 * e) AS z1, sum(w * d2 * e) AS z2
          FROM (SELECT *, {res} AS e FROM (SELECT d.*, y - my AS dy, x1 - m1 AS d1, x2 - m2 AS d2, {fro} FROM d, b)) GROUP BY 1, 2"""  # noqa: E731
    meat = lambda z: f"""SELECT sum(n) AS psus, count(*) AS strata, {", ".join(cov(a, b) for a, b in pairs)} FROM (SELECT h, count(*) AS n,
          {", ".join(f"sum(z{i}) AS s{i}" for i in range(3))}, {", ".join(f"sum(z{a} * z{b}) AS q{a}{b}" for a, b in pairs)} FROM {z} GROUP BY h)"""  # noqa: E731
    return f"""
WITH d AS (SELECT l_discount AS y, l_tax AS x1, CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END AS x2, l_quantity AS w,
                  l_returnflag AS h, l_suppkey AS j FROM lineitem),
     m AS (SELECT sum(w) AS sw, sum(w * y) / sum(w) AS my, sum(w * x1) / sum(w) AS m1, sum(w * x2) / sum(w) AS m2 FROM d),
     c AS (SELECT sum(w * (x1 - m1) * (x1 - m1)) AS s11, sum(w * (x2 - m2) * (x2 - m2)) AS s22, sum(w * (x1 - m1) * (x2 - m2)) AS s12,
                  sum(w * (x1 - m1) * (y - my)) AS s1y, sum(w * (x2 - m2) * (y - my)) AS s2y FROM d, m),
     b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2,
                  s22 / (s11 * s22 - s12 * s12) AS i11, s11 / (s11 * s22 - s12 * s12) AS i22, -s12 / (s11 * s22 - s12 * s12) AS i12,
                  1 / sw AS i00, s2y / s22 AS bt FROM c, m),
     z AS ({fit("dy - b1 * d1 - b2 * d2", "b1, b2")}), g AS ({meat("z")}),
     zt AS ({fit("dy - bt * d2", "bt")}), gt AS ({meat("zt")}),
     v AS (SELECT *, i11 * i11 * b11 + 2 * i11 * i12 * b12 + i12 * i12 * b22 AS v11, i12 * i12 * b11 + 2 * i12 * i22 * b12 + i22 * i22 * b22 AS v22,
                  i11 * i12 * b11 + (i11 * i22 + i12 * i12) * b12 + i12 * i22 * b22 AS v12, i00 * i00 * b00 AS v00,
                  i00 * (b01 * i11 + b02 * i12) AS v01, i00 * (b01 * i12 + b02 * i22) AS v02 FROM b, g),
     r AS (SELECT 'glm' AS part, 'l_tax' AS term, b1 AS estimate, sqrt(v11) AS se, psus - strata - 2 AS df FROM v
           UNION ALL SELECT 'glm', 'is_open', b2, sqrt(v22), psus - strata - 2 FROM v
           UNION ALL SELECT 'glm', '(Intercept)', my - b1 * m1 - b2 * m2,
                  sqrt(v00 - 2 * (m1 * v01 + m2 * v02) + m1 * m1 * v11 + 2 * m1 * m2 * v12 + m2 * m2 * v22), psus - strata - 2 FROM v
           UNION ALL SELECT 'ttest', 'difference', bt, sqrt(b22) / s22, psus - strata - 1 FROM gt, b)
SELECT part, term, round(estimate, 10) AS estimate, round(se, 10) AS std_error, round(estimate / se, 5) AS t_value, CAST(df AS DOUBLE) AS df,
       round({_t_tail_sql("(estimate / se)", "df")}, 6) AS p_value FROM r"""


@register("survey_glm_ttest", section=S, sql=_survey_sql())
def survey_glm_ttest(spark, sf):
    li = load(spark, sf, "lineitem")
    design = dict(weight="l_quantity", strata="l_returnflag", psu="l_suppkey")
    fit = survey.survey_lm(li, "l_discount", {"l_tax": "l_tax", "is_open": (F.col("l_linestatus") == "O").cast("double")}, **design)
    test = survey.survey_ttest(li, "l_discount", "l_linestatus", "F", "O", **design)
    both = fit.withColumn("part", F.lit("glm")).unionByName(test.withColumn("part", F.lit("ttest")))
    return both.select("part", "term", F.round("estimate", 10).alias("estimate"), F.round("std_error", 10).alias("std_error"),
                       F.round("t_value", 5).alias("t_value"), "df", F.round("p_value", 6).alias("p_value"))
