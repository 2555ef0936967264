"""Statistical tests and regression from grouped moments.

Every statistic is a closed form over sufficient statistics gathered in one
map-side-combined aggregation (counts, sums, sums of squares and cross
products), so the data is read once and nothing but tiny per-group rows is
shuffled.  P-values are applied to those tiny rows with the special
function helpers.  MLlib is used where a solver is needed (GLM).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.columns import col_of, join_null_safe
from quarry.functions.special import chi2_pvalue, f_pvalue, t_pvalue, t_quantile
from quarry.operators.windows import running_sums

Z975 = 1.959963984540054  # fixed value: standard normal 97.5 % quantile


def moments(df: DataFrame, by: Sequence[str], x: str) -> DataFrame:
    """n, mean, sample variance of ``x`` per group."""
    return df.where(F.col(x).isNotNull()).groupBy(*by).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_samp(x).alias("var"))


def t_test_welch(df: DataFrame, x: str, group: str, a, b) -> DataFrame:
    """``t.test(x ~ g)`` (Welch): t, df, p, means and 95 % CI of a-b."""
    m = moments(df.where(F.col(group).isin(a, b)), [group], x)
    ga = m.where(F.col(group) == a).select(*[F.col(c).alias(f"{c}_a") for c in ("n", "mean", "var")])
    gb = m.where(F.col(group) == b).select(*[F.col(c).alias(f"{c}_b") for c in ("n", "mean", "var")])
    sa = ga.select(F.struct("*").alias("s")).scalar()
    r = gb.select(*[sa.getField(c).alias(c) for c in ("n_a", "mean_a", "var_a")], "n_b", "mean_b", "var_b")
    va, vb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    r = r.withColumn("se", F.sqrt(va + vb)) \
        .withColumn("t", F.try_divide(F.col("mean_a") - F.col("mean_b"), F.col("se"))) \
        .withColumn("df", F.try_divide(F.pow(va + vb, 2), F.pow(va, 2) / (F.col("n_a") - 1) + F.pow(vb, 2) / (F.col("n_b") - 1)))
    return r.withColumn("p_value", t_pvalue(F.col("t"), F.col("df")))


def t_test_per_position(df: DataFrame, arr: str, group: Column) -> DataFrame:
    """``colttests``: Welch t per array position between group TRUE/FALSE;
    positions are exploded and all tests run in one grouped aggregation."""
    e = df.select(group.alias("_g"), F.posexplode(arr).alias("pos", "v")).withColumn("v", F.col("v").cast("double"))
    m = e.groupBy("pos").agg(
        *[F.count(F.when(F.col("_g") == g, F.col("v"))).alias(f"n_{s}") for g, s in ((True, "a"), (False, "b"))],
        *[F.avg(F.when(F.col("_g") == g, F.col("v"))).alias(f"mean_{s}") for g, s in ((True, "a"), (False, "b"))],
        *[F.var_samp(F.when(F.col("_g") == g, F.col("v"))).alias(f"var_{s}") for g, s in ((True, "a"), (False, "b"))])
    va, vb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    return m.withColumn("t", F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(va + vb))) \
        .withColumn("df", F.try_divide(F.pow(va + vb, 2), F.pow(va, 2) / (F.col("n_a") - 1) + F.pow(vb, 2) / (F.col("n_b") - 1))) \
        .withColumn("p_value", t_pvalue(F.col("t"), F.col("df")))


def chi_square_test(df: DataFrame, x: str | Column, y: str | Column, yates: bool = True) -> DataFrame:
    """Pearson chi-square of independence; Yates' continuity correction on
    2x2 tables as R's ``chisq.test`` does by default.

    The cells are counted once, with margins from windows over the few
    cells.  Uncorrected: sum (O-E)^2/E = N (sum O^2/(row col) - 1), over
    non-empty cells only.  In a 2x2 table |O-E| is the same d in all cells, and
    the corrected statistic is (d - min(0.5, d))^2 N^3 / (product of margins)."""
    cells = df.select(col_of(x).alias("_x"), col_of(y).alias("_y")).where(F.col("_x").isNotNull() & F.col("_y").isNotNull()) \
        .groupBy("_x", "_y").agg(F.count(F.lit(1)).cast("double").alias("o"))
    g = cells.withColumns({"rx": F.sum("o").over(Window.partitionBy("_x")), "cy": F.sum("o").over(Window.partitionBy("_y"))})
    t = g.agg(F.sum("o").alias("n"), F.sum(F.col("o") * F.col("o") / (F.col("rx") * F.col("cy"))).alias("s"),
              F.count_distinct("_x").alias("r"), F.count_distinct("_y").alias("c"),
              F.min("rx").alias("r1"), F.min("cy").alias("c1"), F.max(F.struct("o", "rx", "cy")).alias("a"))
    n, r1, c1 = F.col("n"), F.col("r1"), F.col("c1")
    plain = n * (F.col("s") - 1)
    if yates:
        d = F.abs(F.col("a.o") - F.col("a.rx") * F.col("a.cy") / n)
        two = F.pow(d - F.least(F.lit(0.5), d), 2) * F.pow(n, 3) / (r1 * (n - r1) * c1 * (n - c1))
        plain = F.when((F.col("r") == 2) & (F.col("c") == 2), two).otherwise(plain)
    out = t.select(plain.alias("statistic"), ((F.col("r") - 1) * (F.col("c") - 1)).alias("df"))
    return out.withColumn("p_value", chi2_pvalue(F.col("statistic"), F.col("df")))


def prop_test_two(counts: DataFrame, group: str, successes: str, trials: str, a, b) -> DataFrame:
    """``prop.test(c(x1, x2), c(n1, n2), correct = FALSE)``: estimates,
    X-squared (pooled z^2), p and 95 % CI of p1 - p2."""
    sa = counts.where(F.col(group) == a).select(F.struct(F.col(successes).alias("x"), F.col(trials).alias("n")).alias("s")).scalar()
    r = counts.where(F.col(group) == b).select(sa.getField("x").alias("x1"), sa.getField("n").alias("n1"),
                                               F.col(successes).alias("x2"), F.col(trials).alias("n2"))
    p1, p2 = F.col("x1") / F.col("n1"), F.col("x2") / F.col("n2")
    pp = (F.col("x1") + F.col("x2")) / (F.col("n1") + F.col("n2"))
    z2 = F.try_divide(F.pow(p1 - p2, 2), pp * (1 - pp) * (1 / F.col("n1") + 1 / F.col("n2")))
    se = F.sqrt(p1 * (1 - p1) / F.col("n1") + p2 * (1 - p2) / F.col("n2"))
    return r.select(p1.alias("estimate1"), p2.alias("estimate2"), z2.alias("statistic"),
                    (p1 - p2 - Z975 * se).alias("ci_lo"), (p1 - p2 + Z975 * se).alias("ci_hi")) \
        .withColumn("p_value", chi2_pvalue(F.col("statistic"), F.lit(1)))


def jarque_bera(df: DataFrame, x: str, by: Sequence[str] = ()) -> DataFrame:
    """JB = n/6 (S^2 + (K-3)^2/4) with population moments; p from chi2(2)."""
    g = df.where(F.col(x).isNotNull()).groupBy(*by).agg(
        F.count(x).alias("n"), F.skewness(x).alias("skew"), F.kurtosis(x).alias("excess"))
    return g.withColumn("jb", F.col("n") / 6 * (F.pow("skew", 2) + F.pow("excess", 2) / 4)) \
        .withColumn("p_value", chi2_pvalue(F.col("jb"), F.lit(2)))


def anova_one_way(df: DataFrame, y: str, group: str) -> DataFrame:
    """``anova(lm(y ~ g))`` from grouped means and variances (no raw sums of
    squares, which cancel where the mean is large): SS between / within, F, p."""
    m = df.where(F.col(y).isNotNull()).groupBy(group).agg(F.count(y).alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("v"))
    grand = m.agg(F.sum(F.col("n") * F.col("mean")) / F.sum("n")).scalar()
    out = m.withColumn("apart", F.col("n") * F.pow(F.col("mean") - grand, 2)).agg(
        F.sum("apart").alias("ss_between"), F.sum(F.col("n") * F.col("v")).alias("ss_within"),
        (F.count(F.lit(1)) - 1).alias("df_between"), (F.sum("n") - F.count(F.lit(1))).alias("df_within"))
    out = out.withColumn("f", F.try_divide(F.try_divide(F.col("ss_between"), F.col("df_between")),
                                           F.try_divide(F.col("ss_within"), F.col("df_within"))))
    return out.withColumn("p_value", f_pvalue(F.col("f"), F.col("df_between"), F.col("df_within")))


def posthoc_pairwise(df: DataFrame, y: str, group: str) -> DataFrame:
    """All pairs of group means with pooled-MSE standard error and t.  The
    pair table is levels x levels of the (small) factor."""
    m = df.where(F.col(y).isNotNull()).groupBy(group).agg(F.count(y).alias("n"), F.avg(y).alias("mean"),
                                                          F.var_samp(y).alias("var"))
    pooled = m.agg(F.struct(F.try_divide(F.sum((F.col("n") - 1) * F.col("var")), F.sum("n") - F.count(F.lit(1))).alias("mse"),
                            (F.sum("n") - F.count(F.lit(1))).alias("dfw")).alias("s")).scalar()
    # pairs g1 < g2 as an equi-join: each level lists the greater levels
    # (the factor's level list is a one-row array bounded by its levels)
    levels = m.agg(F.array_sort(F.collect_list(group)).alias("lv")).scalar()
    a = m.withColumn("_lv", levels).select(F.col(group).alias("g1"), F.col("n").alias("n1"), F.col("mean").alias("mean1"),
                                           F.explode(F.filter(F.col("_lv"), lambda x: x > F.col(group))).alias("g2"))
    b = m.select(F.col(group).alias("g2"), F.col("n").alias("n2"), F.col("mean").alias("mean2"))
    p = a.join(b, "g2")
    se = F.sqrt(pooled.getField("mse") * (1 / F.col("n1") + 1 / F.col("n2")))
    out = p.select("g1", "g2", (F.col("mean1") - F.col("mean2")).alias("diff"), se.alias("se"))
    return out.withColumn("t", F.try_divide(F.col("diff"), F.col("se"))) \
        .withColumn("p_value", t_pvalue(F.col("t"), pooled.getField("dfw")))


def simple_regression(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """OLS y = a + b x per group: slope, intercept, R^2, n, slope SE,
    t-based 95 % CI of the slope -- all from grouped sums."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    g = d.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("slope"),
                           F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
                           F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"))
    sse = F.col("syy") - F.col("slope") * F.col("sxy")
    g = g.withColumn("slope_se", F.sqrt(F.try_divide(F.try_divide(sse, F.col("n") - 2), F.col("sxx"))))
    tq = t_quantile(F.lit(0.975), F.col("n") - 2)
    return g.withColumn("slope_lo", F.col("slope") - tq * F.col("slope_se")) \
        .withColumn("slope_hi", F.col("slope") + tq * F.col("slope_se"))


def ols_two(df: DataFrame, y: str, x1: str, x2: str, by: Sequence[str] = ()) -> DataFrame:
    """``lm(y ~ x1 + x2)`` closed form from centred cross products."""
    d = df.where(F.col(y).isNotNull() & F.col(x1).isNotNull() & F.col(x2).isNotNull())
    g = d.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("my"), F.avg(x1).alias("m1"), F.avg(x2).alias("m2"),
                           F.covar_samp(x1, x1).alias("s11"), F.covar_samp(x2, x2).alias("s22"),
                           F.covar_samp(x1, x2).alias("s12"), F.covar_samp(x1, y).alias("s1y"),
                           F.covar_samp(x2, y).alias("s2y"))
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    b1 = F.try_divide(F.col("s22") * F.col("s1y") - F.col("s12") * F.col("s2y"), det)
    b2 = F.try_divide(F.col("s11") * F.col("s2y") - F.col("s12") * F.col("s1y"), det)
    return g.select(*by, "n", b1.alias("b1"), b2.alias("b2"),
                    (F.col("my") - b1 * F.col("m1") - b2 * F.col("m2")).alias("intercept"))


def lm_summary(df: DataFrame, y: str | Column, xs: dict[str, str | Column], level: float = 0.95) -> DataFrame:
    """``summary(lm(y ~ xs))`` and ``confint``: term, estimate, std_error, t_value,
    p_value, lo, hi for the columns ``xs`` (name -> column) and the intercept.

    Three aggregations: means, cross products of centred columns, and the sum
    of squared residuals (so that nothing cancels however large the means); the
    driver sees (columns)^2 sums.  Rows with a null are left out."""
    p = len(xs)
    names = ["y", *[f"x{i}" for i in range(p)]]
    data = df.select(*[col_of(c).cast("double").alias(n) for n, c in zip(names, [y, *xs.values()])]).na.drop()
    first = data.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in names]).first()
    rest = first["n"] - p - 1
    if rest <= 0:
        raise ValueError("fewer rows than coefficients")
    centre = data.select(*[(F.col(c) - first[c]).alias(c) for c in names])
    cross = centre.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a in names[1:] for b in names]).first()
    a_mat = np.array([[cross[f"{a}_{b}"] for b in names[1:]] for a in names[1:]]).reshape(p, p)
    scale = np.sqrt(np.diag(a_mat))
    if (scale == 0).any() or np.linalg.matrix_rank(a_mat / np.outer(scale, scale), hermitian=True) < p:
        raise ValueError("the columns are linearly dependent")
    inverse = np.linalg.inv(a_mat / np.outer(scale, scale)) / np.outer(scale, scale)
    slopes = inverse @ np.array([cross[f"{a}_y"] for a in names[1:]])
    fitted = F.lit(0.0)
    for c, b in zip(names[1:], slopes.tolist()):
        fitted = fitted + F.lit(b) * F.col(c)
    sigma2 = centre.agg(F.sum(F.pow(F.col("y") - fitted, 2))).first()[0] / rest
    means = np.array([first[c] for c in names[1:]])
    var = sigma2 * np.append(1 / first["n"] + means @ inverse @ means, np.diag(inverse))
    est = np.append(first["y"] - slopes @ means, slopes)
    rows = [(t, float(e), float(s), float(e / s) if s > 0 else None) for t, e, s in zip(["(Intercept)", *xs], est, np.sqrt(var))]
    out = df.sparkSession.createDataFrame(rows, "term string, estimate double, std_error double, t_value double")
    half = t_quantile(F.lit(0.5 + level / 2), F.lit(float(rest))) * F.col("std_error")
    return out.withColumns({"p_value": t_pvalue(F.col("t_value"), F.lit(float(rest))), "lo": F.col("estimate") - half, "hi": F.col("estimate") + half})


#: Levels that a factor may have in a regression: each makes columns of the fit.
MAX_LEVELS = 500


def treatment_columns(df: DataFrame, x: str, g: str, max_levels: int = MAX_LEVELS) -> dict[str, Column]:
    """Columns of ``x * g`` with R's treatment contrasts: the base is the first
    level in order; other levels have a dummy and a slope.  A factor with more
    than ``max_levels`` levels is refused before they reach the driver."""
    rows = df.where(F.col(g).isNotNull()).select(g).distinct().limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"{g} has more than {max_levels} levels")
    others = sorted(r[0] for r in rows)[1:]
    # a null level makes the row incomplete, as in R
    dummy = lambda lv: F.when(F.col(g).isNotNull(), (F.col(g) == F.lit(lv)).cast("double"))
    return {x: F.col(x).cast("double")} | {f"{g}{lv}": dummy(lv) for lv in others} | {f"{x}:{g}{lv}": F.col(x) * dummy(lv) for lv in others}


def fitted_residuals(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """``augment``: fitted value and residual of y ~ x per row."""
    co = df.groupBy(*by).agg(F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"))
    j = df.join(co, list(by)) if by else df.withColumns(
        {"_b": co.select("_b").scalar(), "_a": co.select("_a").scalar()})
    fit = F.col("_a") + F.col("_b") * F.col(x)
    return j.withColumn("fitted", fit).withColumn("residual", F.col(y) - fit).drop("_a", "_b")


def shrunken_slopes(df: DataFrame, y: str, x: str, group: str) -> DataFrame:
    """Random-slope model re-aimed as empirical Bayes: per-group OLS slope
    b_g with sampling variance v_g, overall precision-weighted slope, tau^2
    by moments, shrunk slope = b + tau^2/(tau^2 + v_g) (b_g - b)."""
    r = simple_regression(df, y, x, [group]).where(F.col("n") > 2) \
        .withColumn("v", F.pow("slope_se", 2)).where(F.col("v") > 0)
    s = r.agg(F.struct((F.sum(F.col("slope") / F.col("v")) / F.sum(1 / F.col("v"))).alias("b"),
                       F.greatest(F.lit(0.0), F.var_samp("slope") - F.avg("v")).alias("tau2")).alias("s")).scalar()
    w = s.getField("tau2") / (s.getField("tau2") + F.col("v"))
    return r.select(group, "n", "slope", "v", s.getField("b").alias("overall"), s.getField("tau2").alias("tau2"),
                    (s.getField("b") + w * (F.col("slope") - s.getField("b"))).alias("shrunk"))


def shrunken_means(train: DataFrame, test: DataFrame, group: str, x: str, alphas: Sequence[float]) -> DataFrame:
    """Regularised group means overall + sum(x - overall)/(n + alpha); each
    alpha scored by RMSE on held-out rows.  Returns alpha, rmse."""
    mu = train.agg(F.avg(x)).scalar()
    g = train.groupBy(group).agg(F.sum(F.col(x) - mu).alias("dev"), F.count(F.lit(1)).alias("n"))
    grid = g.withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))
    pred = grid.select(group, "alpha", (mu + F.col("dev") / (F.col("n") + F.col("alpha"))).alias("pred"))
    t = test.select(group, x).withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas]))) \
        .join(pred, [group, "alpha"], "left").withColumn("pred", F.coalesce("pred", F.lit(mu)))
    return t.groupBy("alpha").agg(F.sqrt(F.avg(F.pow(F.col(x) - F.col("pred"), 2))).alias("rmse"))


def survey_mean(df: DataFrame, x: str, weight: str, strata: str, psu: str, domain: str | None = None) -> DataFrame:
    """Design-based weighted mean with Taylor-linearised SE (stratified,
    with-replacement PSUs), optionally per domain (``svyby``).

    z_i = w_i (x_i - mean_d) / W_d for rows of domain d; PSU totals z_hj;
    per stratum n_h/(n_h - 1) * (sum_j z_hj^2 - n_h zbar_h^2) where n_h
    counts every PSU of the stratum (PSUs without domain rows have z = 0,
    so they enter only through n_h).  Strata with one PSU add 0."""
    dom = F.col(domain) if domain else F.lit("all")
    base = df.where(F.col(x).isNotNull())
    d = base.select(dom.alias("domain"), F.col(x).alias("x"), F.col(weight).alias("w"),
                    F.col(strata).alias("h"), F.col(psu).alias("j"))
    est = d.groupBy("domain").agg(F.try_divide(F.sum(F.col("w") * F.col("x")), F.sum("w")).alias("mean"), F.sum("w").alias("wsum"))
    # a domain may hold half the rows, so its mean meets PSU sums, not rows: sum of w (x - mean) = sum of w x - mean * sum of w
    psu_s = d.groupBy("domain", "h", "j").agg(F.sum(F.col("w") * F.col("x")).cast("double").alias("wx"), F.sum("w").cast("double").alias("w"))
    psu_t = psu_s.join(est, "domain").withColumn("zt", F.try_divide(F.col("wx") - F.col("mean") * F.col("w"), F.col("wsum")))
    nh = base.groupBy(F.col(strata).alias("h")).agg(F.count_distinct(psu).alias("nh"))
    st = psu_t.groupBy("domain", "h").agg(F.sum("zt").alias("zs"), F.sum(F.col("zt") * F.col("zt")).alias("zz")) \
        .join(nh, "h")
    var_h = F.when(F.col("nh") > 1, F.col("nh") / (F.col("nh") - 1)
                   * (F.col("zz") - F.col("zs") * F.col("zs") / F.col("nh"))).otherwise(F.lit(0.0))
    v = st.groupBy("domain").agg(F.sum(var_h).alias("var"))
    return est.join(v, "domain").select("domain", "mean", F.sqrt("var").alias("se"))


def kaplan_meier(df: DataFrame, time: str, event: str, by: Sequence[str] = ()) -> DataFrame:
    """Survival curve per group: at each distinct time the number at risk
    (reverse cumulative count), events d, and S(t) = prod(1 - d/n)."""
    t = df.groupBy(*by, time).agg(F.count(F.lit(1)).alias("n_exit"), F.sum(F.col(event).cast("long")).alias("n_event"))
    t = _at_or_after(t, by, time, {"n_risk": "n_exit"})
    dead = F.col("n_event") >= F.col("n_risk")
    log = F.when(~dead, F.log1p(-F.col("n_event") / F.col("n_risk"))).otherwise(F.lit(0.0))
    t = running_sums(t, list(by), [time], {"_logs": log, "_dead": dead.cast("long")})
    return t.withColumn("surv", F.when(F.col("_dead") > 0, F.lit(0.0)).otherwise(F.exp("_logs"))).drop("_logs", "_dead")


def _at_or_after(t: DataFrame, by: Sequence[str], order: str, sums: dict[str, str]) -> DataFrame:
    """Sums over the rows at or after each row in ``order``: the group's total
    less the distributed running sum before the row."""
    run = running_sums(t, list(by), [order], {f"_upto_{k}": F.col(c) for k, c in sums.items()})
    total = t.groupBy(*by).agg(*[F.sum(c).alias(f"_all_{k}") for k, c in sums.items()])
    run = join_null_safe(run, total, list(by)) if by else run.withColumns(
        {f"_all_{k}": total.select(f"_all_{k}").scalar() for k in sums})
    return run.withColumns({k: F.col(f"_all_{k}") - F.col(f"_upto_{k}") + F.col(c) for k, c in sums.items()}) \
        .drop(*[f"_upto_{k}" for k in sums], *[f"_all_{k}" for k in sums])


def log_rank(df: DataFrame, time: str, event: str, group: str, a, b) -> DataFrame:
    """``survdiff(rho = 0)`` for two groups: observed and expected events of
    group a, variance, chi-square (1 df) and p."""
    d = df.where(F.col(group).isin(a, b)).withColumn("_a", (F.col(group) == a).cast("long"))
    t = d.groupBy(time).agg(F.count(F.lit(1)).alias("m"), F.sum("_a").alias("m_a"),
                            F.sum(F.col(event).cast("long")).alias("dd"),
                            F.sum(F.col(event).cast("long") * F.col("_a")).alias("d_a"))
    t = _at_or_after(t, (), time, {"n": "m", "n_a": "m_a"})
    e = F.col("dd") * F.col("n_a") / F.col("n")
    v = F.when(F.col("n") > 1, F.col("dd") * (F.col("n_a") / F.col("n")) * (1 - F.col("n_a") / F.col("n"))
               * (F.col("n") - F.col("dd")) / (F.col("n") - 1)).otherwise(F.lit(0.0))
    s = t.agg(F.sum("d_a").alias("observed"), F.sum(e).alias("expected"), F.sum(v).alias("variance"))
    return s.withColumn("chisq", F.when(F.col("variance") > 0,
                                        F.pow(F.col("observed") - F.col("expected"), 2) / F.col("variance"))) \
        .withColumn("p_value", chi2_pvalue(F.col("chisq"), F.lit(1)))


def normal_tail_columns(df: DataFrame, x: str, alpha: float = 0.05) -> DataFrame:
    """Tail probability P(X <= x) and density under a normal fitted to the
    column, plus the lower alpha cut-off (fitted mean/sd as a scalar)."""
    from quarry.functions.distributions import norm_cdf, norm_pdf, norm_ppf
    st = df.agg(F.struct(F.avg(x).alias("m"), F.stddev_samp(x).alias("s")).alias("s")).scalar()
    z = (F.col(x) - st.getField("m")) / st.getField("s")
    return df.withColumns({"p_lower": norm_cdf(z), "density": norm_pdf(z) / st.getField("s"),
                           "cutoff": st.getField("m") + st.getField("s") * norm_ppf(F.lit(alpha))})
