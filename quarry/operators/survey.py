"""Design-based regression and t-test.

Rows carry a weight, a stratum and a primary sampling unit (PSU).  The fit is
weighted least squares on centred columns; its variance is the sandwich
A^-1 B A^-1, with A the weighted cross products and B the between-PSU
covariance of score totals inside strata (with-replacement PSUs):

    B = sum_h n_h / (n_h - 1) * sum_j (z_hj - mean_h)(z_hj - mean_h)'

Scores are summed per (stratum, PSU) in the tasks before the shuffle, so a PSU
with a third of the rows is one row per task; totals are then summed per
stratum.  The driver sees three rows of (number of columns)^2 sums.

n_h counts every PSU of the stratum, also those whose rows all lack a value or
lie outside the domain: they have score zero.  Strata with one PSU add nothing.
Degrees of freedom are PSUs less strata among the rows used, less slopes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import col_of, join_null_safe
from quarry.functions.special import t_pvalue, t_quantile

SCHEMA = "term string, estimate double, std_error double, t_value double, df double"


def survey_lm(df: DataFrame, y: str | Column, xs: dict[str, str | Column], weight: str, strata: str, psu: str,
              domain: Column | None = None, level: float = 0.95) -> DataFrame:
    """``svyglm(y ~ xs, design)``, gaussian: term, estimate, std_error, t_value,
    df, p_value, lo, hi for every column of ``xs`` (name -> column) and the
    intercept.  ``domain`` keeps a part of the design (``subset``); rows with a
    null value or weight, or weight zero, are not used."""
    p = len(xs)
    base = df.select(col_of(y).cast("double").alias("y"), F.col(weight).cast("double").alias("w"), F.col(strata).alias("h"),
                     F.col(psu).alias("j"), *[col_of(c).cast("double").alias(f"x{i}") for i, c in enumerate(xs.values(), 1)],
                     (domain if domain is not None else F.lit(True)).alias("inside"))
    used = base.where(F.col("inside") & (F.col("w") != 0)).na.drop(subset=["y", "w", *[f"x{i}" for i in range(1, p + 1)]]).drop("inside")
    names = ["y", *[f"x{i}" for i in range(1, p + 1)]]
    first = used.agg(F.sum("w").alias("w"), *[(F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(c) for c in names]).first()
    if not first["w"]:
        raise ValueError("no row with a weight")
    centre = used.withColumns({c: F.col(c) - first[c] for c in names})
    cross = centre.agg(*[F.sum(F.col("w") * F.col(a) * F.col(b)).alias(f"{a}_{b}") for a in names[1:] for b in names]).first()
    a_mat = np.array([[cross[f"{a}_{b}"] for b in names[1:]] for a in names[1:]]).reshape(p, p)
    if np.linalg.matrix_rank(a_mat, hermitian=True) < p:
        raise ValueError("the columns are linearly dependent")
    slopes = np.linalg.solve(a_mat, np.array([cross[f"{a}_y"] for a in names[1:]]))
    bread = np.zeros((p + 1, p + 1))
    bread[0, 0], bread[1:, 1:] = 1 / first["w"], np.linalg.inv(a_mat)

    resid = F.col("y")
    for c, b in zip(names[1:], slopes.tolist()):
        resid = resid - F.lit(b) * F.col(c)
    scores = [F.col("w") * resid, *[F.col("w") * F.col(c) * resid for c in names[1:]]]
    psus = centre.groupBy("h", "j").agg(*[F.sum(s).alias(f"z{i}") for i, s in enumerate(scores)])
    size = base.select("h", "j").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    pairs = [(a, b) for a in range(p + 1) for b in range(a, p + 1)]
    totals = psus.groupBy("h").agg(F.count(F.lit(1)).alias("m"), *[F.sum(f"z{i}").alias(f"s{i}") for i in range(p + 1)],
                                   *[F.sum(F.col(f"z{a}") * F.col(f"z{b}")).alias(f"q{a}_{b}") for a, b in pairs])
    part = lambda a, b: F.when(F.col("n") > 1, F.col("n") / (F.col("n") - 1) * (
        F.col(f"q{a}_{b}") - F.col(f"s{a}") * F.col(f"s{b}") / F.col("n"))).otherwise(0.0)
    got = join_null_safe(totals, size, ["h"]).agg(
        (F.sum("m") - F.count(F.lit(1))).alias("degf"), *[F.sum(part(a, b)).alias(f"b{a}_{b}") for a, b in pairs]).first()
    meat = np.array([[got[f"b{min(a, b)}_{max(a, b)}"] for b in range(p + 1)] for a in range(p + 1)])
    # back from centred columns: intercept = mean - slopes * means
    back = np.eye(p + 1)
    means = np.array([first[c] for c in names[1:]])
    back[0, 1:] = -means
    var = np.diag(back @ bread @ meat @ bread @ back.T)
    est = np.append(first["y"] - slopes @ means, slopes)
    rows = [(n, float(e), float(s), float(e / s) if s > 0 else None, float(got["degf"] - p))
            for n, e, s in zip(["(Intercept)", *xs], est, np.sqrt(np.maximum(var, 0)))]
    out = df.sparkSession.createDataFrame(rows, SCHEMA)
    half = t_quantile(F.lit(0.5 + level / 2), F.col("df")) * F.col("std_error")
    return out.withColumns({"p_value": t_pvalue(F.col("t_value"), F.col("df")), "lo": F.col("estimate") - half, "hi": F.col("estimate") + half})


def survey_ttest(df: DataFrame, y: str | Column, group: str, a, b, weight: str, strata: str, psu: str) -> DataFrame:
    """``svyttest(y ~ group, design)`` for groups ``a`` and ``b``: the design-based
    difference of their means (b less a) with t, df, p and interval."""
    of = F.col(group)
    fit = survey_lm(df, y, {"difference": (of == F.lit(b)).cast("double")}, weight, strata, psu, domain=of.isin([a, b]))
    return fit.where(F.col("term") == "difference")
