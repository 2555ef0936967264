"""Normal distribution function and quantile against the standard library."""

import math
from statistics import NormalDist

from pyspark.sql import functions as F

from quarry.functions.distributions import norm_cdf, norm_ppf


def close(a, b, rel=1e-13):
    return math.isclose(a, b, rel_tol=rel, abs_tol=0.0)


def test_distribution_function_keeps_relative_accuracy(spark):
    zs = [i / 37 for i in range(-1400, 1401)] + [0.67448975, math.sqrt(32), -math.sqrt(32)]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select("z", norm_cdf("z").alias("p")).collect()
    assert len(got) == len(zs)
    for r in got:
        assert close(r.p, 0.5 * math.erfc(-r.z / math.sqrt(2)), 1e-13 if abs(r.z) < 10 else 1e-11), r


def test_distribution_function_at_the_ends(spark):
    rows = [(math.inf,), (-math.inf,), (50.0,), (-50.0,), (0.0,), (None,), (math.nan,)]
    got = [r.p for r in spark.createDataFrame(rows, "z double").coalesce(1).select(norm_cdf("z").alias("p")).collect()]
    assert got[:6] == [1.0, 0.0, 1.0, 0.0, 0.5, None] and math.isnan(got[6])


def test_quantile(spark):
    ps = [10.0 ** -k for k in range(1, 300, 7)] + [i / 1001 for i in range(1, 1001)] + [1 - 1e-12, 0.075, 0.925]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select("p", norm_ppf("p").alias("z")).collect()
    for r in got:
        assert math.isclose(r.z, NormalDist().inv_cdf(r.p), rel_tol=1e-13, abs_tol=1e-15), r
    back = spark.createDataFrame([(p,) for p in ps], "p double").select("p", norm_cdf(norm_ppf("p")).alias("b")).collect()
    assert all(close(r.b, r.p, 1e-11) for r in back)


def test_quantile_outside_its_range(spark):
    rows = [(0.0,), (1.0,), (-1.0,), (2.0,), (None,)]
    assert spark.createDataFrame(rows, "p double").where(norm_ppf(F.col("p")).isNotNull()).count() == 0
