"""Design-based regression against a plain numpy fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators.survey import survey_lm, survey_ttest


def brute(rows, p):
    """rows: (y, xs..., w, h, j, inside); estimates, standard errors, degrees of freedom."""
    psus = {(r[-3], r[-2]) for r in rows}
    used = [r for r in rows if r[-1] and None not in r[:p + 2] and r[p + 1]]
    x = np.array([[1.0, *r[1:p + 1]] for r in used])
    y, w = np.array([r[0] for r in used]), np.array([r[p + 1] for r in used])
    bread = np.linalg.inv(x.T @ (w[:, None] * x))
    beta = bread @ x.T @ (w * y)
    score = (w * (y - x @ beta))[:, None] * x
    z = {k: np.zeros(p + 1) for k in psus}
    for r, s in zip(used, score):
        z[r[-3], r[-2]] += s
    meat = np.zeros((p + 1, p + 1))
    for h in {h for h, _ in psus}:
        of = np.array([v for (a, _), v in z.items() if a == h])
        if len(of) > 1:
            d = of - of.mean(0)
            meat += len(of) / (len(of) - 1) * d.T @ d
    there = {(r[-3], r[-2]) for r in used}
    return beta, np.sqrt(np.diag(bread @ meat @ bread)), len(there) - len({h for h, _ in there}) - p


@pytest.fixture(scope="module")
def rows():
    rnd = np.random.default_rng(6)
    out = []
    for i in range(600):
        h, j = int(rnd.integers(0, 5)), int(rnd.integers(0, 7))
        h = None if h == 4 else h
        x1, x2 = float(rnd.normal(1e4, 2)), float(rnd.integers(0, 2))
        out.append((float(5 + 0.3 * x1 - x2 + rnd.normal() + j), x1, x2, float(rnd.integers(0, 4)), h, j, bool(rnd.random() < 0.7)))
    out += [(None, 1.0, 1.0, 1.0, 0, 90, True), (1.0, None, 1.0, 1.0, 0, 91, True), (1.0, 1e4, 1.0, None, 1, 92, True), (2.0, 1e4, 0.0, 1.0, 9, 1, True)]
    return out


SCHEMA = "y double, x1 double, x2 double, w double, h int, j int, inside boolean"


def test_fit_equals_numpy(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = survey_lm(df, "y", {"x1": "x1", "x2": "x2"}, "w", "h", "j", domain=F.col("inside")).collect()
    beta, se, degf = brute(rows, 2)
    assert [r.term for r in got] == ["(Intercept)", "x1", "x2"]
    assert np.allclose([r.estimate for r in got], beta, rtol=1e-5) and np.allclose([r.std_error for r in got], se, rtol=1e-5)
    assert {r.df for r in got} == {degf} and all(0 <= r.p_value <= 1 and r.lo < r.estimate < r.hi for r in got)


def test_ttest_is_the_difference_of_weighted_means(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("g", F.when(F.col("inside"), F.when(F.col("x2") == 1, "b").otherwise("a")).otherwise("c"))
    got = survey_ttest(df, "y", "g", "a", "b", "w", "h", "j").first()
    used = [r for r in rows if r[-1] and r[0] is not None and r[3]]
    mean = lambda v: sum(r[0] * r[3] for r in used if r[2] == v) / sum(r[3] for r in used if r[2] == v)
    beta, se, degf = brute([(r[0], *r[2:]) for r in rows], 1)
    assert np.isclose(got.estimate, mean(1) - mean(0)) and np.isclose(got.std_error, se[1]) and got.df == degf


def test_degenerate_designs(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0 * i, 1.0, 0, i) for i in range(5)], "y double, x1 double, x2 double, w double, h int, j int")
    with pytest.raises(ValueError, match="dependent"):
        survey_lm(df, "y", {"x1": "x1", "x2": "x2"}, "w", "h", "j")
    with pytest.raises(ValueError, match="weight"):
        survey_lm(df.where("y < 0"), "y", {"x1": "x1"}, "w", "h", "j")
