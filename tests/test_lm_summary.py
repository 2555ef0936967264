"""Regression summaries against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import stats


def test_summary_equals_numpy(spark):
    rnd = np.random.default_rng(2)
    x = np.column_stack([rnd.normal(1e6, 1, 500), rnd.normal(0, 1e-3, 500), rnd.integers(0, 2, 500)])
    y = 1e6 + x @ [2.0, 300.0, -1.0] + rnd.normal(size=500)
    rows = [(float(b), *map(float, a)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 1.0), (1.0, None, 1.0, 1.0)]
    got = stats.lm_summary(spark.createDataFrame(rows, "y double, a double, b double, c double"), "y", {"a": "a", "b": "b", "c": F.col("c")}).collect()
    m = x.mean(0)
    xc = x - m
    inv = np.linalg.inv(xc.T @ xc)
    beta = inv @ xc.T @ (y - y.mean())
    s2 = np.sum((y - y.mean() - xc @ beta) ** 2) / (500 - 4)
    se = np.sqrt(s2 * np.diag(inv))
    assert [r.term for r in got] == ["(Intercept)", "a", "b", "c"]
    assert np.allclose([r.estimate for r in got[1:]], beta, rtol=1e-7) and np.allclose([r.std_error for r in got[1:]], se, rtol=1e-7)
    assert np.isclose(got[0].estimate, y.mean() - m @ beta, rtol=1e-6) and np.isclose(got[0].std_error, np.sqrt(s2 * (1 / 500 + m @ inv @ m)), rtol=1e-6)
    assert all(np.isclose(r.hi - r.estimate, 1.96476 * r.std_error, rtol=1e-4) and np.isclose(r.t_value, r.estimate / r.std_error) for r in got)
    assert got[2].p_value < 1e-6 and 0 <= got[0].p_value <= 1


def test_refused_designs(spark):
    df = spark.range(20).select(F.col("id").cast("double").alias("y"), (F.col("id") % 5).cast("double").alias("a"), F.col("id").cast("string").alias("g"))
    with pytest.raises(ValueError, match="dependent"):
        stats.lm_summary(df, "y", {"a": "a", "b": F.col("a") * 2})
    with pytest.raises(ValueError, match="fewer rows"):
        stats.lm_summary(df.limit(1), "y", {"a": "a"})
    with pytest.raises(ValueError, match="levels"):
        stats.treatment_columns(df, "a", "g", max_levels=10)
    assert list(stats.treatment_columns(df.where("id < 3") if "id" in df.columns else df.where("y < 3"), "a", "g")) == ["a", "g1", "g2", "a:g1", "a:g2"]


def test_anova_does_not_cancel(spark):
    rnd = np.random.default_rng(3)
    rows = [(float(1e9 + g + rnd.normal()), g) for g in range(4) for _ in range(50)]
    got = stats.anova_one_way(spark.createDataFrame(rows, "y double, g int"), "y", "g").first()
    y, g = np.array([r[0] - 1e9 for r in rows]), np.array([r[1] for r in rows])
    means = np.array([y[g == i].mean() for i in range(4)])
    between, within = sum(50 * (means - y.mean()) ** 2), sum(((y - means[g]) ** 2))
    assert np.isclose(got.ss_between, between, rtol=1e-5) and np.isclose(got.ss_within, within, rtol=1e-5)
    assert np.isclose(got.f, (between / 3) / (within / 196), rtol=1e-5) and (got.df_between, got.df_within) == (3, 196)
