"""Selection of order statistics: values that lie awkwardly for its buckets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators.quantiles import quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
RNG = np.random.default_rng(5)
SHAPES = {
    "one bucket": 1e9 + RNG.random(4000) * 1e-3,
    "neighbours": 1.0 + np.arange(4000) * np.finfo(float).eps,
    "all magnitudes": np.ldexp(RNG.choice([-1.0, 1.0], 4000) * (1 + RNG.random(4000)), RNG.integers(-1070, 1020, 4000)),
    "outlier": np.append(RNG.random(3999), 1e300),
    "ties": RNG.integers(-3, 4, 4000).astype(float),
    "constant": np.full(50, -7.25),
    "powers": np.ldexp(1.0, np.arange(-1022, 1023)),
}


def _check(rows, truth):
    for r in rows:
        want = np.quantile(truth[r.g], r.p)
        assert r.q == pytest.approx(want, rel=1e-12, abs=1e-15), (r.g, r.p)


def test_shapes(spark):
    rows = [(g, float(x)) for g, xs in SHAPES.items() for x in xs]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = quantiles(df, "x", PROBS, ["g"]).collect()
    assert len(got) == len(SHAPES) * len(PROBS)
    _check(got, SHAPES)


def test_hot_group_null_group_and_nothing_written(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, (F.col("id") % 40).cast("string")).alias("g"),
        F.pmod(F.col("id") * 7919, F.lit(10_007)).cast("double").alias("x"))
    lazy = quantiles(df, "x", PROBS, ["g"])
    assert "RDDScan" not in lazy._jdf.queryExecution().optimizedPlan().toString()  # no checkpoint of the values
    truth = {}
    for r in df.collect():
        truth.setdefault(r.g, []).append(r.x)
    got = lazy.collect()
    assert len(got) == len(truth) * len(PROBS) and None in truth
    _check(got, truth)


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "g string, x double")
    assert [tuple(r) for r in quantiles(df, "x", [0.5], ["g"]).collect()] == [("b", 0.5, 2.0)]
    assert quantiles(df.where("false"), "x", [0.5]).collect() == []
