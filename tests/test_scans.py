"""Moving windows, decayed sums and Holt fits in blocks against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import scans, windows as win
from quarry.operators import timeseries as ts


def series(n_hot=700, seed=1):
    """A group with most rows, a small one, one of a single row and a null group."""
    rnd = random.Random(seed)
    sizes = {"hot": n_hot, "small": 25, "one": 1, None: 40}
    return {g: [None if rnd.random() < 0.02 else round(rnd.gauss(5, 2), 3) for _ in range(n)] for g, n in sizes.items()}


def frame(spark, data):
    rows = [(g, t, x) for g, xs in data.items() for t, x in enumerate(xs)]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, "g string, t int, x double").repartition(5)


def got(df, *cols):
    return {(r.g, r.t): tuple(r[c] for c in cols) for r in df.collect()}


def same(a, b):
    return (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 14])
def test_moving_windows_equal_loops(spark, block):
    data = series()
    df = frame(spark, data)
    roll = got(win.rolling_sum(df, ["g"], ["t"], "x", 10, "v", block=block), "v")
    even = got(win.centered_ma(df, ["g"], ["t"], "x", 12, "v", block=block), "v")
    odd = got(win.centered_ma(df, ["g"], ["t"], "x", 7, "v", block=block), "v")
    assert len(roll) == len(even) == len(odd) == sum(map(len, data.values()))
    for g, xs in data.items():
        for t in range(len(xs)):
            w = xs[t:t + 10]
            assert same(roll[g, t][0], sum(w) if len(w) == 10 and None not in w else None)
            w = xs[t - 6:t + 7] if t >= 6 else []
            assert same(even[g, t][0], (sum(w) - 0.5 * w[0] - 0.5 * w[-1]) / 12 if len(w) == 13 and None not in w else None)
            w = xs[t - 3:t + 4] if t >= 3 else []
            assert same(odd[g, t][0], sum(w) / 7 if len(w) == 7 and None not in w else None)


def test_expanding_mean_equals_loop(spark):
    data = series()
    mean = got(win.expanding_mean(frame(spark, data), ["g"], ["t"], "x", "v"), "v")
    for g, xs in data.items():
        for t in range(len(xs)):
            w = [x for x in xs[:t] if x is not None]
            assert same(mean[g, t][0], sum(w) / len(w) if len(w) >= 3 else None)


def test_hot_group_is_spread_and_keeps_every_row_once(spark):
    n = 20_000
    df = spark.range(n).select(F.lit("hot").alias("g"), F.col("id").alias("t"), F.col("id").cast("double").alias("x"))
    out = win.over_halo(df.withColumn("p", F.col("t") + 1), ["g"], "p", 3, 3,
                        lambda w: {"s": F.sum("x").over(w.rowsBetween(-3, 3)), "n": F.count("x").over(w.rowsBetween(-3, 3))}, 1000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert out.select(F.spark_partition_id().alias("pid")).distinct().count() >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert out.count() == n and out.select("t").distinct().count() == n
    assert out.where((F.col("n") == 7) & (F.col("s") != 7 * F.col("x"))).count() == 0
    assert out.where(F.col("n") < 7).count() == 6


@pytest.mark.parametrize("decay,block", [(0.94, 1 << 14), (0.94, 16), (0.5, 3), (0.999, 8), (0.9999, 50), (1e-60, 100), (1e-200, 100)])
def test_decayed_sums_equal_loop(spark, decay, block):
    data = {g: [0.0 if x is None else x for x in xs] for g, xs in series().items()}
    data["hot"][300:500] = [0.0] * 200
    df = frame(spark, data).withColumn("p", F.col("t") + 1)
    state = got(scans.decayed_sums(df, ["g"], "p", "x", decay, "s", block), "s")
    for g, xs in data.items():
        s = 0.0
        for t, x in enumerate(xs):
            assert math.isclose(state[g, t][0], s, rel_tol=1e-9, abs_tol=1e-280)
            s = decay * s + x


def test_decay_outside_its_range_is_refused(spark):
    for decay in (0.0, 1.0, -0.5):
        with pytest.raises(ValueError):
            scans.decayed_sums(spark.range(1), [], "id", "id", decay, "s")


@pytest.mark.parametrize("block", [5, 1 << 14])
def test_ewma_equals_loop(spark, block):
    data = series()
    data["small"][3], data["small"][4] = math.nan, math.inf
    out = got(ts.ewma_volatility(frame(spark, data), "t", "x", 0.9, ["g"], 20, block), "ewma_sigma", "rolling_sd", "std_resid")
    n = 0
    for g, xs in data.items():
        s2, seen = None, []
        for t, x in enumerate(xs):
            if x is None or not math.isfinite(x):
                assert (g, t) not in out
                continue
            n += 1
            s2 = x * x if s2 is None else s2
            seen.append(x)
            w = seen[-20:]
            m = sum(w) / len(w)
            sd = math.sqrt(sum((v - m) ** 2 for v in w) / (len(w) - 1)) if len(w) > 1 else None
            assert all(same(a, b) for a, b in zip(out[g, t], (math.sqrt(s2), sd, x / math.sqrt(s2))))
            s2 = 0.9 * s2 + 0.1 * x * x
    assert len(out) == n


@pytest.mark.parametrize("block", [2, 9, 1 << 14])
def test_holt_equals_loop(spark, block):
    data = series()
    data["hot"] = [None if x is None else 1e6 + 50 * t + x for t, x in enumerate(data["hot"])]
    fits = scans.holt_fits(frame(spark, data), "t", "x", ["g"], [0.1, 0.8], [0.05, 0.3], block)
    out = {(r.g, r.alpha, r.beta): (r.sse, r.level, r.trend) for r in fits.collect()}
    assert len(out) == 4 * len(data)
    for g, xs in data.items():
        ys = [x for x in xs if x is not None]
        for a in (0.1, 0.8):
            for b in (0.05, 0.3):
                lvl, tr, sse = ys[0], (ys[1] - ys[0] if len(ys) > 1 else 0.0), 0.0
                for y in ys[1:]:
                    e = y - (lvl + tr)
                    new = a * y + (1 - a) * (lvl + tr)
                    lvl, tr, sse = new, b * (new - lvl) + (1 - b) * tr, sse + e * e
                assert all(math.isclose(p, q, rel_tol=1e-7, abs_tol=1e-7) for p, q in zip(out[g, a, b], (sse, lvl, tr)))


def test_empty_series(spark):
    none = spark.createDataFrame([], "g string, t int, x double")
    assert win.rolling_sum(none, ["g"], ["t"], "x", 3).count() == 0
    assert win.expanding_mean(none, ["g"], ["t"], "x").count() == 0
    assert ts.ewma_volatility(none, "t", "x", 0.94, ["g"]).count() == 0
    assert scans.holt_fits(none, "t", "x", ["g"], [0.5], [0.1]).count() == 0
