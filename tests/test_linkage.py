"""Single-linkage cuts against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.functions.geo import EARTH_RADIUS_M
from quarry.operators import linkage as lk

SCHEMA = "id long, lat double, lon double"


def hav(a, b):
    la, lb = math.radians(a[1]), math.radians(b[1])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))


def brute(rows, radius):
    name = {r[0]: r[0] for r in rows}

    def top(i):
        while name[i] != i:
            i = name[i]
        return i
    ok = [r for r in rows if r[1] is not None and r[2] is not None and math.isfinite(r[1]) and math.isfinite(r[2])]
    for n, a in enumerate(ok):
        for b in ok[:n]:
            if hav(a, b) <= radius:
                i, j = sorted((top(a[0]), top(b[0])))
                name[j] = i
    return {i: top(i) for i in name}


def globe(n, seed):
    rnd = random.Random(seed)
    return [(i, math.degrees(math.asin(rnd.uniform(-1, 1))), rnd.uniform(-180, 180)) for i in range(n)]


def near_poles(n, seed):
    rnd = random.Random(seed)
    return [(i, rnd.choice((-1, 1)) * rnd.uniform(86, 90), rnd.uniform(-180, 180)) for i in range(n)]


def date_line(n, seed):
    rnd = random.Random(seed)
    return [(i, rnd.uniform(-3, 3), (180 + rnd.uniform(-3, 3) + 180) % 360 - 180) for i in range(n)]


def copies(n, seed):
    rnd = random.Random(seed)
    return [(i, 10.0, 20.0) if i % 3 == 0 else (i, rnd.uniform(-40, 40), rnd.uniform(-40, 40)) for i in range(n)]


@pytest.mark.parametrize("make,n,radius", [(globe, 400, 900e3), (globe, 400, 300e3), (near_poles, 250, 60e3), (date_line, 250, 40e3),
                                           (copies, 300, 500e3), (globe, 60, 2.5e7), (globe, 50, 1.0)])
def test_clusters_equal_all_pairs(spark, make, n, radius):
    rows = make(n, 7) + [(9000, None, 1.0), (9001, 1.0, math.nan), (9002, math.inf, 0.0)]
    got = lk.single_linkage_cut(spark.createDataFrame(rows, SCHEMA).repartition(3), "id", "lat", "lon", radius).collect()
    assert len(got) == len(rows) and {r.id: r.component for r in got} == brute(rows, radius)


def test_two_lines_just_out_of_reach(spark):
    step = math.degrees(100e3 / EARTH_RADIUS_M)
    for factor, groups in ((0.9999, 1), (1.0001, 2)):
        rows = [(i, (i % 2) * step * factor, i // 2 * step / 40) for i in range(400)]
        seen = []
        got = lk.single_linkage_cut(spark.createDataFrame(rows, SCHEMA), "id", "lat", "lon", 100e3, seen)
        assert got.select("component").distinct().count() == groups
        assert sum(seen) < 400 * 40


def test_dense_spot_costs_no_pairs(spark):
    n = 30_000
    jitter = lambda seed: F.rand(seed) * 0.5
    hot = F.col("id") % 3 == 0
    pts = spark.range(n).select("id", F.when(hot, jitter(1)).otherwise(F.rand(2) * 100 - 50).alias("lat"),
                                F.when(hot, jitter(3)).otherwise(F.rand(4) * 300 - 150).alias("lon"))
    seen = []
    out = lk.single_linkage_cut(pts, "id", "lat", "lon", 100e3, seen)
    assert out.count() == n and sum(seen) < 20 * n
    assert out.where("id % 3 = 0").select("component").distinct().count() == 1


def test_empty_and_bad_radius(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert lk.single_linkage_cut(none, "id", "lat", "lon", 10.0).count() == 0
    with pytest.raises(ValueError):
        lk.single_linkage_cut(none, "id", "lat", "lon", 0.0)
