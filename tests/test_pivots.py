"""Nearest neighbours by pivots against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import pivots as pv

SCHEMA = "id long, x array<double>, label string"


def brute(train, test, k):
    ok = lambda v: v and all(a is not None and math.isfinite(a) for a in v)
    out = []
    for i, q, _ in test:
        if ok(q):
            near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(q, x))), j) for j, x, _ in train if ok(x) and len(x) == len(q))[:k]
            out += [(i, n, j) for n, (_, j) in enumerate(near, 1)]
    return sorted(out)


def rows(kind, n, seed, dims=6, first=0):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        if kind == "clusters":
            c = rnd.randrange(8)
            x = [100.0 * ((c >> (d % 3)) & 1) + rnd.gauss(0, 3) for d in range(dims)]
        elif kind == "ties":
            x = [float(rnd.randrange(3)) for _ in range(dims)]
        else:
            x = [rnd.gauss(0, 1) for _ in range(dims)]
        out.append((first + i, x, rnd.choice("ab")))
    return out


@pytest.mark.parametrize("kind,k,pivots", [("clusters", 5, 16), ("ties", 9, 8), ("gauss", 3, 1), ("gauss", 1000, 16)])
def test_neighbours_equal_brute_force(spark, kind, k, pivots):
    train = rows(kind, 500, 1) + [(900, None, "a"), (901, [None] * 6, "a"), (902, [math.nan] * 6, "a"), (903, [1.0], "a"), (904, [], "b"), (None, [0.0] * 6, "a")]
    test = rows(kind, 30, 2, first=2000) + [(2900, None, "a"), (2901, [500.0] * 6, "a"), (2902, train[3][1], "a")]
    got = pv.knn(spark.createDataFrame(train, SCHEMA).repartition(3), spark.createDataFrame(test, SCHEMA), "id", "x", k, ("label",), pivots=pivots)
    want = brute([r for r in train if r[0] is not None and r[0] not in (903,)], test, k)
    assert sorted((r.query_id, r.nn_rank, r.id) for r in got.collect()) == want


def test_bounds_leave_few_pairs_of_clustered_rows(spark):
    train, test = rows("clusters", 2000, 3), rows("clusters", 40, 4, first=5000)
    pairs = pv.candidate_pairs(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test, SCHEMA), "id", "x", 5, pivots=32)
    share = pairs.count() / (2000 * 40)
    print("share of pairs computed", share)
    assert share < 0.25


def test_empty_sides_and_copies(spark):
    some, none = spark.createDataFrame(rows("gauss", 20, 5), SCHEMA), spark.createDataFrame([], SCHEMA)
    assert pv.knn(none, some, "id", "x", 3).count() == 0 and pv.knn(some, none, "id", "x", 3).count() == 0
    same = spark.range(50).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("x"), F.lit("a").alias("label"))
    got = pv.knn(same, same.where("id = 7"), "id", "x", 3).collect()
    assert sorted((r.nn_rank, r.id, r.dist) for r in got) == [(1, 0, 0.0), (2, 1, 0.0), (3, 2, 0.0)]


def test_vote(spark):
    n = spark.createDataFrame([(1, 1, "b"), (1, 2, "a"), (1, 3, "a"), (2, 1, "b"), (2, 2, "a")], "query_id int, nn_rank int, label string")
    assert {r.query_id: r.predicted for r in pv.vote(n, "label").collect()} == {1: "a", 2: "b"}


def test_features_without_structure_are_multiplied_in_blocks(spark):
    """Every pair is in question here; as rows of a join 1,500,000 pairs of 64 features take minutes."""
    import numpy as np

    rnd = np.random.default_rng(7)
    x, q = rnd.normal(size=(5000, 64)).round(3), rnd.normal(size=(300, 64)).round(3)
    x[100:900] = x[100]  # more equal rows than neighbours asked for
    q[0] = x[100]
    frame = lambda m, first: spark.createDataFrame([(first + i, v.tolist(), "a") for i, v in enumerate(m)], SCHEMA)
    near = pv.knn(frame(x, 0), frame(q, 10_000), "id", "x", 7, ("label",), block_rows=1000)
    assert "SortMergeJoin" not in near._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.query_id, r.nn_rank, r.id, r.dist) for r in near.collect())
    want = []
    for i, v in enumerate(q):
        d = np.sqrt(sum((v[j] - x[:, j]) ** 2 for j in range(64)))
        want += [(10_000 + i, n, int(c), float(d[c])) for n, c in enumerate(np.lexsort((np.arange(len(x)), d))[:7], 1)]
    assert got == want


def test_rounding_of_the_products_decides_nothing():
    import numpy as np

    x = 1e8 + np.arange(40.0)[:, None] * 1e-7 * np.array([[1.0, -1.0]])  # the products cannot tell these rows apart
    q = x[[7, 31]]
    got = pv.nearest_of_block(q, np.concatenate([x, [[1e200, 1e200]]]), 3)
    for i, v in enumerate(q):
        d = np.sqrt((v[0] - x[:, 0]) ** 2 + (v[1] - x[:, 1]) ** 2)
        assert got[1][got[0] == i].tolist() == np.lexsort((np.arange(40), d))[:3].tolist()
