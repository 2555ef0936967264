"""Top-n inner products against all products, and the recommender built on them."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.operators import factors as fc
from quarry.operators import ml

SCHEMA = "id long, features array<float>"


def table(n, seed, kind, dims=4):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        x = [float(rnd.randrange(-2, 3)) for _ in range(dims)] if kind == "ties" else [rnd.gauss(0, 1) for _ in range(dims)]
        if kind == "falling":
            x = [v * 0.97 ** i for v in x]
        out.append((i * 3 + 1, x))
    rnd.shuffle(out)
    return out


def brute(spark, users, items, n):
    import numpy as np
    out = []
    for u, x in users:
        best = []
        for i, v in items:
            s = 0.0
            for a, b in zip(np.float32(x), np.float32(v)):
                s += float(a) * float(b)
            best.append((-s, i))
        out += [(u, k, i) for k, (_, i) in enumerate(sorted(best)[:n], 1)]
    return sorted(out)


@pytest.mark.parametrize("kind,n,slice_rows,block", [("gauss", 5, 64, 16), ("ties", 7, 32, 8), ("falling", 3, 32, 8), ("ties", 400, 64, 16),
                                                     ("gauss", 5, 1 << 16, 1 << 10), ("ties", 1, 1, 1)])
def test_top_products_equal_all_products(spark, kind, n, slice_rows, block):
    users, items = table(40, 1, "ties" if kind == "ties" else "gauss"), table(200 if slice_rows > 1 else 6, 2, kind)
    users.append((9999, [0.0] * 4))  # every item scores 0, so nothing may be left out
    got = fc.top_products(spark.createDataFrame(users, SCHEMA).repartition(3), spark.createDataFrame(items, SCHEMA), n, slice_rows, block)
    assert sorted((r.u, r.rank, r.i) for r in got.collect()) == brute(spark, users, items, n)


def test_short_items_are_not_read(spark):
    users, items = table(50, 3, "gauss"), table(400, 4, "falling")
    slices = []
    got = fc.top_products(spark.createDataFrame(users, SCHEMA), spark.createDataFrame(items, SCHEMA), 5, 50, 10, slices).collect()
    assert sorted((r.u, r.rank, r.i) for r in got) == brute(spark, users, items, 5)
    assert len(slices) < 8 and slices[0] == 50 and slices == sorted(slices, reverse=True)


def test_empty_sides(spark):
    some, none = spark.createDataFrame(table(5, 1, "gauss"), SCHEMA), spark.createDataFrame([], SCHEMA)
    assert fc.top_products(none, some, 3).count() == 0 and fc.top_products(some, none, 3).count() == 0


def test_recommendations_are_the_best_of_the_fitted_factors(spark):
    ratings = spark.range(600).select(F.pmod(F.xxhash64("id"), F.lit(30)).alias("user"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(20)).alias("item"),
                                      F.pmod(F.xxhash64("id", F.lit(2)), F.lit(5)).cast("double").alias("r")).distinct()
    model = ml.als_model(ratings, "user", "item", "r", 4)
    want = {(r.u, k): x.rating for r in model.recommendForAllUsers(6).collect() for k, x in enumerate(r.recommendations, 1)}
    got = ml.als_recommend(ratings, "user", "item", "r", 6, 4)
    assert got.schema.simpleString() == "struct<user:int,rank:int,item:int,score:float>"
    rows = {(r.user, r["rank"]): r.score for r in got.collect()}
    assert rows.keys() == want.keys() and all(abs(rows[k] - want[k]) < 1e-4 for k in want)
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()


def test_blocks_of_the_fit_hold_some_ratings_each(spark, monkeypatch):
    """More ratings are more blocks, not larger ones; a few are as many blocks as ever."""
    ratings = spark.range(600).select((F.col("id") % 40).alias("user"), F.floor(F.col("id") / 40).alias("item"), (F.col("id") % 7).cast("double").alias("r"))
    blocks = lambda m: (m.userFactors.rdd.getNumPartitions(), m.itemFactors.rdd.getNumPartitions())
    assert blocks(ml.als_model(ratings, "user", "item", "r", 4)) == (10, 10)
    monkeypatch.setattr(ml, "ALS_BLOCK", 50)
    model = ml.als_model(ratings, "user", "item", "r", 4)
    assert blocks(model) == (12, 12)
    assert model.userFactors.count() == 40 and model.itemFactors.count() == 15


def best_of(users, items, n):
    """Ids of the n largest sums, factor by factor, for every user."""
    out = []
    for x in users:
        s = sum(x[k] * items[1][:, k] for k in range(len(x)))
        out.append(items[0][np.lexsort((items[0], -s))[:n]].tolist())
    return out


def by_norm(ids, v):
    order = np.lexsort((ids, -np.sqrt((v * v).sum(axis=1))))
    return ids[order], v[order]


def test_items_in_other_directions_are_not_scored():
    """Items of one length, where the norms alone rule nothing out."""
    rnd = np.random.default_rng(5)
    v = rnd.normal(size=(4096, 3))
    v /= np.sqrt((v * v).sum(axis=1))[:, None]
    users = rnd.normal(size=(300, 3))
    items = by_norm(rnd.permutation(4096), v)
    ids, scores = np.full((300, 5), -1), np.full((300, 5), -np.inf)
    norm = np.sqrt((users * users).sum(axis=1)) * (1 + fc.SLACK)
    products = fc._score(users, norm, ids, scores, fc.Blocks(*items, 32))
    assert ids.tolist() == best_of(users, items, 5)
    assert products < 300 * 4096 / 8


@pytest.mark.parametrize("kind,n", [("gauss", 3), ("whole", 3), ("whole", 90), ("copies", 7), ("zero", 4)])
def test_bands_and_blocks_equal_all_products(monkeypatch, kind, n):
    monkeypatch.setattr(fc, "BAND_ROWS", 64)
    monkeypatch.setattr(fc, "USER_ROWS", 16)
    rnd = np.random.default_rng(6)
    v, users = rnd.normal(size=(500, 4)) + 1, rnd.normal(size=(50, 4)) + 1
    if kind == "whole":
        v, users = np.round(v), np.round(users)
    elif kind == "copies":
        v = np.repeat(v[:20], 25, axis=0)
    elif kind == "zero":
        v[::2], users[::5] = 0, 0
    items = by_norm(rnd.permutation(500) * 3, v)
    told = pd.DataFrame({"u": np.arange(50), "x": list(users), "ids": [[]] * 50, "scores": [[]] * 50})
    got = pd.concat(fc._take_slice(*items, -1.0, n, 8)(iter([told])))
    assert [i.tolist() for i in got["ids"]] == best_of(users, items, n)
    assert got["done"].all()
