"""Model-fit operators (no SQL oracle) against independent numpy fits on
the small harness tables."""

import numpy as np
import pytest

from quarry.operators import ml
from quarry.plans.registry import load_all
from quarry.session import load

from conftest import SF_SMALL


def _emb(spark):
    rows = load(spark, SF_SMALL, "embeddings").orderBy("vec_id").collect()
    return np.array([r["embedding"] for r in rows], dtype=float)


def test_glm_binomial_matches_irls(spark):
    df = spark.range(0).sparkSession.createDataFrame(
        [(float(x), float(z), int(y)) for x, z, y in
         zip(np.linspace(0, 1, 300), np.cos(np.arange(300)), (np.sin(np.arange(300) * 7) > 0.2).astype(int))],
        "x double, z double, y int")
    got = {r["term"]: r["estimate"] for r in ml.glm_table(df, "y ~ x + z", "binomial").collect()}
    pdf = df.toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf["x"], pdf["z"]])
    y = pdf["y"].to_numpy(float)
    b = np.zeros(3)
    for _ in range(50):  # IRLS
        p = 1 / (1 + np.exp(-X @ b))
        W = p * (1 - p)
        b = b + np.linalg.solve(X.T @ (X * W[:, None]), X.T @ (y - p))
    assert got["(Intercept)"] == pytest.approx(b[0], abs=1e-5)
    assert got["x"] == pytest.approx(b[1], abs=1e-5) and got["z"] == pytest.approx(b[2], abs=1e-5)


def test_svd_matches_numpy(spark):
    a = _emb(spark)
    got = load_all()["ml_svd"].fn(spark, SF_SMALL).orderBy("i").collect()
    s = np.linalg.svd(a, compute_uv=False)
    assert [r["sigma"] for r in got] == pytest.approx(list(s[:10]), rel=1e-6)
    assert got[0]["energy_share"] == pytest.approx(s[0] ** 2 / (s ** 2).sum(), rel=1e-6)


def test_pca_variance_share_matches_numpy(spark):
    a = _emb(spark)
    z = (a - a.mean(0)) / a.std(0, ddof=1)
    ev = np.sort(np.linalg.eigvalsh(np.cov(z, rowvar=False)))[::-1]
    got = load_all()["ml_pca"].fn(spark, SF_SMALL).orderBy("component").collect()
    assert [r["variance_share"] for r in got] == pytest.approx(list(ev[:10] / ev.sum()), rel=1e-6)


def test_vif_matches_inverse_correlation(spark):
    li = load(spark, SF_SMALL, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax").toPandas()
    inv = np.linalg.inv(np.corrcoef(li.to_numpy(float), rowvar=False))
    got = {r["term"]: r["vif"] for r in ml.vif(load(spark, SF_SMALL, "lineitem"), list(li.columns)).collect()}
    for i, c in enumerate(li.columns):
        assert got[c] == pytest.approx(inv[i, i], rel=1e-9)


def test_kmeans_k1_cost_is_total_ss(spark):
    a = _emb(spark)
    got = {r["k"]: r["wss"] for r in load_all()["ml_kmeans_elbow"].fn(spark, SF_SMALL).collect()}
    assert got[1] == pytest.approx(((a - a.mean(0)) ** 2).sum(), rel=1e-9)
    assert got[10] < got[2] < got[1]


def test_lm_formula_matches_lstsq(spark):
    li = load(spark, SF_SMALL, "lineitem").select("l_extendedprice", "l_quantity", "l_returnflag")
    got = {r["term"]: r["estimate"] for r in ml.lm_formula(li, "l_extendedprice ~ l_quantity + l_returnflag").collect()}
    pdf = li.toPandas()
    levels = sorted(pdf["l_returnflag"].unique(), key=lambda v: -(pdf["l_returnflag"] == v).sum())
    dummies = [f"l_returnflag_{lv}" for lv in levels[:-1]]  # RFormula drops the least frequent level
    X = np.column_stack([pdf["l_quantity"]] + [(pdf["l_returnflag"] == lv).astype(float) for lv in levels[:-1]]
                        + [np.ones(len(pdf))])
    beta = np.linalg.lstsq(X, pdf["l_extendedprice"].to_numpy(float), rcond=None)[0]
    assert got["l_quantity"] == pytest.approx(beta[0], rel=1e-6)
    for name, val in zip(dummies, beta[1:-1]):
        assert got[name] == pytest.approx(val, rel=1e-6, abs=1e-6)
    assert got["(Intercept)"] == pytest.approx(beta[-1], rel=1e-6)
