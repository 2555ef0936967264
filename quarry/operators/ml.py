"""Machine-learning pipelines.

Model fitting is MLlib (distributed); results come back as small tables
(coefficients, costs, metrics) built from the fitted model's summary.
Evaluation metrics that are plain aggregates (confusion counts, AUC by
rank sums, log-loss) are grouped aggregations over the scored rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier,
                                       DecisionTreeClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import PCA, RFormula, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.special import f_pvalue
from quarry.operators.factors import top_products
from quarry.operators.windows import running_sums
from quarry.operators.relational import hash_order
from quarry.session import cut_lineage

SEED = 42


def _table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def vectorize(df: DataFrame, arr: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.transform(arr, lambda x: x.cast("double"))))


# ------------------------------------------------------------ linear models
def lm_formula(df: DataFrame, formula: str, weight: str | None = None) -> DataFrame:
    """``lm(formula)`` with R-style formula (factors one-hot, interactions);
    coefficient table with SE, t and p (normal-equation solver)."""
    rf = RFormula(formula=formula).fit(df)
    data = rf.transform(df)
    lr = LinearRegression(solver="normal", weightCol=weight) if weight else LinearRegression(solver="normal")
    m = lr.fit(data)
    names = [a["name"] for a in sorted(
        data.schema["features"].metadata["ml_attr"]["attrs"].get("numeric", [])
        + data.schema["features"].metadata["ml_attr"]["attrs"].get("binary", []), key=lambda a: a["idx"])]
    s = m.summary
    coefs = list(m.coefficients) + [m.intercept]
    try:
        se, tv, pv = s.coefficientStandardErrors, s.tValues, s.pValues
    except Exception:  # singular design: Spark fell back to an iterative solver without SEs
        se = tv = pv = [None] * len(coefs)
    rows = [(n, float(c), _f(e), _f(t), _f(p)) for n, c, e, t, p in zip(names + ["(Intercept)"], coefs, se, tv, pv)]
    return _table(df.sparkSession, rows, "term string, estimate double, std_error double, t_value double, p_value double")


def _f(v):
    return None if v is None else float(v)


def _ols_table(spark, data: DataFrame, names: list[str], label: str, weight: str | None = None) -> DataFrame:
    lr = LinearRegression(solver="normal", featuresCol="features", labelCol=label,
                          **({"weightCol": weight} if weight else {}))
    m = lr.fit(data)
    s = m.summary
    coefs = list(m.coefficients) + [m.intercept]
    try:
        se, tv, pv = s.coefficientStandardErrors, s.tValues, s.pValues
    except Exception:  # singular design: iterative fallback without SEs
        se = tv = pv = [None] * len(coefs)
    rows = [(n, float(c), _f(e), _f(t), _f(p)) for n, c, e, t, p in zip(names + ["(Intercept)"], coefs, se, tv, pv)]
    return _table(spark, rows, "term string, estimate double, std_error double, t_value double, p_value double")


def lm_columns(df: DataFrame, y: str, xs: Sequence[str], weight: str | None = None) -> DataFrame:
    """OLS / WLS on explicit numeric columns (normal equations, with SEs)."""
    cols = [y, *xs] + ([weight] if weight else [])
    d = VectorAssembler(inputCols=list(xs), outputCol="features").transform(df.select(*cols).na.drop())
    return _ols_table(df.sparkSession, d, list(xs), y, weight)


def lm_factor_interaction(df: DataFrame, y: str, x: str, g: str) -> DataFrame:
    """``lm(y ~ x * g)`` with R's treatment contrasts: base level = first
    level in sorted order; a dummy and an ``x:g`` slope term for every
    other level.  (Spark's RFormula codes the interaction with all levels,
    which makes the design singular.)  The level list is small by nature."""
    levels = sorted(r[0] for r in df.select(g).distinct().collect() if r[0] is not None)
    others = levels[1:]
    cols = {f"{g}{lv}": (F.col(g) == lv).cast("double") for lv in others}
    cols.update({f"{x}:{g}{lv}": F.col(x) * (F.col(g) == lv).cast("double") for lv in others})
    d = df.where(F.col(g).isNotNull()).withColumns(cols)
    names = [x, *[f"{g}{lv}" for lv in others], *[f"{x}:{g}{lv}" for lv in others]]
    return lm_columns(d, y, names)


def weighted_lm(df: DataFrame, y: str, xs: Sequence[str], weight: str) -> DataFrame:
    """``svyglm`` point estimates: weighted least squares on explicit columns."""
    return lm_columns(df, y, xs, weight)


def _rss_cols(df: DataFrame, y: str, xs: Sequence[str]) -> tuple[float, int, int]:
    d = VectorAssembler(inputCols=list(xs), outputCol="features").transform(df.select(y, *xs).na.drop())
    m = LinearRegression(solver="normal", labelCol=y).fit(d)
    s = m.summary
    return float(s.meanSquaredError * s.numInstances), int(s.numInstances), len(m.coefficients) + 1


def nested_model_f(df: DataFrame, y: str, small: Sequence[str], large: Sequence[str]) -> DataFrame:
    """``anova(m0, m1)``: F test of the extra regressors of ``large`` over
    ``small`` from the two residual sums of squares."""
    r0, n, p0 = _rss_cols(df, y, small)
    r1, _, p1 = _rss_cols(df, y, large)
    d1, d2 = p1 - p0, n - p1
    f = ((r0 - r1) / d1) / (r1 / d2)
    t = _table(df.sparkSession, [(r0, r1, d1, d2, f)], "rss_small double, rss_large double, df1 int, df2 int, f double")
    return t.withColumn("p_value", f_pvalue(F.col("f"), F.col("df1"), F.col("df2")))


def repeated_holdout_rmse(df: DataFrame, y: str, x: str, id_cols: Sequence[str], reps: int = 100,
                          uniform=None) -> DataFrame:
    """100 random half splits, closed-form fit on each train half, RMSE on
    the test half.  Each row is assigned per replicate by a hash; all
    replicates are fitted from sufficient statistics of one aggregation
    (the replicate explode is combined map-side)."""
    r = df.select(F.col(y).alias("y"), F.col(x).alias("x"), *id_cols) \
        .withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
    side = (uniform(F.col("rep"), *[F.col(c) for c in id_cols]) < 0.5) if uniform is not None else \
        (F.pmod(F.xxhash64(F.col("rep"), *[F.col(c) for c in id_cols]), F.lit(2)) == 0)
    s = r.withColumn("train", side).groupBy("rep", "train").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("y") * F.col("y")).alias("syy"),
        F.sum(F.col("x") * F.col("y")).alias("sxy"))
    tr = s.where("train").select("rep", *[F.col(c).alias(f"tr_{c}") for c in ("n", "sx", "sy", "sxx", "sxy")])
    te = s.where(~F.col("train")).select("rep", *[F.col(c).alias(f"te_{c}") for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    j = tr.join(te, "rep")
    b = (F.col("tr_n") * F.col("tr_sxy") - F.col("tr_sx") * F.col("tr_sy")) / (F.col("tr_n") * F.col("tr_sxx") - F.col("tr_sx") ** 2)
    j = j.withColumn("b", b).withColumn("a", (F.col("tr_sy") - F.col("b") * F.col("tr_sx")) / F.col("tr_n"))
    sse = (F.col("te_syy") - 2 * F.col("a") * F.col("te_sy") - 2 * F.col("b") * F.col("te_sxy") + F.col("a") ** 2 * F.col("te_n")
           + 2 * F.col("a") * F.col("b") * F.col("te_sx") + F.col("b") ** 2 * F.col("te_sxx"))
    per = j.withColumn("rmse", F.sqrt(sse / F.col("te_n")))
    return per.agg(F.count(F.lit(1)).alias("replicates"), F.avg("rmse").alias("mean_rmse"), F.stddev_samp("rmse").alias("sd_rmse"))


def glm_table(df: DataFrame, formula: str, family: str) -> DataFrame:
    """``glm(formula, family)`` coefficient table (estimate, SE, z, p)."""
    data = RFormula(formula=formula).fit(df).transform(df)
    link = "logit" if family == "binomial" else "log"
    m = GeneralizedLinearRegression(family=family, link=link, maxIter=50).fit(data)
    attrs = data.schema["features"].metadata["ml_attr"]["attrs"]
    names = [a["name"] for a in sorted(attrs.get("numeric", []) + attrs.get("binary", []), key=lambda a: a["idx"])]
    s = m.summary
    coefs = list(m.coefficients) + [m.intercept]
    rows = [(n, float(c), float(se), float(t), float(p)) for n, c, se, t, p in
            zip(names + ["(Intercept)"], coefs, s.coefficientStandardErrors, s.tValues, s.pValues)]
    return _table(df.sparkSession, rows, "term string, estimate double, std_error double, z_value double, p_value double")


def odds_ratio_table(coefs: DataFrame, z: float = 1.959963984540054) -> DataFrame:
    """exp(beta) with exp(beta +- z se) interval."""
    return coefs.select("term", F.exp("estimate").alias("odds_ratio"),
                        F.exp(F.col("estimate") - z * F.col("std_error")).alias("lo"),
                        F.exp(F.col("estimate") + z * F.col("std_error")).alias("hi"))


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation 1/(1 - R_j^2) = diag(R^-1) from the correlation
    matrix (one aggregation; the k x k inverse is tiny)."""
    import numpy as np
    k = len(cols)
    row = df.agg(*[F.corr(a, b).alias(f"c{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]).first()
    r = np.eye(k)
    for i in range(k):
        for j in range(i + 1, k):
            r[i, j] = r[j, i] = row[f"c{i}_{j}"]
    inv = np.linalg.inv(r)
    return _table(df.sparkSession, [(c, float(inv[i, i])) for i, c in enumerate(cols)], "term string, vif double")


def fit_logistic(df: DataFrame, label: str, features: Sequence[str], **kw):
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    lr = LogisticRegression(labelCol=label, featuresCol="features", **kw)
    return Pipeline(stages=[va, lr]).fit(df)


def logit_linearity(df: DataFrame, label: str, features: Sequence[str], x: str, **fit) -> DataFrame:
    """Fitted log-odds against a numeric predictor (binned means); ``fit`` goes to the estimator."""
    m = fit_logistic(df, label, features, **fit)
    p = vector_to_array(F.col("probability"))[1]
    s = m.transform(df).withColumn("logit", F.log(F.try_divide(p, 1 - p)))
    return s.groupBy(F.round(x, 1).alias("x_bin")).agg(F.avg("logit").alias("mean_logit"), F.count(F.lit(1)).alias("n"))


def score_probability(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``predict(type = "response")``: P(class 1) from the probability vector."""
    s = model.transform(df)
    return s.select(*keep, vector_to_array("probability")[1].alias("prob"), F.col("prediction").cast("int").alias("pred"))


# ----------------------------------------------------------------- clustering
def kmeans_fit(df: DataFrame, k: int, features: str = "features", seed: int = SEED):
    return KMeans(k=k, seed=seed, featuresCol=features, maxIter=30).fit(df)


def kmeans_sizes(df: DataFrame, k: int) -> DataFrame:
    m = kmeans_fit(df, k)
    out = m.transform(df).groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("size"))
    return out.withColumn("total_wss", F.lit(float(m.summary.trainingCost)))


def total_ss(df: DataFrame, arr: str) -> float:
    """Total sum of squares around the grand centroid (= k-means cost, k=1)."""
    e = df.select(F.posexplode(arr).alias("j", "v"))
    return e.groupBy("j").agg(((F.count("v") - 1) * F.var_samp("v")).alias("ss")).agg(F.sum("ss")).first()[0]


def kmeans_elbow(df: DataFrame, arr: str, ks: Sequence[int]) -> DataFrame:
    v = vectorize(df, arr).cache()
    rows = [(1, float(total_ss(df, arr)))] if 1 in ks else []
    rows += [(k, float(kmeans_fit(v, k).summary.trainingCost)) for k in ks if k > 1]
    v.unpersist()
    return _table(df.sparkSession, rows, "k int, wss double")


def silhouette_by_k(df: DataFrame, arr: str, ks: Sequence[int]) -> DataFrame:
    v = vectorize(df, arr).cache()
    ev = ClusteringEvaluator()
    rows = [(k, float(ev.evaluate(kmeans_fit(v, k).transform(v)))) for k in ks]
    v.unpersist()
    return _table(df.sparkSession, rows, "k int, silhouette double")


def gap_statistic(df: DataFrame, arr: str, id_col: str, ks: Sequence[int], b: int = 3) -> DataFrame:
    """log W_k against B reference sets drawn uniformly (hash-uniform) in
    the per-column bounding box; gap = mean log W*_k - log W_k."""
    e = df.select(id_col, F.posexplode(arr).alias("j", "v")).withColumn("v", F.col("v").cast("double"))
    box = e.groupBy("j").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    v = vectorize(df, arr).cache()
    rows = []
    refs = []
    for rep in range(b):
        u = F.pmod(F.xxhash64(F.lit(rep), F.col(id_col), F.col("j")), F.lit(1_000_003)) / 1_000_003.0
        r = e.join(F.broadcast(box), "j")  # one row per feature: bounded by the column count
        r = r.withColumn("v", F.col("lo") + u * (F.col("hi") - F.col("lo")))
        r = r.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("s")) \
            .select(id_col, F.transform("s", lambda t: t["v"]).alias("ref"))
        refs.append(vectorize(r, "ref").cache())
    for k in ks:
        lw = math.log(kmeans_fit(v, k).summary.trainingCost)
        lref = [math.log(kmeans_fit(rv, k).summary.trainingCost) for rv in refs]
        mean = sum(lref) / len(lref)
        sd = math.sqrt(sum((x - mean) ** 2 for x in lref) / max(len(lref) - 1, 1))
        rows.append((k, lw, mean, mean - lw, sd * math.sqrt(1 + 1 / len(lref))))
    for rv in refs:
        rv.unpersist()
    v.unpersist()
    return _table(df.sparkSession, rows, "k int, log_w double, mean_log_w_ref double, gap double, se double")


def cluster_profile(df: DataFrame, arr: str, k: int, label: str) -> DataFrame:
    """Size, mean / sd of the first features and label mix per cluster."""
    v = vectorize(df, arr)
    p = kmeans_fit(v, k).transform(v)
    return p.groupBy(F.col("prediction").alias("cluster")).agg(
        F.count(F.lit(1)).alias("size"), F.avg(F.col(arr)[0]).alias("mean_f0"), F.stddev_samp(F.col(arr)[0]).alias("sd_f0"),
        F.avg(F.col(arr)[1]).alias("mean_f1"), F.count_distinct(label).alias("n_labels"),
        F.mode(label).alias("top_label"))


def pca_table(df: DataFrame, arr: str, k: int) -> DataFrame:
    """``prcomp(scale = TRUE)``: variance share per component."""
    v = vectorize(df, arr, "raw")
    sc = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(v)
    m = PCA(k=k, inputCol="features", outputCol="pcs").fit(sc.transform(v))
    ev = list(m.explainedVariance)
    cum = [sum(ev[:i + 1]) for i in range(len(ev))]
    return _table(df.sparkSession, [(i + 1, float(e), float(c)) for i, (e, c) in enumerate(zip(ev, cum))],
                  "component int, variance_share double, cumulative double")


def pca_reconstruction_error(df: DataFrame, arr: str, id_col: str, k: int) -> DataFrame:
    """Autoencoder anomaly score re-aimed: squared error of the rank-k PCA
    reconstruction (centred data) of every row, largest first."""
    v = vectorize(df, arr, "raw")
    sc = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=False).fit(v)
    c = sc.transform(v)
    m = PCA(k=k, inputCol="features", outputCol="pcs").fit(c)
    pc = m.pc.toArray()  # d x k loadings: small, travels with the plan
    d = pc.shape[0]
    s = m.transform(c).select(id_col, vector_to_array("features").alias("x"), vector_to_array("pcs").alias("z"))
    rec = [sum(F.col("z")[j] * float(pc[i, j]) for j in range(k)) for i in range(d)]
    err = sum((F.col("x")[i] - rec[i]) ** 2 for i in range(d)) / d
    return s.select(id_col, err.alias("mse")).orderBy(F.col("mse").desc(), id_col)


def svd_values(df: DataFrame, arr: str, k: int) -> DataFrame:
    """Singular values of the (rows x features) matrix and the rank-k share
    of the squared Frobenius norm: the d x d Gram matrix is summed over Arrow
    batches and merged by Spark; its eigenvalues are the squares."""
    def run(batches):
        for b in batches:
            if len(b):
                x = np.stack(b["a"].to_numpy())
                g = x.T @ x
                i, j = np.indices(g.shape)
                yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "g": g.ravel()})

    parts = df.select(F.transform(arr, lambda x: x.cast("double")).alias("a")).where(F.col("a").isNotNull()) \
        .mapInPandas(run, "i long, j long, g double")
    gram = parts.groupBy("i", "j").agg(F.sum("g").alias("g")).toPandas()  # d x d numbers
    full = np.zeros((int(gram.i.max()) + 1,) * 2)
    full[gram.i, gram.j] = gram.g
    s = [float(x) for x in np.sqrt(np.maximum(np.linalg.eigvalsh(full)[::-1][:k], 0))]
    total = df.select(F.aggregate(F.transform(arr, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0),
                                  lambda a, b: a + b).alias("ss")).agg(F.sum("ss")).first()[0]
    return _table(df.sparkSession, [(i + 1, v, v * v / total) for i, v in enumerate(s)],
                  "i int, sigma double, energy_share double")


# -------------------------------------------------------------- classifiers
def _split(df: DataFrame, id_cols: Sequence[str], frac: float = 0.8, uniform=None):
    u = uniform(*[F.col(c) for c in id_cols]) if uniform is not None else F.pmod(hash_order(id_cols, SEED), F.lit(1000)) / 1000.0
    d = df.withColumn("_u", u)
    return d.where(F.col("_u") < frac).drop("_u"), d.where(F.col("_u") >= frac).drop("_u")


def classifier_report(df: DataFrame, estimator, label: str, id_cols: Sequence[str], name: str, uniform=None) -> DataFrame:
    """Fit on the 80 % hash split (or that of ``uniform`` over the id columns),
    report accuracy on the 20 % test rows."""
    train, test = _split(df, id_cols, uniform=uniform)
    m = estimator.fit(train)
    s = m.transform(test)
    return s.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_test"),
                 F.avg((F.col("prediction") == F.col(label).cast("double")).cast("double")).alias("accuracy"))


def embedding_frame(df: DataFrame, arr: str = "embedding", label: str = "label") -> DataFrame:
    return vectorize(df, arr).withColumn(label, F.col(label).cast("double"))


def threshold_scan(df: DataFrame, x: str, label: Column, cuts: Sequence[float]) -> DataFrame:
    """Accuracy of the rule x > c for every cut-off c in a grid; the grid is
    a literal list exploded per row and scored in one aggregation."""
    g = df.select(F.col(x).alias("x"), label.alias("y")).withColumn("cut", F.explode(F.array(*[F.lit(float(c)) for c in cuts])))
    return g.groupBy("cut").agg(F.avg(((F.col("x") > F.col("cut")) == F.col("y")).cast("double")).alias("accuracy"))


def confusion_metrics(df: DataFrame, truth: Column, pred: Column) -> DataFrame:
    """Confusion counts and accuracy, sensitivity, specificity, prevalence,
    precision, F1 (positive class = TRUE)."""
    t, p = truth.cast("boolean"), pred.cast("boolean")
    c = df.agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"),
               F.count_if(~t & ~p).alias("tn"))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    sens = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    return c.select("tp", "fp", "fn", "tn", F.try_divide(F.col("tp") + F.col("tn"), n).alias("accuracy"),
                    sens.alias("sensitivity"), F.try_divide(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity"),
                    F.try_divide(F.col("tp") + F.col("fn"), n).alias("prevalence"), prec.alias("precision"),
                    F.try_divide(2 * prec * sens, prec + sens).alias("f1"))


def roc_auc(df: DataFrame, score: str, truth: Column) -> DataFrame:
    """AUC by the rank-sum (Mann-Whitney) formula with average ranks for
    ties: rows are counted per score first, and the counts summed up along the
    scores over range partitions."""
    g = df.select(F.col(score).cast("double").alias("s"), truth.cast("int").alias("y")) \
        .groupBy("s").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("c"))
    g = running_sums(g, [], ["s"], {"upto": F.col("c")})
    rank = F.col("upto") - F.col("c") + (F.col("c") + 1) / 2.0
    t = g.agg(F.sum(F.col("pos") * rank).alias("rs"), F.sum("pos").alias("n1"), F.sum("c").alias("n"))
    n0 = F.col("n") - F.col("n1")
    return t.select("n1", n0.alias("n0"), F.try_divide(F.col("rs") - F.col("n1") * (F.col("n1") + 1) / 2, F.col("n1") * n0).alias("auc"))


def roc_points(df: DataFrame, score: str, truth: Column) -> DataFrame:
    """(FPR, TPR) at every distinct score threshold (descending)."""
    d = df.select(F.col(score).alias("s"), truth.cast("int").alias("y"))
    g = d.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    tot = g.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t")).scalar()
    g = running_sums(g, [], ["s"], {"pu": F.col("pos"), "nu": F.col("neg")})
    p, n = tot.getField("p"), tot.getField("n")
    return g.select("s", ((n - F.col("nu") + F.col("neg")) / n).alias("fpr"), ((p - F.col("pu") + F.col("pos")) / p).alias("tpr"))


def logloss_rmse(df: DataFrame, prob: Column, truth: Column, eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(prob, F.lit(eps)), F.lit(1 - eps))
    y = truth.cast("double")
    return df.agg((-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("logloss"),
                  F.sqrt(F.avg(F.pow(y - prob, 2))).alias("rmse"))


def lda_qda_1d(df: DataFrame, x: str, cls: str, a, b) -> DataFrame:
    """One-feature LDA and QDA from class moments; accuracy of each rule."""
    d = df.where(F.col(cls).isin(a, b)).select(F.col(x).alias("x"), (F.col(cls) == a).alias("is_a"))
    m = d.groupBy("is_a").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mu"), F.var_samp("x").alias("v"))
    st = m.agg(F.struct(
        F.max(F.when(F.col("is_a"), F.col("mu"))).alias("mu_a"), F.max(F.when(~F.col("is_a"), F.col("mu"))).alias("mu_b"),
        F.max(F.when(F.col("is_a"), F.col("v"))).alias("v_a"), F.max(F.when(~F.col("is_a"), F.col("v"))).alias("v_b"),
        F.max(F.when(F.col("is_a"), F.col("n"))).alias("n_a"), F.max(F.when(~F.col("is_a"), F.col("n"))).alias("n_b")).alias("s")).scalar()
    na, nb = st.getField("n_a"), st.getField("n_b")
    pooled = ((na - 1) * st.getField("v_a") + (nb - 1) * st.getField("v_b")) / (na + nb - 2)
    pa, pb = F.log(na / (na + nb)), F.log(nb / (na + nb))
    xx = F.col("x")
    lda_a = xx * st.getField("mu_a") / pooled - st.getField("mu_a") ** 2 / (2 * pooled) + pa
    lda_b = xx * st.getField("mu_b") / pooled - st.getField("mu_b") ** 2 / (2 * pooled) + pb
    qda_a = -0.5 * F.log(st.getField("v_a")) - (xx - st.getField("mu_a")) ** 2 / (2 * st.getField("v_a")) + pa
    qda_b = -0.5 * F.log(st.getField("v_b")) - (xx - st.getField("mu_b")) ** 2 / (2 * st.getField("v_b")) + pb
    return d.agg(F.avg(((lda_a > lda_b) == F.col("is_a")).cast("double")).alias("lda_accuracy"),
                 F.avg(((qda_a > qda_b) == F.col("is_a")).cast("double")).alias("qda_accuracy"),
                 F.first(st.getField("mu_a")).alias("mu_a"), F.first(st.getField("mu_b")).alias("mu_b"))


def als_impute(long: DataFrame, user: str, item: str, value: str, rank: int = 5) -> DataFrame:
    """Low-rank reconstruction (``h2o.glrm`` re-aimed): ALS on the long
    (row, column, value) table, scored on held-out cells."""
    d = long.select(F.col(user).cast("int").alias("u"), F.col(item).cast("int").alias("i"), F.col(value).alias("r"))
    train, test = _split(d, ["u", "i"])
    m = ALS(userCol="u", itemCol="i", ratingCol="r", rank=rank, maxIter=10, seed=SEED, coldStartStrategy="drop").fit(train)
    p = m.transform(test)
    return p.agg(F.count(F.lit(1)).alias("n_test"), F.sqrt(F.avg(F.pow(F.col("r") - F.col("prediction"), 2))).alias("rmse"))


#: Ratings of a block of users or items at most, about: the fit takes a block whole into the memory of a task.
ALS_BLOCK = 2_000_000
#: Blocks at least (MLlib's own number).
ALS_BLOCKS = 10


def als_model(long: DataFrame, user: str, item: str, value: str, rank: int = 8):
    """ALS factorisation of a table of ratings, in as many blocks as keep each
    at about ``ALS_BLOCK`` ratings.  The first factors are drawn by block, so
    the fit depends on their number.  Factors are checkpointed every other
    iteration, which drops the shuffle files of those before."""
    d = cut_lineage(long.select(F.col(user).cast("int").alias("u"), F.col(item).cast("int").alias("i"), F.col(value).alias("r")))
    blocks = max(ALS_BLOCKS, -(-d.count() // ALS_BLOCK))
    return ALS(userCol="u", itemCol="i", ratingCol="r", rank=rank, maxIter=10, seed=SEED, implicitPrefs=False,
               numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=2, coldStartStrategy="drop").fit(d)


def als_recommend(long: DataFrame, user: str, item: str, value: str, n: int = 10, rank: int = 8) -> DataFrame:
    """Top-n recommendations per user from an ALS factorisation, exact for its
    factors (``factors.top_products``); equal scores go to the smaller item."""
    m = als_model(long, user, item, value, rank)
    best = top_products(m.userFactors, m.itemFactors, n)
    return best.select(F.col("u").cast("int").alias(user), "rank", F.col("i").cast("int").alias(item), F.col("score").cast("float").alias("score"))


def cosine_to_targets(long: DataFrame, entity: str, key: str, value: str, targets: Sequence) -> DataFrame:
    """Cosine similarity of every entity to each of a bounded set of target
    entities over shared keys.  Work per key is |targets at the key| x
    |entities at the key|, linear in the data for a fixed target set."""
    norms = long.groupBy(entity).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"))
    t = long.where(F.col(entity).isin(list(targets))).select(F.col(entity).alias("target"), key, F.col(value).alias("tv"))
    dots = long.join(t, key) \
        .groupBy("target", entity).agg(F.sum(F.col(value) * F.col("tv")).alias("dot"))
    tn = norms.select(F.col(entity).alias("target"), F.col("norm").alias("tnorm"))
    return dots.join(norms, entity).join(tn, "target").select(
        "target", entity, F.try_divide(F.col("dot"), F.col("norm") * F.col("tnorm")).alias("cosine"))


def majority_vote(preds: DataFrame, id_col: str, model: str, pred: str) -> DataFrame:
    """Vote of models held long (model, id, pred 0/1): share of votes for 1
    and the majority label (>= 50 %)."""
    return preds.groupBy(id_col).agg(F.avg(pred).alias("share"), F.count(model).alias("n_models")) \
        .withColumn("vote", (F.col("share") >= 0.5).cast("int"))


def cv_grid(df: DataFrame, estimator, grid, label: str, folds: int, fold_col: str | None = None,
            metric: str = "areaUnderROC") -> tuple:
    ev = BinaryClassificationEvaluator(labelCol=label, metricName=metric)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ev, numFolds=folds, seed=SEED,
                        foldCol=fold_col or "")
    return cv.fit(df), grid


def tvs_grid(df: DataFrame, estimator, grid, label: str, id_cols: Sequence[str], ratio: float = 0.8) -> list[float]:
    """AUC of each parameter map on held-out rows; rows are split by a hash of
    their ids, so the split does not depend on partitioning."""
    train, valid = _split(df, id_cols, ratio)
    train, valid = train.cache(), valid.cache()
    ev = BinaryClassificationEvaluator(labelCol=label)
    try:
        return [ev.evaluate(estimator.fit(train, p).transform(valid)) for p in grid]
    finally:
        train.unpersist()
        valid.unpersist()


__all__ = [n for n in dir() if not n.startswith("_")] + [
    "GBTClassifier", "LinearSVC", "LogisticRegression", "MultilayerPerceptronClassifier", "NaiveBayes",
    "RandomForestClassifier", "DecisionTreeClassifier", "ParamGridBuilder", "VectorAssembler"]


def min_support_filter(long: DataFrame, user: str, item: str, min_user: int, min_item: int) -> DataFrame:
    """Ratings whose user has more than ``min_user`` and whose item more than
    ``min_item`` ratings: counts are partial aggregates (map-side combined,
    hot users/items included) and the filter is two semi joins."""
    users = long.groupBy(user).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > min_user).select(user)
    items = long.groupBy(item).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > min_item).select(item)
    return long.join(users, user, "left_semi").join(items, item, "left_semi")


def threshold_scan_or(df: DataFrame, x1: str, x2: str, label: Column, cuts1: Sequence[float],
                      cuts2: Sequence[float]) -> DataFrame:
    """Two-feature rule ``x1 > c1 OR x2 > c2``: accuracy for every (c1, c2)
    of two literal grids, exploded per row and scored in one aggregation."""
    g = df.select(F.col(x1).alias("a"), F.col(x2).alias("b"), label.alias("y")) \
        .withColumn("c1", F.explode(F.array(*[F.lit(float(c)) for c in cuts1]))) \
        .withColumn("c2", F.explode(F.array(*[F.lit(float(c)) for c in cuts2])))
    hit = (F.col("a") > F.col("c1")) | (F.col("b") > F.col("c2"))
    return g.groupBy("c1", "c2").agg(F.avg((hit == F.col("y")).cast("double")).alias("accuracy"))
