"""Bindings for SURVEY 2.17: machine-learning pipelines (and 2.11 #168)."""

from __future__ import annotations

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import Binarizer, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from quarry.functions.columns import mix_uniform, mix_uniform_sql
from quarry.operators import ml
from quarry.plans.registry import register
from quarry.session import cut_lineage, load

S = "2.17"
FEATURES = ["log_chars", "digit_share", "upper_share", "is_en"]


def doc_features(spark, sf):
    """Per labelled document: length, digit and capital shares, language."""
    d = load(spark, sf, "documents").select(
        "doc_id", "lang", "n_chars",
        F.size(F.regexp_extract_all("text", F.lit("[0-9]"), 0)).alias("n_digits"),
        F.size(F.regexp_extract_all("text", F.lit("[A-Z]"), 0)).alias("n_upper"))
    lb = load(spark, sf, "labels")
    n = F.greatest(F.col("n_chars"), F.lit(1))
    return lb.join(d, "doc_id").select(
        "doc_id", "quality", "toxic", "n_chars", "lang", F.log1p("n_chars").alias("log_chars"),
        (F.col("n_digits") / n).alias("digit_share"), (F.col("n_upper") / n).alias("upper_share"),
        (F.col("lang") == "en").cast("double").alias("is_en"), F.col("quality").cast("double").alias("label"))


def assembled(spark, sf):
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(doc_features(spark, sf))


def emb(spark, sf):
    return ml.embedding_frame(load(spark, sf, "embeddings"))


# --------------------------------------------------------------- S-checked
@register("ml_lda_qda", section=S, sql="""
WITH d AS (SELECT value AS x, event_type = 'purchase' AS is_a FROM events WHERE event_type IN ('purchase', 'view')),
     m AS (SELECT avg(x) FILTER (WHERE is_a) AS mu_a, avg(x) FILTER (WHERE NOT is_a) AS mu_b, var_samp(x) FILTER (WHERE is_a) AS v_a,
                  var_samp(x) FILTER (WHERE NOT is_a) AS v_b, count(*) FILTER (WHERE is_a) AS n_a, count(*) FILTER (WHERE NOT is_a) AS n_b FROM d),
     p AS (SELECT *, ((n_a - 1) * v_a + (n_b - 1) * v_b) / (n_a + n_b - 2) AS pooled FROM m)
SELECT round(avg(CASE WHEN ((x * mu_a / pooled - mu_a * mu_a / (2 * pooled) + ln(n_a / (n_a + n_b)))
                         > (x * mu_b / pooled - mu_b * mu_b / (2 * pooled) + ln(n_b / (n_a + n_b)))) = is_a THEN 1.0 ELSE 0.0 END), 8) AS lda_accuracy,
       round(avg(CASE WHEN ((-0.5 * ln(v_a) - (x - mu_a) * (x - mu_a) / (2 * v_a) + ln(n_a / (n_a + n_b)))
                         > (-0.5 * ln(v_b) - (x - mu_b) * (x - mu_b) / (2 * v_b) + ln(n_b / (n_a + n_b)))) = is_a THEN 1.0 ELSE 0.0 END), 8) AS qda_accuracy,
       round(any_value(mu_a), 8) AS mu_a, round(any_value(mu_b), 8) AS mu_b FROM d, p""")
def ml_lda_qda(spark, sf):
    r = ml.lda_qda_1d(load(spark, sf, "events"), "value", "event_type", "purchase", "view")
    return r.select(*[F.round(c, 8).alias(c) for c in ("lda_accuracy", "qda_accuracy", "mu_a", "mu_b")])


CUTS = [25.0 * i for i in range(21)]


@register("ml_threshold_scan", section=S, sql=f"""
WITH c AS (SELECT CAST(unnest({CUTS}) AS DOUBLE) AS cut)
SELECT cut, round(avg(CASE WHEN (value > cut) = (event_type = 'purchase') THEN 1.0 ELSE 0.0 END), 8) AS accuracy
FROM events, c GROUP BY cut""")
def ml_threshold_scan(spark, sf):
    t = ml.threshold_scan(load(spark, sf, "events"), "value", F.col("event_type") == "purchase", CUTS)
    return t.select("cut", F.round("accuracy", 8).alias("accuracy"))


CUTS_K = [10.0 * i for i in range(11)]


@register("ml_threshold_scan_or", section=S, sql=f"""
WITH e AS (SELECT value AS a, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS b, event_type = 'purchase' AS y FROM events),
     g AS (SELECT * FROM e, (SELECT CAST(unnest({CUTS[::2]}) AS DOUBLE) AS c1), (SELECT CAST(unnest({CUTS_K}) AS DOUBLE) AS c2))
SELECT c1, c2, round(avg(CASE WHEN (a > c1 OR b > c2) = y THEN 1.0 ELSE 0.0 END), 8) AS accuracy FROM g GROUP BY c1, c2""")
def ml_threshold_scan_or(spark, sf):
    """Two-feature OR rule (value, props.k) for 'purchase', all cut-off pairs."""
    e = load(spark, sf, "events").select("value", F.get_json_object("props", "$.k").cast("double").alias("k"), "event_type")
    t = ml.threshold_scan_or(e, "value", "k", F.col("event_type") == "purchase", CUTS[::2], CUTS_K)
    return t.select("c1", "c2", F.round("accuracy", 8).alias("accuracy"))


DOC_SQL = "SELECT doc_id, quality, n_chars FROM labels JOIN documents USING (doc_id)"


@register("ml_rule_baseline", section=S, sql=f"""
SELECT lang, count(*) AS n, round(avg(CASE WHEN (n_chars > 2000) = (quality = 1) THEN 1.0 ELSE 0.0 END), 8) AS accuracy
FROM labels JOIN documents USING (doc_id) GROUP BY lang""")
def ml_rule_baseline(spark, sf):
    d = doc_features(spark, sf)
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(
        ((F.col("n_chars") > 2000) == (F.col("quality") == 1)).cast("double")), 8).alias("accuracy"))


@register("ml_confusion_metrics", section=S, sql=f"""
WITH d AS (SELECT quality = 1 AS t, n_chars > 2000 AS p FROM ({DOC_SQL})),
     c AS (SELECT count(*) FILTER (WHERE t AND p) AS tp, count(*) FILTER (WHERE NOT t AND p) AS fp,
                  count(*) FILTER (WHERE t AND NOT p) AS fn, count(*) FILTER (WHERE NOT t AND NOT p) AS tn FROM d)
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 8) AS accuracy, round(tp / (tp + fn), 8) AS sensitivity,
       round(tn / (tn + fp), 8) AS specificity, round((tp + fn) / (tp + fp + fn + tn), 8) AS prevalence,
       round(tp / (tp + fp), 8) AS precision, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))), 8) AS f1 FROM c""")
def ml_confusion_metrics(spark, sf):
    c = ml.confusion_metrics(doc_features(spark, sf), F.col("quality") == 1, F.col("n_chars") > 2000)
    return c.select("tp", "fp", "fn", "tn", *[F.round(k, 8).alias(k) for k in
                                               ("accuracy", "sensitivity", "specificity", "prevalence", "precision", "f1")])


@register("ml_roc_auc", section=S, sql=f"""
WITH g AS (SELECT n_chars AS s, count(*) AS c, sum(quality) AS pos FROM ({DOC_SQL}) GROUP BY 1),
     r AS (SELECT *, coalesce(sum(c) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (c + 1) / 2.0 AS avg_rank FROM g),
     t AS (SELECT sum(pos * avg_rank) AS rs, sum(pos) AS n1, sum(c) AS n FROM r)
SELECT CAST(n1 AS BIGINT) AS n1, CAST(n - n1 AS BIGINT) AS n0, round((rs - n1 * (n1 + 1) / 2) / (n1 * (n - n1)), 10) AS auc FROM t""")
def ml_roc_auc(spark, sf):
    a = ml.roc_auc(doc_features(spark, sf), "n_chars", F.col("quality") == 1)
    return a.select(F.col("n1").cast("long").alias("n1"), F.col("n0").cast("long").alias("n0"), F.round("auc", 10).alias("auc"))


@register("ml_logloss_rmse", section=S, sql=f"""
WITH d AS (SELECT quality, 1 / (1 + exp(-(ln(1 + n_chars) - 7))) AS p FROM ({DOC_SQL}))
SELECT round(-avg(quality * ln(least(greatest(p, 1e-15), 1 - 1e-15)) + (1 - quality) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15))), 8) AS logloss,
       round(sqrt(avg((quality - p) * (quality - p))), 8) AS rmse FROM d""")
def ml_logloss_rmse(spark, sf):
    d = doc_features(spark, sf).withColumn("p", 1 / (1 + F.exp(-(F.col("log_chars") - 7))))
    r = ml.logloss_rmse(d, F.col("p"), F.col("quality"))
    return r.select(F.round("logloss", 8).alias("logloss"), F.round("rmse", 8).alias("rmse"))


@register("ml_binarize", section=S, sql="""
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS DOUBLE) AS liked FROM lineitem""")
def ml_binarize(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return Binarizer(threshold=25.0, inputCol="l_quantity", outputCol="liked").transform(li).drop("l_quantity")


@register("ml_min_support_filter", section=S, sql="""
SELECT l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_suppkey) AS ns, count(*) OVER (PARTITION BY l_partkey) AS np FROM lineitem)
WHERE ns > 600 AND np > 30""")
def ml_min_support_filter(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return ml.min_support_filter(li, "l_suppkey", "l_partkey", 600, 30).select("l_orderkey", "l_linenumber")


RATINGS_SQL = """SELECT o_custkey AS customer, l_partkey AS part, sum(l_quantity) AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""


def ratings(spark, sf):
    li = load(spark, sf, "lineitem").join(load(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return li.groupBy(F.col("o_custkey").alias("customer"), F.col("l_partkey").alias("part")).agg(F.sum("l_quantity").alias("qty"))


@register("ml_cosine_similarity", section=S, sql=f"""
WITH r AS ({RATINGS_SQL}), nrm AS (SELECT part, sqrt(sum(qty * qty)) AS norm FROM r GROUP BY 1),
     t AS (SELECT part AS target, customer, qty AS tv FROM r WHERE part IN (0, 1, 2, 3)),
     d AS (SELECT target, r.part, sum(qty * tv) AS dot FROM r JOIN t USING (customer) GROUP BY 1, 2)
SELECT target, d.part, round(dot / (a.norm * b.norm), 8) AS cosine FROM d JOIN nrm a ON a.part = d.part JOIN nrm b ON b.part = d.target""")
def ml_cosine_similarity(spark, sf):
    c = ml.cosine_to_targets(ratings(spark, sf), "part", "customer", "qty", [0, 1, 2, 3])
    return c.select("target", "part", F.round("cosine", 8).alias("cosine"))


# -------------------------------------------------------------- MLlib fits
@register("ml_kmeans", section=S)
def ml_kmeans(spark, sf):
    return ml.kmeans_sizes(emb(spark, sf), 10)


@register("ml_kmeans_elbow", section=S)
def ml_kmeans_elbow(spark, sf):
    return ml.kmeans_elbow(load(spark, sf, "embeddings"), "embedding", list(range(1, 11)))


@register("ml_silhouette", section=S)
def ml_silhouette(spark, sf):
    return ml.silhouette_by_k(load(spark, sf, "embeddings"), "embedding", [2, 3, 4, 5, 6])


@register("ml_gap_statistic", section=S)
def ml_gap_statistic(spark, sf):
    return ml.gap_statistic(load(spark, sf, "embeddings"), "embedding", "vec_id", [2, 3, 4], b=3)


@register("ml_cluster_profile", section=S)
def ml_cluster_profile(spark, sf):
    return ml.cluster_profile(load(spark, sf, "embeddings"), "embedding", 10, "label")


@register("ml_pca", section=S)
def ml_pca(spark, sf):
    return ml.pca_table(load(spark, sf, "embeddings"), "embedding", 10)


@register("ml_svd", section=S)
def ml_svd(spark, sf):
    return ml.svd_values(load(spark, sf, "embeddings"), "embedding", 10)


DOC_FEATURES_SQL = """SELECT doc_id, quality, ln(1 + n_chars) AS x1, len(regexp_extract_all(text, '[0-9]')) / greatest(n_chars, 1) AS x2,
       len(regexp_extract_all(text, '[A-Z]')) / greatest(n_chars, 1) AS x3, CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END AS x4
       FROM labels JOIN documents USING (doc_id) WHERE text IS NOT NULL AND n_chars IS NOT NULL AND lang IS NOT NULL"""
TIGHT = {"maxIter": 300, "tol": 1e-13}  # to the maximum, not to the default tolerance


def _newton_sql(rows: str, features: int, steps: int = 15, ridge: float = 0.0) -> str:
    """CTEs ``n0`` .. ``n<steps>`` of Newton's method for the logistic likelihood
    of ``rows`` (grp, quality, x1 .. xk), one fit per ``grp``: sums of score and
    information over the rows, then one elimination stage a column; each stage
    reads the one before only.  ``ridge`` penalises the squares of the coefficients
    of standardized columns by rows * ridge / 2, as MLlib's ``regParam`` does."""
    ks = range(features + 1)
    x = ["1.0", *[f"x{i}" for i in ks[1:]]]
    coef = [f"c{i}" for i in ks]
    parts = [f"n0 AS MATERIALIZED (SELECT DISTINCT grp, {', '.join(f'CAST(0 AS DOUBLE) AS {c}' for c in coef)} FROM {rows})"]
    eta = " + ".join(f"{c} * {v}" for c, v in zip(coef, x))
    pull = [f" + {ridge} * count(*) * var_samp({v})" if ridge and i else "" for i, v in enumerate(x)]
    for step in range(1, steps + 1):
        sums = [f"sum(p * (1 - p) * {x[i]} * {x[j]}){pull[i] if i == j else ''} AS m{i}_{j}" for i in ks for j in ks]
        sums += [f"sum((quality - p) * {x[i]}){pull[i].replace('+', '-') + f' * any_value(c{i})' if pull[i] else ''} AS m{i}_{features + 1}" for i in ks]
        keep = ", ".join(f"any_value({c}) AS {c}" for c in coef)
        parts.append(f"s{step}_0 AS MATERIALIZED (SELECT grp, {keep}, {', '.join(sums)} FROM (SELECT *, 1 / (1 + exp(-({eta}))) AS p "
                     f"FROM {rows} JOIN n{step - 1} USING (grp)) GROUP BY grp)")
        for k in ks:
            cells = [f"m{i}_{j}" if i == k else f"m{i}_{j} - m{i}_{k} / m{k}_{k} * m{k}_{j} AS m{i}_{j}" for i in ks for j in range(features + 2)]
            parts.append(f"s{step}_{k + 1} AS MATERIALIZED (SELECT grp, {', '.join(coef)}, {', '.join(cells)} FROM s{step}_{k})")
        parts.append(f"n{step} AS MATERIALIZED (SELECT grp, "
                     + ", ".join(f"c{i} + m{i}_{features + 1} / m{i}_{i} AS c{i}" for i in ks) + f" FROM s{step}_{features + 1})")
    return ",\n".join(parts)


ETA_SQL = "c0 + " + " + ".join(f"c{i} * x{i}" for i in range(1, 5))


def _logistic_sql(train: str, test: str, columns: str) -> str:
    return f"""WITH d AS MATERIALIZED (SELECT 0 AS grp, * FROM ({DOC_FEATURES_SQL})), tr AS MATERIALIZED (SELECT * FROM d WHERE {train}),
{_newton_sql("tr", 4)},
f AS (SELECT doc_id, quality, 1 / (1 + exp(-({ETA_SQL}))) AS p FROM (SELECT * FROM d WHERE {test}), n15)
SELECT {columns} FROM f"""


@register("ml_logistic", section=S, sql=_logistic_sql(
    "true", "true", "doc_id, quality, round(p, 3) AS prob, CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS pred"))
def ml_logistic(spark, sf):
    d = doc_features(spark, sf)
    m = ml.fit_logistic(d, "label", FEATURES, **TIGHT)
    return ml.score_probability(m, d, ["doc_id", "quality"]).withColumn("prob", F.round("prob", 3))


@register("vector_element", section="2.11", sql=_logistic_sql("true", "true", "doc_id, round(p, 3) AS prob"))
def vector_element(spark, sf):
    d = doc_features(spark, sf)
    m = ml.fit_logistic(d, "label", FEATURES, **TIGHT)
    return ml.score_probability(m, d, ["doc_id"]).select("doc_id", F.round("prob", 3).alias("prob"))


@register("ml_multinomial_logistic", section=S)
def ml_multinomial_logistic(spark, sf):
    return ml.classifier_report(emb(spark, sf), LogisticRegression(family="multinomial", maxIter=100), "label",
                                ["vec_id"], "multinom")


@register("ml_linear_svm", section=S)
def ml_linear_svm(spark, sf):
    return ml.classifier_report(assembled(spark, sf), LinearSVC(maxIter=50, regParam=0.01), "label", ["doc_id"], "svmLinear")


@register("ml_elastic_net_cv", section=S)
def ml_elastic_net_cv(spark, sf):
    lr = LogisticRegression(maxIter=50)
    grid = ParamGridBuilder().addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0]).addGrid(lr.regParam, [0.001, 0.01, 0.1]).build()
    d = assembled(spark, sf).withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(3)).cast("int"))  # folds by hash of the id
    cvm, grid = ml.cv_grid(d, lr, grid, "label", 3, fold_col="fold")
    rows = [(float(p[lr.elasticNetParam]), float(p[lr.regParam]), float(m)) for p, m in zip(grid, cvm.avgMetrics)]
    return spark.createDataFrame(rows, "alpha double, lambda double, auc double")


@register("ml_random_search", section=S)
def ml_random_search(spark, sf):
    import random
    lr = LogisticRegression(maxIter=50)
    full = ParamGridBuilder().addGrid(lr.elasticNetParam, [0.0, 0.25, 0.5, 0.75, 0.99]) \
        .addGrid(lr.regParam, [0.0001, 0.001, 0.01, 0.1]).build()
    grid = random.Random(42).sample(full, 8)  # RandomDiscrete: seeded sample capped by model count
    metrics = ml.tvs_grid(assembled(spark, sf), lr, grid, "label", ["doc_id"])
    rows = [(float(p[lr.elasticNetParam]), float(p[lr.regParam]), float(v)) for p, v in zip(grid, metrics)]
    return spark.createDataFrame(rows, "alpha double, lambda double, auc double")


@register("ml_cross_validate", section=S, sql=f"""
WITH d AS MATERIALIZED ({DOC_FEATURES_SQL}), tr AS MATERIALIZED (SELECT grp, d.* FROM d, range(5) t(grp) WHERE doc_id % 5 <> grp),
{_newton_sql("tr", 4, ridge=0.01)},
f AS (SELECT grp, quality, {ETA_SQL} AS score FROM d JOIN n15 ON doc_id % 5 = grp),
r AS (SELECT grp, quality, rank() OVER (PARTITION BY grp ORDER BY score) + (count(*) OVER (PARTITION BY grp, score) - 1) / 2.0 AS pos FROM f),
a AS (SELECT grp, (sum(pos) FILTER (WHERE quality = 1) - sum(quality) * (sum(quality) + 1) / 2.0) / (sum(quality) * sum(1 - quality)) AS auc FROM r GROUP BY 1)
SELECT CAST(count(*) AS INTEGER) AS folds, round(avg(auc), 6) AS auc, round(stddev_pop(auc), 6) AS auc_sd FROM a""")
def ml_cross_validate(spark, sf):
    d = assembled(spark, sf).withColumn("fold", F.pmod(F.col("doc_id"), F.lit(5)).cast("int"))  # Modulo fold assignment
    lr = LogisticRegression(**TIGHT)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.01]).build()
    cvm, grid = ml.cv_grid(d, lr, grid, "label", 5, fold_col="fold")
    return spark.createDataFrame([(5, round(float(cvm.avgMetrics[0]), 6), round(float(cvm.stdMetrics[0]), 6))],
                                 "folds int, auc double, auc_sd double")


@register("ml_decision_tree", section=S)
def ml_decision_tree(spark, sf):
    d = assembled(spark, sf)
    parts = [ml.classifier_report(d, DecisionTreeClassifier(maxDepth=k, seed=42), "label", ["doc_id"], f"depth{k}")
             for k in (2, 4, 6)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("ml_random_forest", section=S)
def ml_random_forest(spark, sf):
    d = assembled(spark, sf)
    m = RandomForestClassifier(numTrees=50, featureSubsetStrategy="sqrt", seed=42).fit(d)
    return spark.createDataFrame([(f, float(v)) for f, v in zip(FEATURES, m.featureImportances.toArray())],
                                 "feature string, importance double")


@register("ml_gbt", section=S)
def ml_gbt(spark, sf):
    d = assembled(spark, sf)
    train, test = ml._split(d, ["doc_id"])
    m = GBTClassifier(maxIter=30, maxDepth=3, stepSize=0.1, seed=42).fit(train)
    losses = m.evaluateEachIteration(test)
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(losses)], "iteration int, test_loss double")


@register("ml_naive_bayes", section=S, sql=f"""
WITH e AS (SELECT vec_id, label, {mix_uniform_sql(['vec_id'], 42)} < 0.8 AS train, unnest(CAST(embedding AS DOUBLE[])) AS x,
                  unnest(range(len(embedding))) AS j FROM embeddings),
     all_var AS (SELECT max(v) AS v FROM (SELECT var_pop(x) AS v FROM e WHERE train GROUP BY j)),
     g AS (SELECT label AS guess, j, avg(x) AS mu, var_pop(x) + 1e-9 * (SELECT v FROM all_var) AS v, count(*) AS n FROM e WHERE train GROUP BY 1, 2),
     s AS (SELECT vec_id, label, guess, ln(any_value(n)) - 0.5 * sum(ln(g.v) + (x - mu) * (x - mu) / g.v) AS score
           FROM e JOIN g USING (j) WHERE NOT train GROUP BY 1, 2, 3),
     b AS (SELECT vec_id, label, arg_max(guess, score) AS guess FROM s GROUP BY 1, 2)
SELECT 'naive_bayes' AS model, count(*) AS n_test, round(avg(CASE WHEN guess = label THEN 1.0 ELSE 0.0 END), 8) AS accuracy FROM b""")
def ml_naive_bayes(spark, sf):
    r = ml.classifier_report(emb(spark, sf), NaiveBayes(modelType="gaussian"), "label", ["vec_id"], "naive_bayes",
                             uniform=lambda *cs: mix_uniform(*cs, seed=42))
    return r.withColumn("accuracy", F.round("accuracy", 8))


@register("ml_mlp", section=S)
def ml_mlp(spark, sf):
    est = MultilayerPerceptronClassifier(layers=[64, 32, 10], maxIter=100, seed=42)
    return ml.classifier_report(emb(spark, sf), est, "label", ["vec_id"], "mlp")


@register("ml_training_history", section=S)
def ml_training_history(spark, sf):
    m = LogisticRegression(maxIter=50).fit(assembled(spark, sf))
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(m.summary.objectiveHistory)], "iteration int, loss double")


@register("ml_reconstruction_anomaly", section=S)
def ml_reconstruction_anomaly(spark, sf):
    return ml.pca_reconstruction_error(load(spark, sf, "embeddings"), "embedding", "vec_id", 8)


@register("ml_low_rank_impute", section=S)
def ml_low_rank_impute(spark, sf):
    return ml.als_impute(ratings(spark, sf), "customer", "part", "qty")


@register("ml_recommend_items", section=S)
def ml_recommend_items(spark, sf):
    return ml.als_recommend(ratings(spark, sf), "customer", "part", "qty", n=10)


def _model_predictions(spark, sf):
    d = assembled(spark, sf)
    train, test = ml._split(d, ["doc_id"])
    ests = {"logistic": LogisticRegression(maxIter=50), "tree": DecisionTreeClassifier(maxDepth=4, seed=42),
            "forest": RandomForestClassifier(numTrees=30, seed=42), "gbt": GBTClassifier(maxIter=20, seed=42),
            "svm": LinearSVC(maxIter=50)}
    out = None
    for name, est in ests.items():
        p = est.fit(train).transform(test).select("doc_id", "label", F.lit(name).alias("model"),
                                                  F.col("prediction").cast("int").alias("pred"))
        out = p if out is None else out.unionByName(p)
    return out


@register("ml_majority_vote", section=S)
def ml_majority_vote(spark, sf):
    return ml.majority_vote(_model_predictions(spark, sf), "doc_id", "model", "pred")


@register("ml_compare_models", section=S)
def ml_compare_models(spark, sf):
    p = _model_predictions(spark, sf)
    acc = p.groupBy("model").agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"))
    vote = ml.majority_vote(p, "doc_id", "model", "pred").join(p.select("doc_id", "label").distinct(), "doc_id")
    va = vote.agg(F.avg((F.col("vote") == F.col("label")).cast("double"))).scalar()
    return acc.withColumn("vote_accuracy", va).withColumn("beats_vote", F.col("accuracy") > F.col("vote_accuracy"))


@register("ml_stacking", section=S)
def ml_stacking(spark, sf):
    """Out-of-fold base predictions (fold column) feed a logistic meta model."""
    d = assembled(spark, sf).withColumn("fold", F.pmod(F.col("doc_id"), F.lit(3)).cast("int"))
    oof = None
    for k in range(3):
        tr, te = d.where(F.col("fold") != k), d.where(F.col("fold") == k)
        a = LogisticRegression(maxIter=50, probabilityCol="pa", rawPredictionCol="ra", predictionCol="qa").fit(tr).transform(te)
        b = RandomForestClassifier(numTrees=30, seed=42, probabilityCol="pb", rawPredictionCol="rb", predictionCol="qb").fit(tr).transform(a)
        part = b.select("doc_id", "label", ml.vector_to_array("pa")[1].alias("p_logistic"), ml.vector_to_array("pb")[1].alias("p_forest"))
        oof = part if oof is None else oof.unionByName(part)
    meta = VectorAssembler(inputCols=["p_logistic", "p_forest"], outputCol="features").transform(oof)
    m = LogisticRegression(maxIter=50).fit(meta)
    return spark.createDataFrame([("p_logistic", float(m.coefficients[0])), ("p_forest", float(m.coefficients[1])),
                                  ("(Intercept)", float(m.intercept))], "term string, weight double")


@register("ml_score_new_rows", section=S, sql=_logistic_sql(
    f"{mix_uniform_sql(['doc_id'], 42)} < 0.8", f"{mix_uniform_sql(['doc_id'], 42)} >= 0.8",
    "doc_id, quality, round(p, 3) AS prob, CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS pred"))
def ml_score_new_rows(spark, sf):
    train, test = ml._split(doc_features(spark, sf), ["doc_id"], uniform=lambda *cs: mix_uniform(*cs, seed=42))
    m = ml.fit_logistic(train, "label", FEATURES, **TIGHT)
    return ml.score_probability(m, test, ["doc_id", "quality"]).withColumn("prob", F.round("prob", 3))


# ------------------------------------------------------------ 2.19 closures
from quarry.functions import closures as cl  # noqa: E402


@register("udf_scalar_closure", section="2.19", sql="""
SELECT l_orderkey, l_linenumber, (l_quantity - 1) / 49 AS l_quantity, (l_discount - 0.0) / 0.1 AS l_discount FROM lineitem""")
def udf_scalar_closure(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return li.withColumns({"l_quantity": cl.rescale(1.0, 50.0)(F.col("l_quantity")),
                           "l_discount": cl.rescale(0.0, 0.1)(F.col("l_discount"))})


@register("udaf_closure", section="2.19", sql="""
SELECT l_suppkey, count(*) AS n, CASE WHEN count(l_quantity) >= 600 THEN round(avg(l_quantity), 6) END AS mean_qty
FROM lineitem GROUP BY l_suppkey""")
def udaf_closure(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.round(cl.guarded_mean(600)(F.col("l_quantity")), 6).alias("mean_qty"))


@register("udtf_group_closure", section="2.19", sql="""
SELECT l_returnflag, CAST(count(*) AS DOUBLE) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem GROUP BY 1""")
def udtf_group_closure(spark, sf):
    li = load(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    r = cl.group_table_closure(li, ["l_returnflag"], cl.ols_partial(["l_returnflag"], "l_extendedprice", "l_quantity"),
                               "l_returnflag string, n double, sx double, sy double, sxx double, sxy double", cl.ols_finalize)
    return r.select("l_returnflag", "n", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


def _order_table(df, status, prefix):
    """Read + rename + date: the parameterised cleaning function."""
    return df.where(F.col("o_orderstatus") == status).select(
        F.col("o_orderkey").alias(f"{prefix}_id"), F.col("o_totalprice").alias(f"{prefix}_price"),
        F.trunc("o_orderdate", "month").alias("month"))


@register("udf_whole_table", section="2.19", sql="""
SELECT o_orderkey AS f_id, o_totalprice AS f_price, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders WHERE o_orderstatus = 'F'""")
def udf_whole_table(spark, sf):
    return load(spark, sf, "orders").transform(cl.table_function(_order_table, "F", "f"))


# ---------------------------------------------- distance-based (no all pairs)
from quarry.operators import neighbors as nb  # noqa: E402
from quarry.operators import linkage as lk  # noqa: E402
from quarry.operators import pivots as pv  # noqa: E402

TARGETS = [3, 17, 58, 101, 160, 222]


@register("join_self_pairwise_distance", section="2.3", sql=f"""
SELECT t.vec_id AS target, e.vec_id, round(sqrt(list_sum(list_transform(list_zip(CAST(e.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])),
       lambda z: (z[1] - z[2]) * (z[1] - z[2])))), 8) AS dist
FROM embeddings e, embeddings t WHERE t.vec_id IN ({", ".join(map(str, TARGETS))})""")
def join_self_pairwise_distance(spark, sf):
    d = nb.distances_to_targets(load(spark, sf, "embeddings"), "vec_id", "embedding", TARGETS)
    return d.select("target", "vec_id", F.round("dist", 8).alias("dist"))


KS = list(range(1, 92, 2))


@register("ml_knn", section=S, sql=f"""
WITH d AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS x, quality FROM labels JOIN documents USING (doc_id)),
     tr AS (SELECT * FROM d WHERE doc_id % 2 = 1), te AS (SELECT * FROM d WHERE doc_id % 2 = 0),
     p AS (SELECT te.doc_id AS te_id, tr.quality AS tr_label,
                  row_number() OVER (PARTITION BY te.doc_id ORDER BY abs(tr.x - te.x), tr.x, CASE WHEN tr.x < te.x THEN -tr.doc_id ELSE tr.doc_id END) AS nn_rank FROM te, tr),
     c AS (SELECT te_id, nn_rank, sum(tr_label) OVER (PARTITION BY te_id ORDER BY nn_rank ROWS UNBOUNDED PRECEDING) AS ones,
                  first(tr_label) OVER (PARTITION BY te_id ORDER BY nn_rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS nearest
           FROM p WHERE nn_rank <= {max(KS)}),
     v AS (SELECT te_id, nn_rank AS k, CASE WHEN 2 * ones > nn_rank THEN 1 WHEN 2 * ones < nn_rank THEN 0 ELSE nearest END AS pred
           FROM c WHERE nn_rank IN ({", ".join(map(str, KS))}))
SELECT CAST(k AS INTEGER) AS k, round(avg(CASE WHEN pred = quality THEN 1.0 ELSE 0.0 END), 8) AS accuracy,
       round(2.0 * count(*) FILTER (WHERE pred = 1 AND quality = 1) / (2 * count(*) FILTER (WHERE pred = 1 AND quality = 1)
             + count(*) FILTER (WHERE pred = 1 AND quality = 0) + count(*) FILTER (WHERE pred = 0 AND quality = 1)), 8) AS f1
FROM v JOIN te ON te.doc_id = v.te_id GROUP BY k""")
def ml_knn(spark, sf):
    d = doc_features(spark, sf).select("doc_id", F.col("n_chars").cast("double").alias("x"), "quality")
    odd = F.pmod(F.col("doc_id"), F.lit(2)) == 1
    train, test = d.where(odd), d.where(~odd)
    nn = nb.knn_1d(train, test, "doc_id", "x", "quality", max(KS))
    truth = test.select(F.col("doc_id").alias("te_id"), F.col("quality").alias("y"))
    r = nb.knn_scan(nn, truth, KS)
    return r.select(F.col("k").cast("int").alias("k"), F.round("accuracy", 8).alias("accuracy"), F.round("f1", 8).alias("f1"))


@register("ml_knn_features", section=S, sql="""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings),
     p AS (SELECT q.vec_id AS query_id, q.label AS truth, e.vec_id, e.label, sqrt(list_sum(list_transform(list_zip(q.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS dist
           FROM e q JOIN e ON q.vec_id % 20 = 0 AND e.vec_id % 20 <> 0),
     r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist, vec_id) AS INTEGER) AS nn_rank FROM p),
     n AS (SELECT * FROM r WHERE nn_rank <= 7),
     c AS (SELECT query_id, label, count(*) AS m, min(nn_rank) AS f FROM n GROUP BY 1, 2),
     v AS (SELECT query_id, label AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY m DESC, f) AS o FROM c) WHERE o = 1)
SELECT n.query_id, nn_rank, n.vec_id, round(dist, 8) AS dist, predicted, truth FROM n JOIN v USING (query_id)""")
def ml_knn_features(spark, sf):
    e = load(spark, sf, "embeddings")
    asked = F.pmod(F.col("vec_id"), F.lit(20)) == 0
    near = cut_lineage(pv.knn(e.where(~asked), e.where(asked), "vec_id", "embedding", 7, keep=("label",)))  # used twice
    truth = e.where(asked).select(F.col("vec_id").alias("query_id"), F.col("label").alias("truth"))
    return near.join(pv.vote(near, "label"), "query_id").join(truth, "query_id") \
        .select("query_id", "nn_rank", F.col("id").alias("vec_id"), F.round("dist", 8).alias("dist"), "predicted", "truth")


CUST_GEO_SQL = ("SELECT c_custkey, CAST((c_custkey * 13) % 140 AS DOUBLE) - 70 + (c_custkey % 7) / 10.0 AS lat, "
                "CAST((c_custkey * 29) % 360 AS DOUBLE) - 180 + (c_custkey % 3) / 10.0 AS lon FROM customer")
HAV = ("2 * 6378137.0 * asin(least(1.0, sqrt(power(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + "
       "cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin((radians(b.lon) - radians(a.lon)) / 2), 2))))")


@register("ml_single_linkage_cut", section=S, sql=f"""
WITH RECURSIVE p AS ({CUST_GEO_SQL}),
     e AS (SELECT a.c_custkey AS src, b.c_custkey AS dst FROM p a, p b WHERE a.c_custkey <> b.c_custkey AND {HAV} <= 400000),
     r(v, c) AS (SELECT c_custkey, c_custkey FROM p UNION SELECT e.dst, r.c FROM r JOIN e ON r.v = e.src)
SELECT v AS c_custkey, min(c) AS component FROM r GROUP BY v""")
def ml_single_linkage_cut(spark, sf):
    k = F.col("c_custkey")
    pts = load(spark, sf, "customer").select(
        "c_custkey", (F.pmod(k * 13, F.lit(140)).cast("double") - 70 + F.pmod(k, F.lit(7)) / 10.0).alias("lat"),
        (F.pmod(k * 29, F.lit(360)).cast("double") - 180 + F.pmod(k, F.lit(3)) / 10.0).alias("lon"))
    return lk.single_linkage_cut(pts, "c_custkey", "lat", "lon", 400_000.0)
