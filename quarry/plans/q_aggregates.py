"""Bindings for SURVEY 2.4: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.distributions import norm_ppf_sql
from quarry.operators import aggregates as agg
from quarry.operators.quantiles import quantile_wide
from quarry.plans.registry import register
from quarry.session import load

S = "2.4"


@register("simpson_rates", section=S, sql="""
WITH fine AS (SELECT l_returnflag, l_linestatus, count(*) AS n,
                     CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS successes
              FROM lineitem GROUP BY l_returnflag, l_linestatus),
     both_levels AS (SELECT * FROM fine UNION ALL
                     SELECT l_returnflag, 'ALL', CAST(sum(n) AS BIGINT), CAST(sum(successes) AS BIGINT) FROM fine GROUP BY l_returnflag)
SELECT l_returnflag, l_linestatus, n, successes, successes / n AS rate,
       n / sum(n) OVER (PARTITION BY l_returnflag, l_linestatus = 'ALL') AS share_of_treatment FROM both_levels""")
def simpson_rates(spark, sf):
    li = load(spark, sf, "lineitem")
    return agg.simpson_rates(li, "l_returnflag", "l_linestatus", F.col("l_discount") > 0.05)


@register("count_group", section=S, sql="SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def count_group(spark, sf):
    return agg.count_group(load(spark, sf, "events"), "event_type")


@register("count_computed_key", section=S, sql="""
SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY ALL""")
def count_computed_key(spark, sf):
    return agg.count_group(load(spark, sf, "events"), "event_type", F.hour("ts").alias("hour"))


@register("count_sorted", section=S, sql="SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id")
def count_sorted(spark, sf):
    return agg.count_group(load(spark, sf, "events"), "user_id", sort=True)


@register("crosstab", section=S, sql="""
SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS "F", count(*) FILTER (WHERE l_linestatus = 'O') AS "O"
FROM lineitem GROUP BY l_returnflag""")
def crosstab(spark, sf):
    return agg.crosstab(load(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


@register("crosstab_row_share", section=S, sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag) AS share
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def crosstab_row_share(spark, sf):
    return agg.crosstab_row_share(load(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@register("count_keep_null_group", section=S, sql="""
SELECT nullif(event_type, 'error') AS event_type, count(*) AS n FROM events GROUP BY 1""")
def count_keep_null_group(spark, sf):
    ev = load(spark, sf, "events").select(F.nullif("event_type", F.lit("error")).alias("event_type"))
    return agg.count_group(ev, "event_type")


@register("agg_basic", section=S, sql="""
SELECT l_returnflag, sum(l_quantity) AS sum_qty, round(avg(l_extendedprice), 4) AS avg_price,
       min(l_discount) AS min_disc, max(l_discount) AS max_disc, count(*) AS n FROM lineitem GROUP BY 1""")
def agg_basic(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
        F.min("l_discount").alias("min_disc"), F.max("l_discount").alias("max_disc"), F.count(F.lit(1)).alias("n"))


@register("agg_median", section=S, sql="""
SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.5), 4) AS median_price FROM orders GROUP BY 1""")
def agg_median(spark, sf):
    m = quantile_wide(load(spark, sf, "orders"), "o_totalprice", [0.5], ["median_price"], ["o_orderstatus"])
    return m.select("o_orderstatus", F.round("median_price", 4).alias("median_price"))


@register("agg_quantile", section=S, sql="""
SELECT l_linestatus, round(quantile_cont(l_extendedprice, 0.1), 4) AS p10, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90
FROM lineitem GROUP BY 1""")
def agg_quantile(spark, sf):
    q = quantile_wide(load(spark, sf, "lineitem"), "l_extendedprice", [0.1, 0.9], ["p10", "p90"], ["l_linestatus"])
    return q.select("l_linestatus", F.round("p10", 4).alias("p10"), F.round("p90", 4).alias("p90"))


@register("agg_var_sd", section=S, sql="""
SELECT l_returnflag, round(var_samp(l_quantity), 6) AS var_qty, round(stddev_samp(l_quantity), 6) AS sd_qty,
       round(stddev_samp(l_extendedprice), 3) AS sd_price FROM lineitem GROUP BY 1""")
def agg_var_sd(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.var_samp("l_quantity"), 6).alias("var_qty"), F.round(F.stddev_samp("l_quantity"), 6).alias("sd_qty"),
        F.round(F.stddev_samp("l_extendedprice"), 3).alias("sd_price"))


@register("agg_skew_kurtosis", section=S, sql="""
WITH m AS (SELECT event_type, avg(value) AS mu FROM events GROUP BY 1),
     c AS (SELECT event_type, avg(power(value - mu, 2)) AS m2, avg(power(value - mu, 3)) AS m3, avg(power(value - mu, 4)) AS m4
           FROM events JOIN m USING (event_type) GROUP BY 1)
SELECT event_type, round(m3 / power(m2, 1.5), 6) AS skewness, round(m4 / (m2 * m2), 6) AS kurtosis FROM c""")
def agg_skew_kurtosis(spark, sf):
    return load(spark, sf, "events").groupBy("event_type").agg(
        F.round(F.skewness("value"), 6).alias("skewness"), F.round(agg.kurtosis_raw("value"), 6).alias("kurtosis"))


@register("agg_mean_na_rm", section=S, sql="""
WITH e AS (SELECT event_type, CASE WHEN event_type = 'error' AND value < 5 THEN NULL ELSE value END AS v FROM events)
SELECT event_type, round(avg(v), 6) AS mean_na_rm,
       CASE WHEN count(*) FILTER (WHERE v IS NULL) > 0 THEN NULL ELSE round(avg(v), 6) END AS mean_strict FROM e GROUP BY 1""")
def agg_mean_na_rm(spark, sf):
    e = load(spark, sf, "events").select("event_type", F.when(
        (F.col("event_type") == "error") & (F.col("value") < 5), None).otherwise(F.col("value")).alias("v"))
    return e.groupBy("event_type").agg(F.round(F.avg("v"), 6).alias("mean_na_rm"),
                                       F.round(agg.strict_mean("v"), 6).alias("mean_strict"))


@register("agg_conditional", section=S, sql="""
SELECT l_linestatus, round(avg(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END), 6) AS share_disc,
       count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned FROM lineitem GROUP BY 1""")
def agg_conditional(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_linestatus").agg(
        F.round(F.avg((F.col("l_discount") > 0.05).cast("int")), 6).alias("share_disc"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))


@register("agg_filtered_subset_mean", section=S, sql="""
SELECT round(avg(CASE WHEN toxic = 0 THEN quality END), 6) AS q_clean, round(avg(CASE WHEN toxic = 1 THEN quality END), 6) AS q_toxic,
       round(avg(CASE WHEN toxic = 1 THEN quality END) / avg(CASE WHEN toxic = 0 THEN quality END), 6) AS ratio FROM labels""")
def agg_filtered_subset_mean(spark, sf):
    lb = load(spark, sf, "labels")
    clean = F.avg(F.when(F.col("toxic") == 0, F.col("quality")))
    tox = F.avg(F.when(F.col("toxic") == 1, F.col("quality")))
    return lb.agg(F.round(clean, 6).alias("q_clean"), F.round(tox, 6).alias("q_toxic"), F.round(tox / clean, 6).alias("ratio"))


@register("agg_count_distinct", section=S, sql="""
SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1""")
def agg_count_distinct(spark, sf):
    return load(spark, sf, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))


@register("agg_range", section=S, sql="""
SELECT o_orderstatus, min(o_totalprice) AS lo, max(o_totalprice) AS hi, min(o_orderdate) AS first_day,
       max(o_orderdate) AS last_day FROM orders GROUP BY 1""")
def agg_range(spark, sf):
    return load(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"),
        F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"))


@register("agg_any_all", section=S, sql="""
WITH e AS (SELECT user_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM events)
SELECT user_id,
       CASE WHEN bool_or(v > 300) THEN true WHEN count(*) FILTER (WHERE v IS NULL) > 0 THEN NULL ELSE false END AS any_big,
       CASE WHEN NOT bool_and(coalesce(v > 1, true)) THEN false WHEN count(*) FILTER (WHERE v IS NULL) > 0 THEN NULL ELSE true END AS all_pos
FROM e GROUP BY 1""")
def agg_any_all(spark, sf):
    e = load(spark, sf, "events").select("user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return e.groupBy("user_id").agg(agg.r_any(F.col("v") > 300).alias("any_big"),
                                    agg.r_all(F.col("v") > 1).alias("all_pos"))


@register("agg_argmax", section=S, sql="""
WITH m AS (SELECT o_custkey, max(o_totalprice) AS mx FROM orders GROUP BY 1)
SELECT o_custkey, min(o_orderkey) AS best_order FROM orders JOIN m USING (o_custkey) WHERE o_totalprice = mx GROUP BY 1""")
def agg_argmax(spark, sf):
    return load(spark, sf, "orders").groupBy("o_custkey").agg(
        agg.argmax("o_totalprice", "o_orderkey").alias("best_order"))


@register("agg_first_in_group", section=S, sql="""
SELECT o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_price FROM orders GROUP BY 1""")
def agg_first_in_group(spark, sf):
    return load(spark, sf, "orders").groupBy("o_custkey").agg(
        agg.first_in_group("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("first_price"))


@register("agg_correlation", section=S, sql="""
SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY 1""")
def agg_correlation(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"))


@register("agg_correlation_matrix", section=S, sql="""
SELECT * FROM (VALUES
 ('l_quantity', 'l_extendedprice', (SELECT round(corr(l_quantity, l_extendedprice), 6) FROM lineitem)),
 ('l_quantity', 'l_discount', (SELECT round(corr(l_quantity, l_discount), 6) FROM lineitem)),
 ('l_quantity', 'l_tax', (SELECT round(corr(l_quantity, l_tax), 6) FROM lineitem)),
 ('l_extendedprice', 'l_discount', (SELECT round(corr(l_extendedprice, l_discount), 6) FROM lineitem)),
 ('l_extendedprice', 'l_tax', (SELECT round(corr(l_extendedprice, l_tax), 6) FROM lineitem)),
 ('l_discount', 'l_tax', (SELECT round(corr(l_discount, l_tax), 6) FROM lineitem))) t(x, y, r)""")
def agg_correlation_matrix(spark, sf):
    c = agg.correlation_pairs(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return c.select("x", "y", F.round("r", 6).alias("r"))


@register("agg_multi_stat_per_column", section=S, sql="""
SELECT l_linestatus, round(avg(l_quantity), 6) AS l_quantity_mean, round(stddev_samp(l_quantity), 6) AS l_quantity_sd,
       round(avg(l_discount), 6) AS l_discount_mean, round(stddev_samp(l_discount), 6) AS l_discount_sd FROM lineitem GROUP BY 1""")
def agg_multi_stat_per_column(spark, sf):
    return agg.multi_stat(load(spark, sf, "lineitem"), ["l_linestatus"], ["l_quantity", "l_discount"],
                          {"mean": lambda c: F.round(F.avg(c), 6), "sd": lambda c: F.round(F.stddev_samp(c), 6)})


@register("agg_having", section=S, sql="""
SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 15""")
def agg_having(spark, sf):
    return agg.count_group(load(spark, sf, "orders"), "o_custkey").where(F.col("n") >= 15)


@register("agg_standard_error", section=S, sql="""
SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity) / sqrt(count(l_quantity)), 6) AS se,
       round(avg(l_quantity) - 2 * stddev_samp(l_quantity) / sqrt(count(l_quantity)), 6) AS lo,
       round(avg(l_quantity) + 2 * stddev_samp(l_quantity) / sqrt(count(l_quantity)), 6) AS hi FROM lineitem GROUP BY 1""")
def agg_standard_error(spark, sf):
    se = agg.standard_error("l_quantity")
    m = F.avg("l_quantity")
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(m, 6).alias("mean"), F.round(se, 6).alias("se"), F.round(m - 2 * se, 6).alias("lo"),
        F.round(m + 2 * se, 6).alias("hi"))


@register("agg_weighted_mean", section=S, sql="""
SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS wmean FROM lineitem GROUP BY 1""")
def agg_weighted_mean(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(agg.weighted_mean("l_discount", "l_quantity"), 6).alias("wmean"))


@register("agg_linear_score", section=S, sql="""
SELECT p_partkey, 0.5 * p_size + 0.01 * p_retailprice AS score FROM part ORDER BY score DESC, p_partkey LIMIT 5""")
def agg_linear_score(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", (0.5 * F.col("p_size") + 0.01 * F.col("p_retailprice")).alias("score"))
    return p.orderBy(F.col("score").desc(), "p_partkey").limit(5)


@register("agg_grouping_sets", section=S, sql="""
SELECT o_orderstatus, o_orderpriority, yr, count(*) AS n, round(sum(o_totalprice), 2) AS revenue,
       grouping_id(o_orderpriority, o_orderstatus, yr) AS gid
FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders)
GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), (o_orderstatus, yr), (yr), ())""")
def agg_grouping_sets(spark, sf):
    o = load(spark, sf, "orders").withColumn("yr", F.year("o_orderdate"))
    return agg.grouping_sets(o, [["o_orderstatus"], ["o_orderpriority"], ["o_orderstatus", "yr"], ["yr"], []],
                             [F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("revenue")])


@register("agg_grouping_sets_time", section=S, sql="""
SELECT event_type, mon, dy, hr, wd, count(*) AS n, grouping_id(dy, event_type, hr, mon, wd) AS gid
FROM (SELECT event_type, CAST(month(ts) AS INTEGER) AS mon, CAST(day(ts) AS INTEGER) AS dy, CAST(hour(ts) AS INTEGER) AS hr,
             strftime(ts, '%a') AS wd FROM events)
GROUP BY GROUPING SETS ((hr), (mon, hr), (dy), (mon, dy), (mon), (mon, wd), (dy, hr), (event_type, mon), (event_type, wd))""")
def agg_grouping_sets_time(spark, sf):
    """The nine time-part group-bys of one fact table in a single pass."""
    t = F.col("ts")
    e = load(spark, sf, "events").select("event_type", F.month(t).alias("mon"), F.dayofmonth(t).alias("dy"),
                                         F.hour(t).alias("hr"), F.date_format(t, "EEE").alias("wd"))
    return agg.grouping_sets(e, [["hr"], ["mon", "hr"], ["dy"], ["mon", "dy"], ["mon"], ["mon", "wd"], ["dy", "hr"],
                                 ["event_type", "mon"], ["event_type", "wd"]], [F.count(F.lit(1)).alias("n")])


@register("hist_bins", section=S, sql="""
SELECT floor(l_extendedprice / 10000) * 10000 AS bin, count(*) AS n FROM lineitem GROUP BY 1""")
def hist_bins(spark, sf):
    return agg.hist_bins(load(spark, sf, "lineitem"), "l_extendedprice", 10000.0) \
        .select(F.col("bin").cast("double").alias("bin"), "n")


@register("box_stats", section=S, sql="""
WITH q AS (SELECT l_returnflag, min(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS median,
                  quantile_cont(l_quantity, 0.75) AS q3, max(l_quantity) AS max FROM lineitem GROUP BY 1),
     f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)
SELECT f.l_returnflag, min, q1, median, q3, max, iqr,
       count(*) FILTER (WHERE l_quantity < lo_fence OR l_quantity > hi_fence) AS n_outliers,
       min(l_quantity) FILTER (WHERE l_quantity >= lo_fence) AS whisker_lo, max(l_quantity) FILTER (WHERE l_quantity <= hi_fence) AS whisker_hi
FROM lineitem JOIN f USING (l_returnflag) GROUP BY ALL""")
def box_stats(spark, sf):
    return agg.box_stats(load(spark, sf, "lineitem"), "l_quantity", ["l_returnflag"])


@register("bin2d", section=S, sql="""
SELECT floor(l_quantity / 10) * 10 AS x_bin, floor(l_discount / 0.02) * 0.02 AS y_bin, count(*) AS n,
       CASE WHEN count(*) >= 15 THEN round(avg(l_extendedprice), 4) END AS mean_value FROM lineitem GROUP BY 1, 2""")
def bin2d(spark, sf):
    b = agg.bin2d(load(spark, sf, "lineitem"), "l_quantity", "l_discount", 10.0, 0.02, "l_extendedprice")
    return b.select(F.col("x_bin").cast("double").alias("x_bin"), F.col("y_bin").cast("double").alias("y_bin"), "n",
                    F.round("mean_value", 4).alias("mean_value"))


@register("density_curve", section=S, sql="""
WITH g AS (SELECT i AS gi, 5.0 * i AS x FROM range(0, 101) t(i)),
     e AS (SELECT value FROM events WHERE value IS NOT NULL),
     n AS (SELECT count(*) AS n FROM e),
     c AS (SELECT gi, sum(exp(-0.5 * power((5.0 * gi - value) / 10.0, 2)) / (10.0 * sqrt(2 * pi()))) AS s
           FROM e, g GROUP BY gi)
SELECT CAST(5.0 * gi AS DOUBLE) AS x, round(s / n, 10) AS density FROM c, n""")
def density_curve(spark, sf):
    d = agg.density_curve(load(spark, sf, "events"), "value", [5.0 * i for i in range(101)], 10.0)
    return d.select(F.col("x").cast("double").alias("x"), F.round("density", 10).alias("density"))


@register("entropy_string", section=S, sql="""
WITH ch AS (SELECT doc_id, unnest(string_split(text, '')) AS c FROM documents),
     cnt AS (SELECT doc_id, c, count(*) AS k FROM ch WHERE c <> '' GROUP BY 1, 2),
     p AS (SELECT doc_id, k / sum(k) OVER (PARTITION BY doc_id) AS p FROM cnt)
SELECT doc_id, round(sum(-p * log2(p)), 8) AS entropy FROM p GROUP BY 1""")
def entropy_string(spark, sf):
    e = agg.entropy_by(load(spark, sf, "documents"), "doc_id", "text")
    return e.select("doc_id", F.round("entropy", 8).alias("entropy"))


@register("matrix_margins", section=S, sql="""
SELECT 'row' AS margin, l_suppkey AS idx, count(l_quantity) AS n, sum(l_quantity) AS sum, round(avg(l_quantity), 6) AS mean
FROM lineitem GROUP BY l_suppkey
UNION ALL
SELECT 'col', l_partkey, count(l_quantity), sum(l_quantity), round(avg(l_quantity), 6) FROM lineitem GROUP BY l_partkey""")
def matrix_margins(spark, sf):
    li = load(spark, sf, "lineitem")
    rows, cols = agg.matrix_margins(li, "l_suppkey", "l_partkey", "l_quantity")
    r = rows.select(F.lit("row").alias("margin"), F.col("l_suppkey").alias("idx"), "n", "sum",
                    F.round("mean", 6).alias("mean"))
    c = cols.select(F.lit("col").alias("margin"), F.col("l_partkey").alias("idx"), "n", "sum",
                    F.round("mean", 6).alias("mean"))
    return r.unionByName(c)


@register("top_variance_columns", section=S, sql="""
WITH x AS (SELECT CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT pos, round(avg(v), 8) AS mean, round(stddev_samp(v), 8) AS sd FROM x GROUP BY pos ORDER BY sd DESC, pos LIMIT 10""")
def top_variance_columns(spark, sf):
    e = load(spark, sf, "embeddings").select(F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    t = agg.top_variance_positions(e, "embedding", 10)
    return t.select("pos", F.round("mean", 8).alias("mean"), F.round("sd", 8).alias("sd"))


@register("qq_points", section=S, sql=f"""
WITH x AS (SELECT event_id, value, row_number() OVER (ORDER BY value, event_id) AS i, count(*) OVER () AS n FROM events WHERE value IS NOT NULL)
SELECT event_id, value AS sample, round({norm_ppf_sql("(i - 0.5) / (n + 1 - 2 * 0.5)")}, 6) AS theoretical FROM x""")
def qq_points(spark, sf):
    q = agg.qq_points(load(spark, sf, "events"), "value", "event_id")
    return q.select("event_id", "sample", F.round("theoretical", 6).alias("theoretical"))
