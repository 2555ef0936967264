"""Bindings for SURVEY 2.3 (joins) and 2.7 (set operations and binding)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import joins as jn
from quarry.operators import sets as st
from quarry.plans.registry import register
from quarry.session import load

S = "2.3"


@register("join_inner", section=S, sql="""
SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return jn.join_by(o, load(spark, sf, "customer"), ["c_custkey"]).select("o_orderkey", "c_name", "c_mktsegment")


@register("join_natural", section=S, sql="""
WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT event_id, user_id, event_type, n FROM events NATURAL JOIN n""")
def join_natural(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "event_type")
    n = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return jn.join_natural(ev, n).select("event_id", "user_id", "event_type", "n")


@register("join_left", section=S, sql="""
WITH c AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT c_custkey, c_name, n_orders FROM customer LEFT JOIN c USING (c_custkey)""")
def join_left(spark, sf):
    c = load(spark, sf, "orders").where(F.col("o_orderstatus") == "O").groupBy(F.col("o_custkey").alias("c_custkey")) \
        .agg(F.count(F.lit(1)).alias("n_orders"))
    return jn.join_by(load(spark, sf, "customer").select("c_custkey", "c_name"), c, ["c_custkey"], "left")


@register("join_left_diff_keys", section=S, sql="""
SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def join_left_diff_keys(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return jn.join_by(li, load(spark, sf, "part").select("p_partkey", "p_brand"), {"l_partkey": "p_partkey"}, "left")


@register("join_full", section=S, sql="""
WITH s AS (SELECT s_nationkey AS n_nationkey, count(*) AS n_neg FROM supplier WHERE s_acctbal < 0 GROUP BY 1)
SELECT n_nationkey, n_name, n_neg FROM nation FULL JOIN s USING (n_nationkey)""")
def join_full(spark, sf):
    s = load(spark, sf, "supplier").where(F.col("s_acctbal") < 0) \
        .groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n_neg"))
    return jn.join_by(load(spark, sf, "nation").select("n_nationkey", "n_name"), s, ["n_nationkey"], "full")


@register("join_time_align", section=S, sql="""
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1),
     l AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS shipments FROM lineitem GROUP BY 1)
SELECT day, orders, shipments FROM o FULL JOIN l USING (day)""")
def join_time_align(spark, sf):
    o = load(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    li = load(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return jn.align_series({"orders": o, "shipments": li}, "day")


@register("join_semi", section=S, sql="""
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)""")
def join_semi(spark, sf):
    li = load(spark, sf, "lineitem").where(F.col("l_quantity") > 45).select(F.col("l_orderkey").alias("o_orderkey"))
    return load(spark, sf, "orders").select("o_orderkey", "o_custkey").join(li, "o_orderkey", "left_semi")


@register("join_anti", section=S, sql="""
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def join_anti(spark, sf):
    o = load(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return load(spark, sf, "customer").select("c_custkey", "c_name").join(o, "c_custkey", "left_anti")


@register("join_merge_base", section=S, sql="""
SELECT n_nationkey, s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
ORDER BY n_nationkey""")
def join_merge_base(spark, sf):
    s = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", "s_name")
    return jn.merge_base(s, load(spark, sf, "nation").select("n_nationkey", "n_name"), ["n_nationkey"])


@register("join_interval_point", section=S, sql="""
WITH iv AS (SELECT user_id AS iv_user, CAST(ts AS DATE) AS iv_day, min(ts) AS iv_start, max(ts) AS iv_end
            FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT event_id, iv_user, iv_day FROM events LEFT JOIN iv ON user_id = iv_user AND ts BETWEEN iv_start AND iv_end""")
def join_interval_point(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    iv = ev.where(F.col("event_type") == "purchase").groupBy(
        F.col("user_id").alias("iv_user"), F.to_date("ts").alias("iv_day")) \
        .agg(F.min("ts").alias("iv_start"), F.max("ts").alias("iv_end"))
    j = jn.interval_point_join(ev, "ts", iv, "iv_start", "iv_end", bucket="1 hour", keys={"user_id": "iv_user"})
    return j.select("event_id", "iv_user", "iv_day")


@register("filter_within_any_interval", section=S, sql="""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-09-01' AND TIMESTAMP '1995-09-30'
 OR o_orderdate BETWEEN TIMESTAMP '1997-12-20' AND TIMESTAMP '1998-01-05'
 OR o_orderdate BETWEEN TIMESTAMP '2000-07-01' AND TIMESTAMP '2000-07-04'""")
def filter_within_any_interval(spark, sf):
    return jn.filter_within_any(load(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate",
                                [("1995-09-01", "1995-09-30"), ("1997-12-20", "1998-01-05"),
                                 ("2000-07-01", "2000-07-04")])


@register("join_cross_grid", section=S, sql="""
WITH g AS (SELECT n_nationkey, y FROM nation, (VALUES (1995), (1996), (1997), (1998), (1999), (2000), (2001)) t(y)),
     f AS (SELECT c_nationkey AS n_nationkey, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT n_nationkey, y, coalesce(n, 0) AS n FROM g LEFT JOIN f USING (n_nationkey, y)""")
def join_cross_grid(spark, sf):
    grid = jn.expand_grid(load(spark, sf, "nation").select("n_nationkey"), {"y": list(range(1995, 2002))})
    o = load(spark, sf, "orders").join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    f = o.groupBy(F.col("c_nationkey").alias("n_nationkey"), F.year("o_orderdate").alias("y")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return grid.join(f, ["n_nationkey", "y"], "left").select("n_nationkey", "y", F.coalesce("n", F.lit(0)).alias("n"))


@register("join_baseline_compare", section=S, sql="""
WITH s AS (SELECT event_type, round(avg(value), 6) AS mean_value, count(*) AS n FROM events GROUP BY 1)
SELECT event_type, mean_value, n, mean_value - (SELECT mean_value FROM s WHERE event_type = 'view') AS mean_value_vs_base,
       n - (SELECT n FROM s WHERE event_type = 'view') AS n_vs_base FROM s""")
def join_baseline_compare(spark, sf):
    s = load(spark, sf, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean_value"),
                                                            F.count(F.lit(1)).alias("n"))
    return jn.compare_to_baseline(s, "event_type", "view", ["mean_value", "n"])


@register("join_lookup_loop", section=S, sql="""
SELECT l_orderkey, l_linenumber, p_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 49""")
def join_lookup_loop(spark, sf):
    li = load(spark, sf, "lineitem").where(F.col("l_quantity") >= 49).select("l_orderkey", "l_linenumber", "l_partkey")
    return jn.join_by(li, load(spark, sf, "part").select("p_partkey", "p_name"), {"l_partkey": "p_partkey"}, "left") \
        .select("l_orderkey", "l_linenumber", "p_name")


@register("join_grid_cell", section=S, sql="""
WITH pts AS (SELECT event_id, value AS x, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y, event_type FROM events),
     cells AS (SELECT floor(x / 50) AS cx, floor(y / 50) AS cy, count(*) AS purchases FROM pts WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT event_id, CAST(floor(x / 50) AS BIGINT) AS _cx, CAST(floor(y / 50) AS BIGINT) AS _cy, purchases
FROM pts LEFT JOIN cells ON floor(x / 50) = cx AND floor(y / 50) = cy""")
def join_grid_cell(spark, sf):
    pts = load(spark, sf, "events").select("event_id", F.col("value").alias("x"),
                                           F.get_json_object("props", "$.k").cast("double").alias("y"), "event_type")
    cells = pts.where(F.col("event_type") == "purchase").groupBy(
        F.floor(F.col("x") / 50).alias("cx"), F.floor(F.col("y") / 50).alias("cy")) \
        .agg(F.count(F.lit(1)).alias("purchases"))
    return jn.grid_cell_join(pts, "x", "y", cells, "cx", "cy", 50.0).select("event_id", "_cx", "_cy", "purchases")


# ----------------------------------------------------------------- 2.7 sets
@register("union_all", section="2.7", sql="""
SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def union_all(spark, sf):
    o = load(spark, sf, "orders")
    done = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus", "o_totalprice")
    rest = o.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return st.bind_rows(done, rest)


@register("set_intersect", section="2.7", sql="""
SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def set_intersect(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    o = load(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("k"))
    return st.set_intersect(c, o)


@register("set_difference", section="2.7", sql="""
SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def set_difference(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    o = load(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("k"))
    return st.set_difference(c, o)


@register("table_equality", section="2.7", sql="""
WITH a AS (SELECT o_orderkey, o_totalprice FROM orders),
     b AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN round(o_totalprice) ELSE o_totalprice END AS o_totalprice FROM orders)
SELECT *, 'left_only' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL
SELECT *, 'right_only' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def table_equality(spark, sf):
    o = load(spark, sf, "orders")
    a = o.select("o_orderkey", "o_totalprice")
    b = o.select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.round("o_totalprice"))
                 .otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return st.table_diff(a, b)


@register("bind_columns", section="2.7", sql="""
SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS first_dim FROM embeddings""")
def bind_columns(spark, sf):
    e = load(spark, sf, "embeddings")
    return st.bind_columns(e.select("vec_id", "label"),
                           e.select("vec_id", F.col("embedding")[0].cast("double").alias("first_dim")), "vec_id")
