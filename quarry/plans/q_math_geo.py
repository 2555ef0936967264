"""Bindings for SURVEY 2.11 (math, arrays, maps, structs, matrices) and 2.12 (geospatial)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.columns import floor_div, r_mod, r_round
from quarry.functions.geo import haversine
from quarry.operators import geo
from quarry.plans.registry import register
from quarry.session import load

S = "2.11"
LOADINGS = [round(1.0 / (j + 1), 6) for j in range(64)]  # projection vector (a parameter, 64 values)


@register("math_scalar", section=S, sql="""
SELECT l_orderkey, l_linenumber, round(ln(l_quantity), 10) AS ln_q, round(log2(l_quantity), 10) AS log2_q, round(log10(l_extendedprice), 10) AS log10_p,
       round(exp(l_discount), 10) AS exp_d, round(sqrt(l_quantity), 10) AS sqrt_q, abs(l_discount - 0.05) AS abs_d,
       CAST(ceil(l_extendedprice / 1000) AS BIGINT) AS ceil_k, round(power(l_quantity, 2), 6) AS sq,
       CAST(floor(l_quantity / 7) AS BIGINT) AS int_div, CAST(l_linenumber - 7 * floor((l_linenumber - 3) / 7.0) - 3 AS BIGINT) AS r_mod,
       round(sin(l_quantity), 10) AS sin_q, round(cos(l_quantity), 10) AS cos_q, round_even(l_quantity / 4, 0) AS half_even
FROM lineitem""")
def math_scalar(spark, sf):
    q, p, d = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount")
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.round(F.ln(q), 10).alias("ln_q"), F.round(F.log2(q), 10).alias("log2_q"),
                     F.round(F.log10(p), 10).alias("log10_p"), F.round(F.exp(d), 10).alias("exp_d"),
                     F.round(F.sqrt(q), 10).alias("sqrt_q"), F.abs(d - 0.05).alias("abs_d"),
                     F.ceil(p / 1000).alias("ceil_k"), F.round(F.pow(q, 2), 6).alias("sq"),
                     floor_div(q, F.lit(7)).alias("int_div"), r_mod(F.col("l_linenumber") - 3, F.lit(7)).cast("long").alias("r_mod"),
                     F.round(F.sin(q), 10).alias("sin_q"), F.round(F.cos(q), 10).alias("cos_q"),
                     r_round(q / 4, 0).alias("half_even"))


@register("sequence_generate", section=S, sql="""
SELECT l_orderkey, l_linenumber, CAST(unnest(generate_series(1, l_linenumber * 2, 2)) AS INTEGER) AS odd FROM lineitem""")
def sequence_generate(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return li.select("l_orderkey", "l_linenumber", F.explode(F.sequence(F.lit(1), F.col("l_linenumber") * 2, F.lit(2))).alias("odd"))


@register("map_from_named_vector", section=S, sql="""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 0.5 WHEN 'P' THEN 0.75 END * o_totalprice AS weighted FROM orders""")
def map_from_named_vector(spark, sf):
    weights = F.map_from_arrays(F.array(*[F.lit(k) for k in "FOP"]), F.array(*[F.lit(v) for v in (1.0, 0.5, 0.75)]))
    return load(spark, sf, "orders").select("o_orderkey", (F.element_at(weights, F.col("o_orderstatus")) * F.col("o_totalprice")).alias("weighted"))


@register("struct_from_list", section=S, sql="""
SELECT o_orderkey, o_orderstatus AS status, o_totalprice * 2 AS price, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def struct_from_list(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.struct(
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority")).alias("rec"), "o_orderdate")
    o = o.withColumn("rec", F.col("rec").withField("price", F.col("rec.price") * 2)
                     .withField("year", F.year("o_orderdate")).dropFields("priority"))
    return o.select("o_orderkey", "rec.status", "rec.price", "rec.year")


@register("array_append_slice", section=S, sql="""
SELECT vec_id, CAST(len(list_append(CAST(embedding AS DOUBLE[]), CAST(label AS DOUBLE))) AS INTEGER) AS n_after_append,
       round(list_sum(CAST(embedding AS DOUBLE[])[2:4]), 8) AS slice_sum, CAST(embedding[3] AS DOUBLE) AS third,
       CAST(len(embedding[2:]) AS INTEGER) AS n_without_first FROM embeddings""")
def array_append_slice(spark, sf):
    e = load(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"), "label")
    sl = F.slice("v", 2, 3)
    return e.select("vec_id", F.size(F.concat("v", F.array(F.col("label").cast("double")))).alias("n_after_append"),
                    F.round(F.aggregate(sl, F.lit(0.0), lambda acc, x: acc + x), 8).alias("slice_sum"),
                    F.element_at("v", 3).alias("third"), F.size(F.slice("v", 2, 1 << 20)).alias("n_without_first"))


@register("matrix_cell_ops", section=S, sql="""
WITH cells AS (SELECT vec_id AS i, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT i, count(*) FILTER (WHERE v + 0.1 > 0.2) AS n_big, round(sum(v + 0.1), 6) AS row_sum, round(max(v) FILTER (WHERE j = 5), 8) AS col5 FROM cells GROUP BY i""")
def matrix_cell_ops(spark, sf):
    cells = load(spark, sf, "embeddings").select(F.col("vec_id").alias("i"), F.posexplode("embedding").alias("j", "v")) \
        .withColumn("v", F.col("v").cast("double"))
    shifted = cells.withColumn("v1", F.col("v") + 0.1)
    return shifted.groupBy("i").agg(F.count_if(F.col("v1") > 0.2).alias("n_big"), F.round(F.sum("v1"), 6).alias("row_sum"),
                                    F.round(F.max(F.when(F.col("j") == 5, F.col("v"))), 8).alias("col5"))


@register("matrix_multiply", section=S, sql=f"""
SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), {LOADINGS}::DOUBLE[]), 8) AS score FROM embeddings""")
def matrix_multiply(spark, sf):
    load_vec = F.array(*[F.lit(x) for x in LOADINGS])  # the small factor travels with the plan
    e = load(spark, sf, "embeddings")
    prod = F.aggregate(F.zip_with(F.transform("embedding", lambda x: x.cast("double")), load_vec, lambda a, b: a * b),
                       F.lit(0.0), lambda acc, x: acc + x)
    return e.select("vec_id", F.round(prod, 8).alias("score"))


EV_GEO_SQL = ("SELECT event_id, user_id, ts, value / 10 - 20 AS lat, CAST(json_extract_string(props, '$.k') AS DOUBLE) * 3 - 150 AS lon FROM events")


def _ev_geo(spark, sf):
    return load(spark, sf, "events").select("event_id", "user_id", "ts", (F.col("value") / 10 - 20).alias("lat"),
                                            (F.get_json_object("props", "$.k").cast("double") * 3 - 150).alias("lon"))


HAV_SQL = ("2 * 6378137.0 * asin(least(1.0, sqrt(power(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
           "cos(radians({lat1})) * cos(radians({lat2})) * power(sin((radians({lon2}) - radians({lon1})) / 2), 2))))")


@register("haversine", section=S, sql=f"""
WITH g AS ({EV_GEO_SQL}), s AS (SELECT event_id, lat, lon, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM g
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, round({HAV_SQL.format(lat1='plat', lon1='plon', lat2='lat', lon2='lon')}, 3) AS step_m FROM s""")
def haversine_q(spark, sf):
    s = geo.step_distance(_ev_geo(spark, sf), ["user_id"], ["ts", "event_id"], "lat", "lon")
    return s.select("event_id", F.round("step_m", 3).alias("step_m"))


@register("geo_bounding_box", section="2.12", sql=f"""
SELECT event_id, lat, lon FROM ({EV_GEO_SQL}) WHERE lat BETWEEN -5 AND 10 AND lon BETWEEN -100 AND 0""")
def geo_bounding_box(spark, sf):
    return geo.bounding_box(_ev_geo(spark, sf), "lat", "lon", -5, 10, -100, 0).select("event_id", "lat", "lon")


@register("geo_track_distance", section="2.12", sql=f"""
WITH g AS ({EV_GEO_SQL}), s AS (SELECT event_id, user_id, ts, lat, lon, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM g
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, round(sum(coalesce({HAV_SQL.format(lat1='plat', lon1='plon', lat2='lat', lon2='lon')}, 0.0))
       OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 0) AS cum_m FROM s""")
def geo_track_distance(spark, sf):
    t = geo.track_distance(_ev_geo(spark, sf), ["user_id"], ["ts", "event_id"], "lat", "lon")
    return t.select("event_id", F.round("cum_m", 0).alias("cum_m"))


SUPP_SQL = ("SELECT s_suppkey, CAST((s_suppkey * 37) % 140 AS DOUBLE) - 70 + (s_suppkey % 10) / 10.0 AS s_lat, "
            "CAST((s_suppkey * 71) % 360 AS DOUBLE) - 180 + (s_suppkey % 7) / 10.0 AS s_lon FROM supplier")
CUST_SQL = ("SELECT c_custkey, CAST((c_custkey * 13) % 140 AS DOUBLE) - 70 + (c_custkey % 7) / 10.0 AS c_lat, "
            "CAST((c_custkey * 29) % 360 AS DOUBLE) - 180 + (c_custkey % 3) / 10.0 AS c_lon FROM customer")


def _sites(spark, sf):
    k = F.col("s_suppkey")
    return load(spark, sf, "supplier").select(
        "s_suppkey", (F.pmod(k * 37, F.lit(140)).cast("double") - 70 + F.pmod(k, F.lit(10)) / 10.0).alias("s_lat"),
        (F.pmod(k * 71, F.lit(360)).cast("double") - 180 + F.pmod(k, F.lit(7)) / 10.0).alias("s_lon"))


def _custs(spark, sf):
    k = F.col("c_custkey")
    return load(spark, sf, "customer").select(
        "c_custkey", (F.pmod(k * 13, F.lit(140)).cast("double") - 70 + F.pmod(k, F.lit(7)) / 10.0).alias("c_lat"),
        (F.pmod(k * 29, F.lit(360)).cast("double") - 180 + F.pmod(k, F.lit(3)) / 10.0).alias("c_lon"))


@register("geo_radius_join", section="2.12", sql=f"""
SELECT c_custkey, s_suppkey, round({HAV_SQL.format(lat1='c_lat', lon1='c_lon', lat2='s_lat', lon2='s_lon')}, 3) AS dist_m
FROM ({CUST_SQL}) c, ({SUPP_SQL}) s WHERE {HAV_SQL.format(lat1='c_lat', lon1='c_lon', lat2='s_lat', lon2='s_lon')} <= 160934.4""")
def geo_radius_join(spark, sf):
    j = geo.radius_join(_custs(spark, sf), "c_lat", "c_lon", _sites(spark, sf), "s_lat", "s_lon", 160934.4)
    return j.select("c_custkey", "s_suppkey", F.round("dist_m", 3).alias("dist_m"))


@register("geo_nearest_site", section="2.12", sql=f"""
WITH d AS (SELECT c_custkey, s_suppkey, {HAV_SQL.format(lat1='c_lat', lon1='c_lon', lat2='s_lat', lon2='s_lon')} AS dist_m
           FROM ({CUST_SQL}) c, ({SUPP_SQL}) s)
SELECT c_custkey, arg_min(s_suppkey, (dist_m, s_suppkey)) AS s_suppkey, round(min(dist_m), 3) AS dist_m FROM d GROUP BY 1""")
def geo_nearest_site(spark, sf):
    n = geo.nearest_site(_custs(spark, sf), "c_custkey", "c_lat", "c_lon", _sites(spark, sf), "s_suppkey", "s_lat", "s_lon")
    return n.select("c_custkey", "s_suppkey", F.round("dist_m", 3).alias("dist_m"))


@register("geo_attribute_join", section="2.12", sql="""
WITH m AS (SELECT lower(replace(n_name, '_', ' ')) AS region_key, count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance
           FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT n_nationkey, n_name, n_customers, balance FROM nation
LEFT JOIN m ON m.region_key = CASE WHEN n_name = 'NATION_0' THEN 'nation 0' ELSE lower(replace(n_name, '_', ' ')) END""")
def geo_attribute_join(spark, sf):
    n = load(spark, sf, "nation")
    m = load(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        F.lower(F.regexp_replace("n_name", "_", " ")).alias("region_key")).agg(
        F.count(F.lit(1)).alias("n_customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    fixed = n.withColumn("region_key", F.when(F.col("n_name") == "NATION_0", F.lit("nation 0"))
                         .otherwise(F.lower(F.regexp_replace("n_name", "_", " "))))
    return fixed.join(m, "region_key", "left").select("n_nationkey", "n_name", "n_customers", "balance")
