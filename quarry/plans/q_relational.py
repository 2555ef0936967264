"""Bindings for SURVEY 2.2 (projection, filters, predicates) and 2.6 (sorts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.columns import mix_uniform, mix_uniform_sql
from quarry.operators import relational as rel
from quarry.plans.registry import register
from quarry.session import load

S = "2.2"
PRIO = ["1-URGENT", "2-HIGH"]


@register("select_columns", section=S, sql="SELECT c_custkey, c_name FROM customer")
def select_columns(spark, sf):
    return rel.select_columns(load(spark, sf, "customer"), "c_custkey", "c_name")


@register("select_drop", section=S, sql="SELECT c_custkey, c_name, c_nationkey FROM customer")
def select_drop(spark, sf):
    return rel.select_drop(load(spark, sf, "customer"), "c_acctbal", "c_mktsegment")


@register("select_range_position", section=S, sql="""
SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate FROM lineitem""")
def select_range_position(spark, sf):
    return rel.select_range(load(spark, sf, "lineitem"), "l_partkey", "l_quantity", extra=[11])


@register("select_by_type", section=S, sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")
def select_by_type(spark, sf):
    return rel.select_by_type(load(spark, sf, "lineitem"))


@register("rename", section=S, sql="""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def rename(spark, sf):
    return rel.rename(load(spark, sf, "orders"), {"o_orderkey": "order_id", "o_custkey": "customer_id"})


@register("transmute", section=S, sql="""
SELECT o_orderkey AS order_id, round(o_totalprice / 1000, 5) AS price_k, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def transmute(spark, sf):
    return rel.transmute(load(spark, sf, "orders"), {
        "order_id": F.col("o_orderkey"), "price_k": F.round(F.col("o_totalprice") / 1000, 5),
        "year": F.year("o_orderdate")})


@register("derive", section=S, sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem""")
def derive(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    rev = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return rel.derive(li, {"revenue": rev, "charge": rev * (1 + F.col("l_tax"))}) \
        .select("l_orderkey", "l_linenumber", "revenue", "charge")


@register("map_columns", section=S, sql="""
SELECT l_orderkey, l_linenumber, l_quantity / 100 AS l_quantity, l_extendedprice / 100 AS l_extendedprice,
       l_discount / 100 AS l_discount, l_tax / 100 AS l_tax FROM lineitem""")
def map_columns(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                            "l_discount", "l_tax")
    return rel.map_columns(li, lambda c: c / 100, predicate=lambda f: f.dataType.simpleString() == "double")


@register("cast_types", section=S, sql="""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice,
       TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio_num
FROM orders""")
def cast_types(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority",
                                         F.substring("o_orderpriority", 1, 1).alias("prio_num"))
    return rel.cast_types(o, {"o_orderkey": "string", "o_totalprice": "bigint", "o_orderpriority": "int",
                              "prio_num": "int"})


@register("filter_conjunction", section=S, sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity > 30 AND l_discount < 0.05 AND (l_returnflag = 'R' OR l_linestatus = 'O')""")
def filter_conjunction(spark, sf):
    li = load(spark, sf, "lineitem")
    return rel.filter_all(li, F.col("l_quantity") > 30, F.col("l_discount") < 0.05,
                          (F.col("l_returnflag") == "R") | (F.col("l_linestatus") == "O")) \
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@register("filter_in_list", section=S, sql="""
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def filter_in_list(spark, sf):
    return rel.filter_in(load(spark, sf, "orders"), "o_orderpriority", PRIO).select("o_orderkey", "o_orderpriority")


@register("filter_not_in_list", section=S, sql="""
SELECT o_orderkey, prio FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS prio FROM orders)
WHERE NOT coalesce(prio IN ('1-URGENT', '2-HIGH'), false)""")
def filter_not_in_list(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"))
    return rel.filter_in(o, "prio", PRIO, negate=True)


@register("filter_between", section=S, sql="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20""")
def filter_between(spark, sf):
    return rel.filter_between(load(spark, sf, "lineitem"), "l_quantity", 10, 20) \
        .select("l_orderkey", "l_linenumber", "l_quantity")


@register("filter_regex", section=S, sql="""
SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[A-Za-z0-9._]+@[A-Za-z0-9]+\\.[a-z]{2,}')
AND NOT regexp_matches(text, 'SPDX')""")
def filter_regex(spark, sf):
    d = load(spark, sf, "documents")
    d = rel.filter_regex(d, "text", r"[A-Za-z0-9._]+@[A-Za-z0-9]+\.[a-z]{2,}")
    return rel.filter_regex(d, "text", "SPDX", negate=True).select("doc_id", "lang")


@register("filter_date_range", section=S, sql="""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-12-31'""")
def filter_date_range(spark, sf):
    return rel.filter_date_range(load(spark, sf, "orders"), "o_orderdate", "1996-01-01", "1996-12-31") \
        .select("o_orderkey", "o_orderdate")


@register("filter_quantile_threshold", section=S, sql="""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT quantile_cont(o_totalprice, 0.98) FROM orders)""")
def filter_quantile_threshold(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rel.filter_quantile_threshold(o, "o_totalprice", 0.98)


@register("filter_mask_index", section=S, sql="""
SELECT pos, o_orderkey FROM (SELECT row_number() OVER (ORDER BY o_orderkey) AS pos, o_orderkey, o_totalprice FROM orders)
WHERE o_totalprice > 400000 AND pos > 1""")
def filter_mask_index(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    ix = rel.with_row_index(o, ["o_orderkey"], "pos")
    return ix.where((F.col("o_totalprice") > 400000) & (F.col("pos") > 1)).select("pos", "o_orderkey")


NULLED = "SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, CASE WHEN value < 5 THEN NULL ELSE value END AS value FROM events"


def _nulled(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", "user_id", F.nullif("event_type", F.lit("error")).alias("event_type"),
                     F.when(F.col("value") >= 5, F.col("value")).alias("value"))


@register("drop_missing", section=S, sql=f"SELECT * FROM ({NULLED}) WHERE event_type IS NOT NULL AND value IS NOT NULL")
def drop_missing(spark, sf):
    return rel.drop_missing(_nulled(spark, sf))


@register("sentinel_to_null", section=S, sql="""
SELECT event_id, nullif(event_type, 'error') AS event_type, nullif(user_id, 0) AS user_id FROM events""")
def sentinel_to_null(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "event_type", "user_id")
    return rel.sentinel_to_null(rel.sentinel_to_null(ev, "event_type", "error"), "user_id", 0)


@register("coalesce_missing", section=S, sql=f"""
SELECT event_id, user_id, coalesce(event_type, 'missing') AS event_type, coalesce(value, -1.0) AS value FROM ({NULLED})""")
def coalesce_missing(spark, sf):
    d = rel.coalesce_missing(_nulled(spark, sf), "event_type", "missing")
    return rel.coalesce_missing(d, "value", -1.0)


@register("impute_median", section=S, sql=f"""
SELECT event_id, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM ({NULLED}))) AS value FROM ({NULLED})""")
def impute_median(spark, sf):
    return rel.impute_median(_nulled(spark, sf).select("event_id", "value"), "value")


@register("case_when", section=S, sql="""
SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'mid'
                        WHEN o_orderstatus = 'F' THEN 'low-final' ELSE 'low' END AS band FROM orders""")
def case_when(spark, sf):
    p = F.col("o_totalprice")
    band = rel.case_when([(p >= 300000, "high"), (p >= 100000, "mid"), (F.col("o_orderstatus") == "F", "low-final")],
                         "low")
    return load(spark, sf, "orders").select("o_orderkey", band.alias("band"))


@register("recode_levels", section=S, sql="""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium'
       ELSE o_orderpriority END AS priority,
       CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS priority_level
FROM orders""")
def recode_levels(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    r = rel.recode_levels(o, "o_orderpriority", {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"},
                          out="priority", order=["urgent", "high", "medium"])
    return r.select("o_orderkey", "priority", "priority_level")


@register("reorder_levels", section=S, sql="""
WITH s AS (SELECT p_type, avg(p_retailprice) AS st FROM part GROUP BY p_type),
     r AS (SELECT p_type, CAST(dense_rank() OVER (ORDER BY st, p_type) AS INTEGER) AS level_order FROM s)
SELECT p_partkey, p_type, level_order FROM part JOIN r USING (p_type)""")
def reorder_levels(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice")
    return rel.reorder_levels(p, "p_type", F.avg("p_retailprice")).select("p_partkey", "p_type", "level_order")


@register("distinct_rows", section=S, sql="SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark, sf):
    return rel.distinct_rows(load(spark, sf, "events").select("user_id", "event_type"))


# Sampling is hash-ordered; the bindings use the portable pseudo-uniform so
# DuckDB reproduces every draw (the operators default to xxhash64).
U_ORD = mix_uniform_sql(["o_orderkey"], 42)
U_EV = mix_uniform_sql(["event_id"], 42)
U_DOC = mix_uniform_sql(["doc_id"], 42)
U_BG = mix_uniform_sql(["e.event_id"], 7)


@register("sample_n_per_group", section=S, sql=f"""
SELECT o_orderkey, o_custkey FROM (
  SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY {U_ORD}, o_orderkey) AS r FROM orders) WHERE r <= 1""")
def sample_n_per_group(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return rel.sample_n_per_group(o, ["o_custkey"], 1, ["o_orderkey"], key=mix_uniform(F.col("o_orderkey"), seed=42))


@register("random_split", section=S, sql=f"""
SELECT event_id, CASE WHEN {U_EV} < 0.8 THEN 0 ELSE 1 END AS split FROM events""")
def random_split(spark, sf):
    ev = load(spark, sf, "events").select("event_id")
    return rel.random_split(ev, [0.8, 0.2], ["event_id"], uniform=mix_uniform(F.col("event_id"), seed=42))


@register("stratified_split", section=S, sql=f"""
SELECT doc_id, quality, toxic, row_number() OVER (PARTITION BY quality ORDER BY {U_DOC}, doc_id)
       <= ceil(count(*) OVER (PARTITION BY quality) * 0.8) AS is_train FROM labels""")
def stratified_split(spark, sf):
    return rel.stratified_split(load(spark, sf, "labels"), "quality", 0.8, ["doc_id"],
                                key=mix_uniform(F.col("doc_id"), seed=42))


@register("sample_background", section=S, sql=f"""
WITH p AS (SELECT event_id, user_id FROM events WHERE event_type = 'purchase'),
     need AS (SELECT user_id, count(*) * 2 AS need FROM p GROUP BY 1),
     b AS (SELECT e.event_id, e.user_id, need, row_number() OVER (PARTITION BY e.user_id ORDER BY {U_BG}, e.event_id) AS r
           FROM events e JOIN need USING (user_id) WHERE e.event_type <> 'purchase')
SELECT event_id, user_id, 'presence' AS kind FROM p UNION ALL SELECT event_id, user_id, 'pseudo_absence' FROM b WHERE r <= need""")
def sample_background(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "event_type")
    pres = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id")
    bg = ev.where(F.col("event_type") != "purchase").select("event_id", "user_id")
    return rel.sample_background(pres, bg, "user_id", 2, ["event_id"], key=mix_uniform(F.col("event_id"), seed=7))


# ------------------------------------------------------------------ 2.6 sorts
@register("sort_asc_desc", section="2.6", sql="""
SELECT o_orderkey, prio, o_totalprice FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS prio, o_totalprice FROM orders)
ORDER BY prio DESC NULLS LAST, o_totalprice ASC NULLS LAST, o_orderkey""")
def sort_asc_desc(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"),
                                         "o_totalprice")
    return rel.sort_rows(o, "prio", "o_totalprice", "o_orderkey", descending=[True, False, False])


@register("limit_slice", section="2.6", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def limit_slice(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@register("row_range_slice", section="2.6", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 11 OFFSET 59""")
def row_range_slice(spark, sf):
    return rel.row_range(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 60, 70, "o_orderkey")
