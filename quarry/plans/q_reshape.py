"""Bindings for SURVEY 2.8: reshape and nesting."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import reshape as rs
from quarry.plans.registry import register
from quarry.session import load

S = "2.8"
PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# The part-name vocabulary of the harness generator.
PART_WORDS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring",
              "rod", "small", "widget"]


@register("unpivot", section=S, sql="""
SELECT l_orderkey, l_linenumber, 'l_quantity' AS key, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""")
def unpivot(spark, sf):
    return rs.unpivot(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@register("pivot", section=S, sql="""
SELECT o_orderstatus, """ + ", ".join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in PRIOS) + """
FROM orders GROUP BY o_orderstatus""")
def pivot(spark, sf):
    return rs.pivot(load(spark, sf, "orders"), ["o_orderstatus"], "o_orderpriority", F.count(F.lit(1)), PRIOS)


@register("unite", section=S, sql="""
SELECT l_orderkey, l_linenumber, coalesce(l_returnflag, 'NA') || '_' || coalesce(nullif(l_linestatus, 'O'), 'NA') AS flags FROM lineitem""")
def unite(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                            F.nullif("l_linestatus", F.lit("O")).alias("l_linestatus"))
    return rs.unite(li, "flags", ["l_returnflag", "l_linestatus"])


@register("extract_groups", section=S, sql="""
SELECT c_custkey, nullif(regexp_extract(c_name, '^([A-Za-z]+)#0*([0-9]+)$', 1), '') AS kind,
       nullif(regexp_extract(c_name, '^([A-Za-z]+)#0*([0-9]+)$', 2), '') AS number FROM customer""")
def extract_groups(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    return rs.extract_groups(c, "c_name", ["kind", "number"], r"^([A-Za-z]+)#0*([0-9]+)$").drop("c_name")


@register("explode_delimited", section=S, sql="""
SELECT page_id, CAST(generate_subscripts(regexp_split_to_array(url, '[/?&=]'), 1) - 1 AS INTEGER) AS pos,
       unnest(regexp_split_to_array(url, '[/?&=]')) AS item FROM pages""")
def explode_delimited(spark, sf):
    return rs.explode_delimited(load(spark, sf, "pages"), "url", "[/?&=]", keep=["page_id"])


@register("one_hot_multi", section=S, sql="""
SELECT p_partkey, """ + ", ".join(f"CAST(list_contains(string_split(p_name, ' '), '{w}') AS INTEGER) AS {w}" for w in PART_WORDS) + """
FROM part""")
def one_hot_multi(spark, sf):
    return rs.one_hot_multi(load(spark, sf, "part"), ["p_partkey"], "p_name", " ", PART_WORDS)


@register("nest_rows", section=S, sql="""
SELECT o_custkey, count(*) AS n_orders, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY 1""")
def nest_rows(spark, sf):
    """Nested per customer in chunks of at most 1000 orders (a hot customer
    spreads over several rows); sizes and ends are read back per customer."""
    n = rs.nest_rows(load(spark, sf, "orders"), ["o_custkey"], ["o_orderkey", "o_totalprice"], chunk_size=1000)
    return n.groupBy("o_custkey").agg(F.sum(F.size("data")).alias("n_orders"),
                                      F.min(F.col("data")[0]["o_orderkey"]).alias("first_key"),
                                      F.max(F.element_at("data", -1)["o_orderkey"]).alias("last_key"))


@register("unnest_rows", section=S, sql="SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def unnest_rows(spark, sf):
    n = rs.nest_rows(load(spark, sf, "orders"), ["o_custkey"], ["o_orderkey", "o_totalprice"], chunk_size=1000)
    return rs.unnest_rows(n, "data", ["o_custkey"])


@register("replicate_by_count", section=S, sql="""
WITH f AS (SELECT l_returnflag, l_linestatus, CAST(count(*) AS INTEGER) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, l_linestatus, CAST(unnest(generate_series(1, n)) AS INTEGER) AS i FROM f WHERE n >= 1""")
def replicate_by_count(spark, sf):
    f = load(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).cast("int").alias("n"))
    return rs.replicate_by_count(f, "n").withColumn("i", F.col("i").cast("int"))


@register("reshape_vector_to_wide", section=S, sql="""
WITH m AS (SELECT (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS pos, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(floor(pos / 12) AS BIGINT) AS row, """ + ", ".join(f"max(n) FILTER (WHERE pos % 12 + 1 = {i}) AS \"{i}\"" for i in range(1, 13)) + """
FROM m GROUP BY 1""")
def reshape_vector_to_wide(spark, sf):
    m = load(spark, sf, "orders").groupBy(
        ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1).alias("pos")).agg(F.count(F.lit(1)).alias("n"))
    return rs.vector_to_wide(m, "pos", "n", 12)
