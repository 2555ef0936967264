"""Bindings for SURVEY 2.5: window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import windows as win
from quarry.plans.registry import register
from quarry.session import load

S = "2.5"
EV_ORDER = ["ts", "event_id"]

DAILY_SQL = "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1"


def daily_orders(spark, sf):
    """Daily order counts (the harness's regular daily series)."""
    return load(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@register("win_row_number", section=S, sql="""
SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS rn FROM events""")
def win_row_number(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts")
    return win.row_number_in_group(ev, ["user_id"], EV_ORDER, skew_safe=True).select("event_id", "user_id", "rn")


@register("win_topn_per_group", section=S, sql="""
SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS INTEGER) AS rank
  FROM lineitem) WHERE rank <= 3""")
def win_topn_per_group(spark, sf):
    li = load(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return win.top_n_per_group(li, ["l_suppkey"], [F.col("l_quantity").desc(), "l_orderkey", "l_linenumber"], 3)


@register("win_rank_avg_ties", section=S, sql="""
SELECT s_suppkey, s_nationkey, rank() OVER (PARTITION BY s_nationkey ORDER BY round(s_acctbal, -3) DESC)
       + (count(*) OVER (PARTITION BY s_nationkey, round(s_acctbal, -3)) - 1) / 2.0 AS rank FROM supplier""")
def win_rank_avg_ties(spark, sf):
    s = load(spark, sf, "supplier").select("s_suppkey", "s_nationkey", F.round("s_acctbal", -3).alias("bal_k"))
    return win.rank_average_ties(s, ["s_nationkey"], "bal_k", skew_safe=True).select("s_suppkey", "s_nationkey", "rank")


@register("top_n_with_ties", section=S, sql="""
SELECT p_partkey, p_retailprice FROM (SELECT *, rank() OVER (ORDER BY p_retailprice DESC) AS r FROM part) WHERE r <= 10
UNION ALL
SELECT p_partkey, p_retailprice FROM (SELECT *, rank() OVER (ORDER BY p_retailprice ASC) AS r FROM part) WHERE r <= 3""")
def top_n_with_ties(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_retailprice")
    return win.top_n_with_ties(p, 10, "p_retailprice").unionByName(win.top_n_with_ties(p, -3, "p_retailprice"))


@register("win_lead_bigram", section=S, sql="""
WITH b AS (SELECT event_type || ' ' || lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pair FROM events)
SELECT pair, count(*) AS n FROM b WHERE pair IS NOT NULL GROUP BY pair""")
def win_lead_bigram(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    b = win.lead_pairs(ev, ["user_id"], EV_ORDER, "event_type", skew_safe=True)
    return b.where(F.col("pair").isNotNull()).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


@register("win_lag_diff", section=S, sql="""
SELECT event_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS diff FROM events""")
def win_lag_diff(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return win.lag_diff(ev, ["user_id"], EV_ORDER, "value", skew_safe=True).select("event_id", "diff")


@register("win_cumsum", section=S, sql="""
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 6) AS cum FROM events""")
def win_cumsum(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return win.cumulative(ev, ["user_id"], EV_ORDER, "value", skew_safe=True).select("event_id", F.round("cum", 6).alias("cum"))


@register("win_cumprod", section=S, sql="""
SELECT event_id, round(exp(sum(ln(1 + value / 1000)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)), 6) AS cumprod
FROM events""")
def win_cumprod(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts", (1 + F.col("value") / 1000).alias("growth"))
    return win.cumprod(ev, ["user_id"], EV_ORDER, "growth", skew_safe=True).select("event_id", F.round("cumprod", 6).alias("cumprod"))


@register("win_cumulative_flag", section=S, sql="""
WITH l AS (SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS line_no,
                  unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, line_no, CAST(sum(CASE WHEN length(line) < 40 THEN 1 ELSE 0 END)
       OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS BIGINT) AS section FROM l""")
def win_cumulative_flag(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    d = d.select("doc_id", (F.col("pos") + 1).alias("line_no"), (F.length("line") < 40).cast("long").alias("hdr"))
    return win.cumulative(d, ["doc_id"], ["line_no"], "hdr", name="section").select("doc_id", "line_no", "section")


@register("win_share_of_group", section=S, sql="""
SELECT user_id, event_type, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS share
FROM events GROUP BY user_id, event_type""")
def win_share_of_group(spark, sf):
    c = load(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return win.share_of_group(c, ["user_id"], "n")


@register("win_share_of_total", section=S, sql="""
SELECT event_type, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM events GROUP BY event_type""")
def win_share_of_total(spark, sf):
    c = load(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return win.share_of_total(c, "n")


@register("win_group_filter", section=S, sql="""
SELECT user_id, event_type, n FROM (
  SELECT user_id, event_type, count(*) AS n, sum(count(*)) OVER (PARTITION BY user_id) AS tot FROM events GROUP BY user_id, event_type)
WHERE tot >= 70""")
def win_group_filter(spark, sf):
    c = load(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return win.group_filter(c, ["user_id"], F.sum("n"), lambda s: s >= 70)


@register("win_zscore", section=S, sql="""
SELECT l_orderkey, l_linenumber,
       round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) + 0.0 AS l_quantity_z,
       round((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)) / (SELECT stddev_samp(l_extendedprice) FROM lineitem), 6) + 0.0 AS l_extendedprice_z
FROM lineitem""")
def win_zscore(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    z = win.zscore(li, ["l_quantity", "l_extendedprice"])
    # + 0.0 turns a rounded -0.0 into 0.0 (same text form in every engine)
    return z.select("l_orderkey", "l_linenumber", (F.round("l_quantity_z", 6) + 0.0).alias("l_quantity_z"),
                    (F.round("l_extendedprice_z", 6) + 0.0).alias("l_extendedprice_z"))


@register("win_minmax", section=S, sql="""
SELECT p_partkey,
  round((p_retailprice - (SELECT min(p_retailprice) FROM part)) / ((SELECT max(p_retailprice) FROM part) - (SELECT min(p_retailprice) FROM part)), 8) AS p_retailprice_mm,
  round((p_size - (SELECT min(p_size) FROM part)) / ((SELECT max(p_size) FROM part) - (SELECT min(p_size) FROM part)), 8) AS p_size_mm
FROM part""")
def win_minmax(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size")
    m = win.minmax_scale(p, ["p_retailprice", "p_size"])
    return m.select("p_partkey", F.round("p_retailprice_mm", 8).alias("p_retailprice_mm"),
                    F.round("p_size_mm", 8).alias("p_size_mm"))


@register("win_center_by_group", section=S, sql="""
SELECT l_orderkey, l_linenumber, l_quantity - avg(l_quantity) OVER (PARTITION BY l_suppkey) AS centered FROM lineitem""")
def win_center_by_group(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    c = win.center_by_group(li, ["l_suppkey"], "l_quantity")
    # integer-valued input: sums are exact in every engine, so no rounding
    return c.select("l_orderkey", "l_linenumber", "centered")


@register("win_offset_from_min", section=S, sql="""
SELECT o_orderkey, CAST(year(o_orderdate) - (SELECT min(year(o_orderdate)) FROM orders) AS INTEGER) AS offset FROM orders""")
def win_offset_from_min(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("yr"))
    return win.offset_from_min(o, "yr").select("o_orderkey", "offset")


@register("win_expanding", section=S, sql=f"""
WITH d AS ({DAILY_SQL})
SELECT day, n, CASE WHEN count(n) OVER w >= 3 THEN round(avg(n) OVER w, 6) END AS expanding_mean
FROM d WINDOW w AS (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def win_expanding(spark, sf):
    e = win.expanding_mean(daily_orders(spark, sf).withColumn("g", F.lit(1)), ["g"], ["day"], "n")
    return e.select("day", "n", F.round("expanding_mean", 6).alias("expanding_mean"))


@register("win_rolling_sum", section=S, sql=f"""
WITH d AS ({DAILY_SQL})
SELECT day, CASE WHEN count(n) OVER w = 10 THEN CAST(sum(n) OVER w AS BIGINT) END AS rolling_sum
FROM d WINDOW w AS (ORDER BY day ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)""")
def win_rolling_sum(spark, sf):
    r = win.rolling_sum(daily_orders(spark, sf).withColumn("g", F.lit(1)), ["g"], ["day"], "n", 10)
    return r.select("day", "rolling_sum")


@register("win_centered_ma", section=S, sql=f"""
WITH d AS ({DAILY_SQL})
SELECT day, CASE WHEN count(n) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13 THEN
  round((sum(n) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) - 0.5 * lag(n, 6) OVER (ORDER BY day)
        - 0.5 * lead(n, 6) OVER (ORDER BY day)) / 12, 6) END AS trend FROM d""")
def win_centered_ma(spark, sf):
    c = win.centered_ma(daily_orders(spark, sf).withColumn("g", F.lit(1)), ["g"], ["day"], "n", 12)
    return c.select("day", F.round("trend", 6).alias("trend"))
