"""Bindings for SURVEY 2.1: scans, sources, sinks, inspection."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import aggregates as agg
from quarry.operators import relational as rel
from quarry.plans.registry import register
from quarry.session import load
from quarry.sources import html as htm, readers as rd

S = "2.1"


@register("scan_csv_infer", section=S, sql="""
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def scan_csv_infer(spark, sf):
    """CSV derived from customer, read back with inferred types (keys infer
    as int while they fit in 32 bits)."""
    path = rd.write_csv(load(spark, sf, "customer"), rd.scratch_path(spark, "csv-infer"))
    return rd.read_csv(spark, path, header=True, infer=True)


@register("scan_typed_projection", section=S, sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders""")
def scan_typed_projection(spark, sf):
    return rd.read_typed(spark, f"{sf}/orders.parquet", "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE")


@register("scan_renamed_skip_header", section=S, sql="""
SELECT p_partkey AS part_id, p_name AS part_name, p_brand AS brand, p_type AS kind,
       p_size AS size, p_retailprice AS price FROM part""")
def scan_renamed_skip_header(spark, sf):
    path = rd.write_csv(load(spark, sf, "part"), rd.scratch_path(spark, "csv-renamed"))
    return rd.read_renamed(spark, path, ["part_id", "part_name", "brand", "kind", "size", "price"],
                           ["BIGINT", "STRING", "STRING", "STRING", "INT", "DOUBLE"])


@register("scan_date_format", section=S, sql="""
SELECT event_id, strftime(ts, '%Y%m%d %H%M%S') AS ts_text,
       strptime(strftime(ts, '%Y%m%d %H%M%S'), '%Y%m%d %H%M%S') AS ts_parsed FROM events""")
def scan_date_format(spark, sf):
    ev = load(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMdd HHmmss").alias("ts_text"))
    return ev.withColumn("ts_parsed", F.to_timestamp_ntz("ts_text", F.lit("yyyyMMdd HHmmss")))


@register("scan_lowercase_headers", section=S, sql="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def scan_lowercase_headers(spark, sf):
    shouting = load(spark, sf, "customer").toDF(*[c.upper() for c in load(spark, sf, "customer").columns])
    return rel.lowercase_columns(shouting)


@register("scan_multiline_quoted", section=S, sql="""
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_len, md5(text) AS text_md5 FROM documents""")
def scan_multiline_quoted(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    path = rd.write_csv(docs, rd.scratch_path(spark, "csv-multiline"))
    back = rd.read_csv(spark, path, schema="doc_id BIGINT, text STRING", multiline=True)
    return back.select("doc_id", F.length("text").alias("n_len"), F.md5("text").alias("text_md5"))


@register("scan_cr_line_ends", section=S, sql="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def scan_cr_line_ends(spark, sf):
    path = rd.write_csv(load(spark, sf, "customer"), rd.scratch_path(spark, "csv-cr"), line_sep="\r")
    return rd.read_csv(spark, path, schema="c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                       "c_mktsegment STRING", line_sep="\r")


@register("scan_delimiter_option", section=S, sql="""
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def scan_delimiter_option(spark, sf):
    path = rd.write_csv(load(spark, sf, "supplier"), rd.scratch_path(spark, "csv-semicolon"), header=False, sep=";")
    return rd.read_csv(spark, path, header=False, sep=";",
                       schema="s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE")


@register("scan_json_many_files", section=S, sql="""
SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def scan_json_many_files(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "event_type",
                                          F.from_json("props", "k BIGINT").alias("p"))
    root = rd.scratch_path(spark, "json-many")
    ev.select("event_id", "user_id", "event_type", "p.k").write.partitionBy("event_type").json(root)
    paths = rd.list_folders(spark, root)  # one folder per type that occurs, read in one scan
    return rd.read_json_many(spark, paths, schema="event_id BIGINT, user_id BIGINT, k BIGINT, event_type STRING",
                             base_path=root).select("event_id", "user_id", "event_type", "k")


@register("scan_html_tables", section=S, sql="""
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)[i] AS value
FROM pages, LATERAL (SELECT unnest(generate_series(1, len(regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)))) AS i)""")
def scan_html_tables(spark, sf):
    return rd.extract_elements(load(spark, sf, "pages"), "html", "a", attr="href", keep=["page_id"])


def order_pages(li):
    """(l_orderkey, html): a page per order with its lines as a table, as people
    write HTML: end tags left out, single quotes, spans, a nested table, a comment."""
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_quantity").cast("int").alias("qty"), "l_returnflag", "l_linestatus")))
    pages = li.groupBy("l_orderkey").agg(lines.alias("lines")).withColumn("n", F.size("lines").cast("string"))
    key = F.concat(F.lit("<td rowspan="), "n", F.lit(">"), F.col("l_orderkey").cast("string"))
    row = lambda x, i: F.concat(
        F.lit("<TR class='a>b'>"), F.when(i == 0, key).otherwise(""), F.lit("<td>"), x["l_linenumber"].cast("string"), F.lit("</td>\n<td >"),
        x["qty"].cast("string"), F.lit("<td><b title='x\"<td>'>"), x["l_returnflag"], F.lit("</b>&nbsp;&amp;\n "), x["l_linestatus"])
    return pages.select("l_orderkey", F.concat(
        F.lit("<!DOCTYPE html><p>x < y<!-- <table><tr><td>no</table> --><table id=t><caption>lines</caption><tr><th>order<th colspan='2'>line<th>flag</tr>"),
        F.array_join(F.transform("lines", row), ""),
        F.lit("<tr><td colspan=\"4\">in<table><td>"), F.col("n"), F.lit("</td></table>ner</table></table><p>after")).alias("html"))


@register("html_table_cells", section=S, sql="""
WITH l AS (SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty, l_returnflag || ' & ' || l_linestatus AS flag,
                  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_quantity AS INTEGER), l_returnflag, l_linestatus) AS INTEGER) AS r,
                  CAST(count(*) OVER (PARTITION BY l_orderkey) AS INTEGER) AS n FROM lineitem),
o AS (SELECT DISTINCT l_orderkey, n FROM l)
SELECT l_orderkey, 0 AS table_no, 0 AS row_no, c AS col_no, v AS value, true AS is_header, s AS colspan, 1 AS rowspan
FROM o, (VALUES (0, 'order', 1), (1, 'line', 2), (3, 'flag', 1)) h(c, v, s)
UNION ALL SELECT l_orderkey, 0, 1, 0, CAST(l_orderkey AS VARCHAR), false, 1, n FROM o
UNION ALL SELECT l_orderkey, 0, r, 1, CAST(l_linenumber AS VARCHAR), false, 1, 1 FROM l
UNION ALL SELECT l_orderkey, 0, r, 2, qty, false, 1, 1 FROM l
UNION ALL SELECT l_orderkey, 0, r, 3, flag, false, 1, 1 FROM l
UNION ALL SELECT l_orderkey, 0, n + 1, 0, 'inner', false, 4, 1 FROM o
UNION ALL SELECT l_orderkey, 1, 0, 0, CAST(n AS VARCHAR), false, 1, 1 FROM o""")
def html_table_cells(spark, sf):
    return htm.html_tables(order_pages(load(spark, sf, "lineitem")), "html", keep=["l_orderkey"])


@register("inline_table", section=S, sql="""
WITH lk(o_orderpriority, urgency) AS (VALUES ('1-URGENT', 'rush'), ('2-HIGH', 'rush'), ('3-MEDIUM', 'normal'),
                                             ('4-NOT SPECIFIED', 'normal'), ('5-LOW', 'slow'))
SELECT urgency, count(*) AS n FROM orders JOIN lk USING (o_orderpriority) GROUP BY urgency""")
def inline_table(spark, sf):
    lk = rd.inline_table(spark, [("1-URGENT", "rush"), ("2-HIGH", "rush"), ("3-MEDIUM", "normal"),
                                 ("4-NOT SPECIFIED", "normal"), ("5-LOW", "slow")],
                         "o_orderpriority STRING, urgency STRING")
    o = load(spark, sf, "orders")
    return o.join(F.broadcast(lk), "o_orderpriority").groupBy("urgency").agg(F.count(F.lit(1)).alias("n"))


@register("register_table", section=S, sql="""
SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS avg_bal FROM customer GROUP BY c_mktsegment""")
def register_table(spark, sf):
    load(spark, sf, "customer").createOrReplaceTempView("q_customer")
    return spark.sql("SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS avg_bal "
                     "FROM q_customer GROUP BY c_mktsegment")


@register("summarize_table", section=S, sql="""
SELECT * FROM (
 SELECT 'l_quantity' AS "column", min(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS q1,
        quantile_cont(l_quantity, 0.5) AS median, round(avg(l_quantity), 6) AS mean,
        quantile_cont(l_quantity, 0.75) AS q3, max(l_quantity) AS max, count(*) - count(l_quantity) AS nulls FROM lineitem
 UNION ALL
 SELECT 'l_extendedprice', min(l_extendedprice), round(quantile_cont(l_extendedprice, 0.25), 4),
        round(quantile_cont(l_extendedprice, 0.5), 4), round(avg(l_extendedprice), 4),
        round(quantile_cont(l_extendedprice, 0.75), 4), max(l_extendedprice), count(*) - count(l_extendedprice) FROM lineitem
 UNION ALL
 SELECT 'l_discount', min(l_discount), round(quantile_cont(l_discount, 0.25), 6), round(quantile_cont(l_discount, 0.5), 6),
        round(avg(l_discount), 6), round(quantile_cont(l_discount, 0.75), 6), max(l_discount),
        count(*) - count(l_discount) FROM lineitem)""")
def summarize_table(spark, sf):
    li = load(spark, sf, "lineitem")
    s = agg.summarize_table(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return s.select("column", "min", *[F.when(F.col("column") == "l_extendedprice", F.round(c, 4))
                                        .otherwise(F.round(c, 6)).alias(c) for c in ("q1", "median", "mean", "q3")],
                    "max", "nulls")


@register("inspect_schema", section=S, sql="""
SELECT * FROM (VALUES
 ('c_custkey', 'bigint', (SELECT count(*) FILTER (WHERE c_custkey IS NULL) FROM customer), (SELECT count(DISTINCT c_custkey) FROM customer)),
 ('c_name', 'string', (SELECT count(*) FILTER (WHERE c_name IS NULL) FROM customer), (SELECT count(DISTINCT c_name) FROM customer)),
 ('c_nationkey', 'int', (SELECT count(*) FILTER (WHERE c_nationkey IS NULL) FROM customer), (SELECT count(DISTINCT c_nationkey) FROM customer)),
 ('c_acctbal', 'double', (SELECT count(*) FILTER (WHERE c_acctbal IS NULL) FROM customer), (SELECT count(DISTINCT c_acctbal) FROM customer)),
 ('c_mktsegment', 'string', (SELECT count(*) FILTER (WHERE c_mktsegment IS NULL) FROM customer), (SELECT count(DISTINCT c_mktsegment) FROM customer))
) t("column", type, nulls, n_distinct), (SELECT count(*) AS n_rows FROM customer)""")
def inspect_schema(spark, sf):
    return agg.profile_table(load(spark, sf, "customer"))


@register("head_tail", section=S, sql="""
(SELECT 'head' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10)
UNION ALL
(SELECT 'tail' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 10)""")
def head_tail(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return (rel.head_rows(o, 10, "o_orderkey").withColumn("part", F.lit("head"))
            .unionByName(rel.tail_rows(o, 10, "o_orderkey").withColumn("part", F.lit("tail")))
            .select("part", "o_orderkey", "o_totalprice"))
