"""Bindings for SURVEY 2.10: date and time functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import dates as dt
from quarry.plans.registry import register
from quarry.session import load

S = "2.10"


@register("date_parts", section=S, sql="""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS wday,
       strftime(o_orderdate, '%a') AS wday_label, CAST(dayofyear(o_orderdate) AS INTEGER) AS yday,
       CAST(quarter(o_orderdate) AS INTEGER) AS quarter FROM orders""")
def date_parts(spark, sf):
    d = F.col("o_orderdate")
    return load(spark, sf, "orders").select("o_orderkey", F.year(d).alias("year"), F.month(d).alias("month"),
                                            F.dayofmonth(d).alias("day"), dt.wday(d).alias("wday"),
                                            dt.wday_label(d).alias("wday_label"), F.dayofyear(d).alias("yday"),
                                            F.quarter(d).alias("quarter"))


@register("date_parts_clock", section=S, sql="""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute, CAST(floor(second(ts)) AS INTEGER) AS second FROM events""")
def date_parts_clock(spark, sf):
    t = F.col("ts")
    return load(spark, sf, "events").select("event_id", F.hour(t).alias("hour"), F.minute(t).alias("minute"),
                                            F.second(t).alias("second"))


@register("date_round_floor", section=S, sql="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER) AS week_floor,
       CAST(o_orderdate + INTERVAL 84 HOURS AS DATE) - CAST(dayofweek(o_orderdate + INTERVAL 84 HOURS) AS INTEGER) AS week_round,
       make_date(CAST(floor(year(o_orderdate) / 10) * 10 AS INTEGER), 1, 1) AS decade,
       date_trunc('month', o_orderdate) AS month_floor FROM orders""")
def date_round_floor(spark, sf):
    d = F.col("o_orderdate")
    return load(spark, sf, "orders").select("o_orderkey", dt.floor_week_sunday(d).alias("week_floor"),
                                            dt.round_week_sunday(d).alias("week_round"), dt.floor_years(d, 10).alias("decade"),
                                            F.date_trunc("month", d).cast("timestamp_ntz").alias("month_floor"))


@register("epoch_to_timestamp", section=S, sql="""
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS secs, make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS back FROM events""")
def epoch_to_timestamp(spark, sf):
    e = load(spark, sf, "events").select("event_id", dt.ntz_epoch_seconds("ts").alias("secs"))
    return e.withColumn("back", dt.ntz_from_epoch_seconds("secs"))


@register("parse_timestamps", section=S, sql="""
SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y %H:%M:%S') AS mdy_text, strptime(strftime(o_orderdate, '%m/%d/%Y %H:%M:%S'), '%m/%d/%Y %H:%M:%S') AS mdy,
       strftime(o_orderdate, '%b %d, %Y') AS long_text, CAST(strptime(strftime(o_orderdate, '%b %d, %Y'), '%b %d, %Y') AS DATE) AS long_date FROM orders""")
def parse_timestamps(spark, sf):
    d = F.col("o_orderdate")
    o = load(spark, sf, "orders").select("o_orderkey", F.date_format(d, "MM/dd/yyyy HH:mm:ss").alias("mdy_text"),
                                         F.date_format(d, "MMM dd, yyyy").alias("long_text"))
    return o.select("o_orderkey", "mdy_text", F.to_timestamp_ntz("mdy_text", F.lit("MM/dd/yyyy HH:mm:ss")).alias("mdy"),
                    "long_text", F.to_date("long_text", "MMM dd, yyyy").alias("long_date"))


@register("build_date", section=S, sql="""
SELECT o_orderkey, make_date(CAST(year(o_orderdate) AS INTEGER), CAST(month(o_orderdate) AS INTEGER), 1) AS month_start FROM orders""")
def build_date(spark, sf):
    d = F.col("o_orderdate")
    return load(spark, sf, "orders").select("o_orderkey", F.make_date(F.year(d), F.month(d), F.lit(1)).alias("month_start"))


@register("date_plus_time", section=S, sql="""
SELECT event_id, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS shifted FROM events""")
def date_plus_time(spark, sf):
    return load(spark, sf, "events").select("event_id", dt.add_seconds("ts", "value").alias("shifted"))


@register("timezone_shift", section=S, sql="""
SELECT event_id, timezone('America/Chicago', timezone('UTC', ts)) AS with_tz_chicago,
       timezone('UTC', timezone('America/Chicago', ts)) AS force_tz_chicago FROM events""")
def timezone_shift(spark, sf):
    """with_tz (same instant, Chicago clock) vs force_tz (the Chicago clock
    read as an instant, shown in UTC); wall-clock in, wall-clock out."""
    return load(spark, sf, "events").select("event_id", dt.with_tz("ts", "UTC", "America/Chicago").alias("with_tz_chicago"),
                                            dt.force_tz("ts", "America/Chicago", "UTC").alias("force_tz_chicago"))


@register("interval_contains", section=S, sql="""
SELECT o_orderkey, o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-06-30 23:59:59' AS in_window FROM orders""")
def interval_contains(spark, sf):
    d = F.col("o_orderdate")
    return load(spark, sf, "orders").select("o_orderkey", d.between(F.lit("1996-03-01").cast("timestamp_ntz"),
                                                                    F.lit("1996-06-30 23:59:59").cast("timestamp_ntz")).alias("in_window"))


@register("decimal_date", section=S, sql="""
SELECT event_id, round(year(ts) + (epoch(ts) - epoch(make_timestamp(year(ts), 1, 1, 0, 0, 0))) /
       (86400.0 * (CASE WHEN (year(ts) % 4 = 0 AND year(ts) % 100 <> 0) OR year(ts) % 400 = 0 THEN 366 ELSE 365 END)), 8) AS decimal_year
FROM events""")
def decimal_date(spark, sf):
    return load(spark, sf, "events").select("event_id", F.round(dt.decimal_date("ts"), 8).alias("decimal_year"))


CLOCK_SQL = ("SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE '(' || CAST(CAST(floor(value / 60) AS BIGINT) AS VARCHAR) || ':' || "
             "lpad(CAST(CAST(floor(value) AS BIGINT) % 60 AS VARCHAR), 2, '0') || ')' END AS txt FROM events")


@register("clock_text_to_seconds", section=S, sql=f"""
SELECT event_id, txt, CASE WHEN regexp_matches(txt, '\\(([0-9]+):([0-9]{{2}})\\)')
  THEN CAST(regexp_extract(txt, '\\(([0-9]+):([0-9]{{2}})\\)', 1) AS INTEGER) * 60 + CAST(regexp_extract(txt, '\\(([0-9]+):([0-9]{{2}})\\)', 2) AS INTEGER) END AS secs
FROM ({CLOCK_SQL})""")
def clock_text_to_seconds(spark, sf):
    ev = load(spark, sf, "events")
    txt = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.concat(
        F.lit("("), F.floor(F.col("value") / 60).cast("string"), F.lit(":"),
        F.lpad(F.pmod(F.floor("value"), F.lit(60)).cast("string"), 2, "0"), F.lit(")")))
    return ev.select("event_id", txt.alias("txt")).withColumn("secs", dt.clock_text_to_seconds("txt"))
