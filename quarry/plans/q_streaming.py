"""Bindings for SURVEY 2.18: streaming.  Each query drives a streaming job
over the events table to completion (availableNow) and returns the sink.
With the whole table in one micro-batch there are no late rows, so the rows
emitted up to the closing marker equal the batch aggregate."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.registry import register
from quarry.streaming import live

S = "2.18"


@register("stream_tumbling_resample", section=S, sql="""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type,
       round(avg(value), 9) AS mean_value, count(*) AS n FROM events GROUP BY 1, 2, 3""")
def stream_tumbling_resample(spark, sf):
    out = live.run_closed(live.event_stream(spark, sf), lambda e: live.tumbling_mean(e, "1 hour", ["event_type"], "value"), "tumbling")
    return out.withColumn("mean_value", F.round("mean_value", 9))


@register("stream_sliding_count", section=S, sql="""
WITH w AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL (15 * k) MINUTE AS window_start, event_type
           FROM events, (VALUES (0), (1), (2), (3)) t(k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n FROM w
GROUP BY 1, 2, 3""")
def stream_sliding_count(spark, sf):
    return live.run_closed(live.event_stream(spark, sf), lambda e: live.sliding_count(e, "1 hour", "15 minutes", ["event_type"]), "sliding")


@register("stream_session_visits", section=S, sql="""
WITH e AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS new_s FROM events),
     s AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 10 MINUTE AS session_end, count(*) AS n_events, round(sum(value), 6) AS total
FROM s GROUP BY user_id, sid""")
def stream_session_visits(spark, sf):
    out = live.run_closed(live.event_stream(spark, sf), lambda e: live.sessions(e, "10 minutes", ["user_id"]), "sessions")
    return out.withColumn("total", F.round("total", 6))


@register("stream_dedupe", section=S, sql="SELECT DISTINCT event_id, user_id, event_type FROM events")
def stream_dedupe(spark, sf):
    out = live.run_append(live.dedupe(live.event_stream(spark, sf), ["event_id"]), "dedupe")
    return out.select("event_id", "user_id", "event_type")


CATEGORIES = [("click", "engagement"), ("view", "engagement"), ("purchase", "revenue"), ("signup", "growth"),
              ("error", "quality")]


@register("stream_static_join", section=S, sql="""
SELECT event_id, event_type, category FROM events LEFT JOIN (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in CATEGORIES)
          + """) t(event_type, category) USING (event_type)""")
def stream_static_join(spark, sf):
    lk = F.broadcast(spark.createDataFrame(CATEGORIES, "event_type STRING, category STRING"))  # 5 literal rows
    j = live.static_join(live.event_stream(spark, sf).select("event_id", "event_type"), lk, "event_type")
    return live.run_append(j, "static-join").select("event_id", "event_type", "category")


@register("stream_running_profit", section=S, sql="""
SELECT user_id, round(sum(value), 6) AS total, count(*) AS n FROM events GROUP BY user_id""")
def stream_running_profit(spark, sf):
    out = live.run_update(live.running_totals(live.event_stream(spark, sf), ["user_id"], "value"), "running", ["user_id"])
    return out.select("user_id", F.round("total", 6).alias("total"), "n")

