"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion through the ``noop`` sink (full
computation, no driver collection).  Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans.registry import load_all  # noqa: E402
from quarry.session import build_session  # noqa: E402

HEADLINE = [
    # relational core
    "simpson_rates", "agg_basic", "join_inner", "join_left_diff_keys", "agg_grouping_sets", "win_topn_per_group",
    "win_zscore", "pivot", "unpivot",
    # exact distributed quantiles
    "agg_median", "box_stats", "summarize_table",
    # text
    "tokenize_words", "word_bigrams", "entropy_string", "sentiment_score", "log_odds_words",
    # range / geo joins
    "join_interval_point", "geo_radius_join", "geo_nearest_site",
    # statistics and time series
    "chi_square_test", "survey_design_mean_se", "kaplan_meier", "ts_autocorrelation", "ts_decompose",
    # ML / graph / streaming
    "win_lag_diff", "win_cumsum", "geo_track_distance",
    "ml_cosine_similarity", "ml_knn", "ml_single_linkage_cut", "ml_recommend_items", "rmse_repeated_holdout", "graph_betweenness", "stream_tumbling_resample",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    reg = load_all()
    # warm-up: JVM, parquet readers, codegen
    reg["agg_basic"].fn(spark, sf_dir).write.mode("overwrite").format("noop").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        reg[name].fn(spark, sf_dir).write.mode("overwrite").format("noop").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
