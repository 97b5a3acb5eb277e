"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Every
query is run to the end (no-op sink); the warehouse tables are timed when they
are first built, the reports on top of them when they are asked.
"""

from __future__ import annotations

import json
import os
import sys
import time

from gable.runtime import build_session

BUILD = [
    "silver_listings", "dim_location", "dim_property", "dim_seller", "dim_station", "fact_properties",
    "fact_price_area_time", "fact_seller_time", "fact_metro_analysis", "fact_search_trends_monthly",
]
REPORTS = [
    "v_market_overview_daily", "v_market_overview_analysis", "v_market_trend_analysis", "v_monthly_analysis",
    "v_metro_impact_detail", "v_area_market_analysis", "v_hotspot_analysis", "v_ml_dataset",
    "q01", "q12", "q25", "q27", "q34", "q39",
]
OPERATORS = [
    "dedup_latest_by_id", "dedup_by_fingerprint", "dedup_by_geo", "dense_surrogate_key", "percent_rank_in_group",
    "group_stats_zscore", "group_quantiles", "iqr_outliers", "multi_count_distinct", "lag_growth", "rolling_features",
    "nearest_station", "fact_key_lookup", "salted_key_lookup", "anti_join_new_rows", "one_hot", "keyword_quality_flags",
    "stream_to_bronze", "hotspot_model_fit",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__sql__shuffle__partitions=str(2 * int(cpus)),
        spark__driver__memory="12g", spark__sql__files__maxPartitionBytes="2m",
    )
    spark.sparkContext.setLogLevel("ERROR")

    from gable.catalog.all import ENTRIES

    names = sys.argv[1:] or BUILD + REPORTS + OPERATORS
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the executors before timing
    seconds: dict[str, float] = {}
    for name in names:
        begun = time.perf_counter()
        ENTRIES[name].build(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
