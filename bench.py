"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1) and
``BENCH_CPUS`` the cores (default 8).  The ``build_*`` entries write the tables
the later queries read, so no work is left out of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from roadpulse.plans import QUERIES, inputs  # noqa: E402

BUILDS = {
    "build_hourly": inputs.hourly,
    "build_first_rows": inputs.first_rows,
    "build_cleaned": inputs.cleaned,
    "build_featured": inputs.featured,
    "build_model_table": inputs.model_table,
}

HEADLINE = [
    "row_count", "verify_load", "duplicate_groups", "hourly_min_view", "dedup_keep_first", "clean_audit",
    "yearly_trends", "coverage_extremes", "holiday_day_temp", "holiday_temperature",
    "descriptive_stats", "temp_volume_corr", "linear_trend", "volume_histogram",
    "probabilities", "independence_gap", "odds_ratio", "congestion_rate_by_weather",
    "monthly_median_impute", "engineer_features", "volume_quartiles", "congestion_category",
    "hourly_profile", "hour_by_daytype_pivot", "weather_profile", "weekday_vs_weekend", "top_hours",
    "recommend_history", "nearest_record",
    "chronological_split", "lag_features", "sequence_windows", "naive_forecast",
    "frequent_itemsets", "association_rules", "rules_for_target", "zscore",
    "scenario_grid", "recommend_profile", "regression_metrics", "classification_metrics", "error_drift",
    "drift_report", "perturb_alert", "run_comparison", "best_run_per_model",
    "reg_linear", "clf_logistic", "clf_forest", "reg_gbt", "reg_lag_forest", "permutation_importance",
    "choose_k", "kmeans", "batch_score_volume", "contribution_sums", "correlation_tests", "pattern_itemsets",
    "stream_clean", "stream_drift", "stream_merge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.files.minPartitionNum", cpus)
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the session and of code generation is not part of a query.
    spark.range(1000).selectExpr("sum(id)").collect()

    seconds: dict[str, float] = {}
    for name, build in BUILDS.items():
        start = time.perf_counter()
        build(spark, sf_dir)
        seconds[name] = round(time.perf_counter() - start, 3)
    for name in os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
