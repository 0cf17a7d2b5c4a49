"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortloom.catalog import QUERIES  # noqa: E402
from cohortloom.session import SESSION_SETTINGS  # noqa: E402

HEADLINE = (
    "c4_clean_patients", "c7_clean_admissions", "c10_clean_diagnoses", "j2_stay_join",
    "j3_interval_join", "j4_clean_events", "j5_match_to_interval", "j9_control_anti_join",
    "a1_aggregate_measurements", "a1_measurements_of_orders", "a3_pivot_features",
    "a9_hash_sample", "a10_stratified_split", "a11_build_cohort", "a12_build_feature_mart",
    "a13_conditional_aggregates", "q9_suite_run", "m6_ranking_metrics", "m8_metrics_long",
    "t6_unique_combination", "t14_no_subject_across_splits", "w13_lab_profile",
    "p3_impute_median",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = {
        **SESSION_SETTINGS, "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # The JVM's start and first compilation belong to no query.
    QUERIES["s4_read_layer"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
