"""Dimensional and reporting models as DataFrame builders.

Every model is a lazy function of its inputs, so a report pulls only the
columns it shows through the whole chain down to the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.columns import (
    banded,
    bounded_median,
    conditional_count,
    conditional_max,
    round_numeric,
    sample_sd,
    surrogate_key,
)
from cohortloom.operators.features import column_or_null, numeric_features
from cohortloom.operators.ranking import exact_quantile
from cohortloom.rules import (
    AGE_BAND_REST,
    AGE_BANDS,
    METRIC_NAMES,
    RULES,
    TIER_BOUNDS,
    TIER_REST,
    StudyRules,
)

AGE_BUCKETS = (18, 98, 8)
TROPONIN_LIMIT = 0.10
TRAINING_KEYS = ("hadm_id", "subject_id", "label", "split", "age", "gender_male", "los_hours",
                 "has_ecg")
NOT_LAB_COLUMNS = (
    "subject_id", "hadm_id", "label", "split", "split_bucket", "gender", "gender_male", "age",
    "anchor_age", "admittime", "dischtime", "los_hours", "admit_year", "admission_type",
    "insurance", "race", "died_in_hospital", "has_ecg", "ecg_study_id", "ecg_path",
    "ecg_hours_from_admit", "feature_count", "_run_id", "_loaded_at", "_source",
)


def renamed(df: DataFrame, names: Mapping[str, str]) -> list:
    return [F.col(source).alias(target) for source, target in names.items()]


# -- staging ------------------------------------------------------------------

def stg_cohort(cohort: DataFrame, rules: StudyRules = RULES) -> DataFrame:
    low, high, buckets = AGE_BUCKETS
    group = F.when(F.col("label") == 1, F.lit(rules.case_name)).otherwise(
        F.lit(rules.control_name)
    )
    return cohort.select(
        "subject_id", "hadm_id", "label", group.alias("cohort_group"), "gender",
        F.coalesce((F.col("gender") == "M").cast("int"), F.lit(0)).alias("is_male"),
        F.col("anchor_age").alias("age_years"),
        F.width_bucket(
            F.col("anchor_age").cast("double"), F.lit(float(low)), F.lit(float(high)),
            F.lit(buckets),
        ).cast("int").alias("age_bucket"),
        *renamed(cohort, {"admittime": "admitted_at", "dischtime": "discharged_at",
                          "los_hours": "length_of_stay_hours"}),
        "admit_year", "admission_type", "insurance", "race", "died_in_hospital", "split",
        F.col("_run_id").alias("etl_run_id"),
    )


def stg_lab_features(lab_features: DataFrame) -> DataFrame:
    return lab_features.select(
        "hadm_id",
        *renamed(lab_features, {"itemid": "lab_itemid", "label": "lab_name"}),
        "is_acute_marker", F.col("aggregation").alias("aggregation_rule"),
        "feature_value", "first_value", "mean_value", "min_value", "max_value",
        "measurement_count", "first_measurement_hours", F.col("_run_id").alias("etl_run_id"),
    )


def stg_feature_mart(mart: DataFrame) -> DataFrame:
    """The mart as published: its lab columns follow the data."""
    return mart


def stg_feature_coverage(coverage: DataFrame) -> DataFrame:
    return coverage.select(
        "column_name", "column_kind", "non_null_rows", "total_rows", "null_rate",
        round_numeric(1 - F.col("null_rate"), 4).alias("coverage_rate"),
        *renamed(coverage, {"_run_id": "etl_run_id", "_loaded_at": "loaded_at"}),
    )


def stg_dq_results(results: DataFrame) -> DataFrame:
    return results.select(
        "run_id", "checked_at", "layer", "table_name", "check_name", "severity",
        (F.col("passed") == "true").alias("passed"),
        "observed", "threshold", "row_count", "details",
        F.split_part("check_name", F.lit("__"), F.lit(1)).alias("check_type"),
    )


def stg_model_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.select("run_id", "trained_at", "model_name", "split", "metric_name",
                          "metric_value", "n_rows", "n_features")


# -- intermediate -------------------------------------------------------------

def int_cohort_lab_panel(cohort: DataFrame, labs: DataFrame) -> DataFrame:
    people = cohort.select("subject_id", "hadm_id", "label", "cohort_group", "split",
                           "age_years", "is_male")
    values = labs.select("hadm_id", "lab_itemid", "lab_name", "is_acute_marker",
                         "aggregation_rule", "feature_value", "measurement_count",
                         "first_measurement_hours")
    return people.join(values, "hadm_id")


# -- marts --------------------------------------------------------------------

def dim_patient(cohort: DataFrame) -> DataFrame:
    return cohort.select(
        "subject_id", "gender", "is_male", "age_years", "age_bucket",
        banded("age_years", AGE_BANDS, AGE_BAND_REST, inclusive=False).alias("age_group"),
        "race", "insurance", F.col("label").alias("has_angina"), "cohort_group", "split",
        "etl_run_id",
    )


def fct_admission(cohort: DataFrame, labs: DataFrame) -> DataFrame:
    activity = labs.groupBy("hadm_id").agg(
        F.count(F.lit(1)).alias("distinct_labs_measured"),
        F.sum("measurement_count").alias("total_lab_measurements"),
        conditional_count(F.col("is_acute_marker")).alias("acute_markers_measured"),
        F.min("first_measurement_hours").alias("first_lab_hours_from_admit"),
        F.lit(True).alias("has_any_lab"),
    )
    counters = ("distinct_labs_measured", "total_lab_measurements", "acute_markers_measured")
    return cohort.join(activity, "hadm_id", "left").select(
        "hadm_id", "subject_id", "label", "cohort_group", "split", "admitted_at",
        "discharged_at", "length_of_stay_hours",
        round_numeric(F.col("length_of_stay_hours") / 24.0, 2).alias("length_of_stay_days"),
        "admit_year", "admission_type", "died_in_hospital",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counters],
        "first_lab_hours_from_admit",
        F.coalesce("has_any_lab", F.lit(False)).alias("has_any_lab"),
        "etl_run_id",
    )


def fct_lab_result(panel: DataFrame) -> DataFrame:
    return panel.select(
        surrogate_key("hadm_id", "lab_itemid").alias("lab_result_key"),
        "hadm_id", "subject_id", "lab_itemid", "lab_name", "is_acute_marker",
        "aggregation_rule", "feature_value", "measurement_count", "first_measurement_hours",
        "label", "cohort_group", "split",
    )


def training_features(mart: DataFrame) -> DataFrame:
    """The contract with the models: keys, split, attributes, every lab, no fills."""
    labs = [
        name for name in numeric_features(mart, NOT_LAB_COLUMNS).columns
        if dict(mart.dtypes)[name] != "boolean"
    ]
    elevated = column_or_null(mart, "troponin_t") > TROPONIN_LIMIT
    return mart.select(
        *TRAINING_KEYS, elevated.alias("troponin_elevated"),
        *[F.col(f"`{name}`") for name in labs], F.col("_run_id").alias("etl_run_id"),
    )


# -- reports ------------------------------------------------------------------

def cohort_summary(cohort: DataFrame) -> DataFrame:
    """Per group and split. Ages have at most 121 levels, which bounds the median."""
    died = F.coalesce(F.col("died_in_hospital").cast("int"), F.lit(0))
    return cohort.groupBy("cohort_group", "split").agg(
        F.count(F.lit(1)).alias("patients"),
        round_numeric(F.avg("age_years"), 1).alias("mean_age"),
        bounded_median("age_years").alias("median_age"),
        round_numeric(F.avg("is_male"), 3).alias("male_share"),
        round_numeric(F.avg("length_of_stay_hours"), 1).alias("mean_los_hours"),
        round_numeric(F.avg(died), 4).alias("in_hospital_mortality"),
        F.min("admitted_at").alias("earliest_admission"),
        F.max("admitted_at").alias("latest_admission"),
    ).orderBy("cohort_group", "split")


def lab_profile(panel: DataFrame, rules: StudyRules = RULES) -> DataFrame:
    """Case against control per lab, with the effect size."""
    lab = ["lab_name", "is_acute_marker", "aggregation_rule"]
    keys = [*lab, "cohort_group"]
    moments = panel.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("admissions"),
        F.avg("feature_value").alias("mean"),
        sample_sd("feature_value").alias("sd"),
    )
    medians = exact_quantile(panel, keys, "feature_value").withColumnRenamed("quantile", "median")
    by_group = moments.join(medians, keys, "left")
    sides = {rules.case_name: "angina", rules.control_name: "control"}
    wide = by_group.groupBy(*lab).agg(*[
        conditional_max(stat, F.col("cohort_group") == group).alias(f"{side}_{stat}")
        for stat in ("admissions", "mean", "median", "sd")
        for group, side in sides.items()
    ])
    sd_case, sd_control = (F.coalesce(f"{s}_sd", F.lit(0.0)) for s in sides.values())
    gap = F.col("angina_mean") - F.col("control_mean")
    pooled = F.sqrt((F.pow(sd_case, F.lit(2)) + F.pow(sd_control, F.lit(2))) / 2.0)
    effect = F.when(sd_case + sd_control != 0, round_numeric(F.try_divide(gap, pooled), 3))
    return wide.withColumns({"mean_difference": gap, "cohens_d": effect}).orderBy(
        F.abs(F.coalesce("cohens_d", F.lit(0.0))).desc(), *lab
    )


def feature_coverage(staged: DataFrame) -> DataFrame:
    tier = banded("null_rate", TIER_BOUNDS, TIER_REST, inclusive=True)
    return staged.select(
        "column_name", "column_kind", "total_rows", "non_null_rows", "null_rate",
        "coverage_rate", tier.alias("completeness_tier"), "etl_run_id", "loaded_at",
    ).orderBy("null_rate", "column_name")


def dq_history(staged: DataFrame) -> DataFrame:
    failed = ~F.col("passed")
    per_run = staged.groupBy("run_id", "layer", "table_name").agg(
        F.max("checked_at").alias("checked_at"),
        F.count(F.lit(1)).alias("checks_run"),
        conditional_count(F.col("passed")).alias("checks_passed"),
        conditional_count(failed & (F.col("severity") == "error")).alias("blocking_failures"),
        conditional_count(failed & (F.col("severity") == "warn")).alias("warnings"),
        F.max("row_count").alias("row_count"),
    )
    return per_run.withColumns({
        "pass_rate": round_numeric(F.try_divide("checks_passed", "checks_run"), 4),
        "run_healthy": F.col("blocking_failures") == 0,
    }).orderBy(F.col("checked_at").desc(), "layer", "table_name", "run_id")


def model_performance(staged: DataFrame) -> DataFrame:
    """Metrics side by side per run, and the change in ROC-AUC since the last run."""
    wide = staged.groupBy("run_id", "trained_at", "model_name", "split").agg(
        F.max("n_rows").alias("n_rows"), F.max("n_features").alias("n_features"),
        *[conditional_max("metric_value", F.col("metric_name") == m).alias(m)
          for m in METRIC_NAMES],
    )
    history = Window.partitionBy("model_name", "split").orderBy("trained_at", "run_id")
    return wide.withColumn(
        "roc_auc_change_vs_previous_run", F.col("roc_auc") - F.lag("roc_auc").over(history)
    ).orderBy(
        F.col("trained_at").desc(), "split", F.col("roc_auc").desc_nulls_last(), "model_name"
    )


def build_models(sources: Mapping[str, DataFrame], rules: StudyRules = RULES
                 ) -> dict[str, DataFrame]:
    """Every model whose sources are given, by name."""
    out: dict[str, DataFrame] = {}
    if "cohort" in sources:
        out["stg_cohort"] = stg_cohort(sources["cohort"], rules)
        out["dim_patient"] = dim_patient(out["stg_cohort"])
        out["analytics_cohort_summary"] = cohort_summary(out["stg_cohort"])
    if "lab_features" in sources:
        out["stg_lab_features"] = stg_lab_features(sources["lab_features"])
    if {"stg_cohort", "stg_lab_features"} <= set(out):
        panel = int_cohort_lab_panel(out["stg_cohort"], out["stg_lab_features"])
        out["int_cohort_lab_panel"] = panel
        out["fct_admission"] = fct_admission(out["stg_cohort"], out["stg_lab_features"])
        out["fct_lab_result"] = fct_lab_result(panel)
        out["analytics_lab_profile_by_cohort"] = lab_profile(panel, rules)
    if "feature_mart" in sources:
        out["stg_feature_mart"] = stg_feature_mart(sources["feature_mart"])
        out["mart_angina_training_features"] = training_features(out["stg_feature_mart"])
    if "feature_coverage" in sources:
        out["stg_feature_coverage"] = stg_feature_coverage(sources["feature_coverage"])
        out["analytics_feature_coverage"] = feature_coverage(out["stg_feature_coverage"])
    if "dq_results" in sources:
        out["stg_dq_results"] = stg_dq_results(sources["dq_results"])
        out["analytics_data_quality_history"] = dq_history(out["stg_dq_results"])
    if "model_metrics" in sources:
        out["stg_model_metrics"] = stg_model_metrics(sources["model_metrics"])
        out["analytics_model_performance"] = model_performance(out["stg_model_metrics"])
    return out


def register_views(models: Mapping[str, DataFrame]) -> None:
    """Make the models queryable by name with ``spark.sql``."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
