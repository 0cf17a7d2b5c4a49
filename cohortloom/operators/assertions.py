"""Assertions that return the offending rows: an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.rules import RULES, StudyRules


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    return repeated_combinations(df.where(F.col(column).isNotNull()), [column])


def repeated_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def unexpected_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Non-null values outside the accepted set, with their row counts."""
    return (
        df.where(~F.col(column).isin(list(accepted)))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def outside_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return df.where(bad)


def freshness(df: DataFrame, now: Column, loaded_at: str = "_loaded_at",
              warn_hours: int = 26, error_hours: int = 72) -> DataFrame:
    """Age of the newest load, in hours, and what it means."""
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    seconds = now.cast("timestamp").cast("long") - F.col("max_loaded_at").cast("timestamp").cast(
        "long"
    )
    age = seconds / F.lit(3600.0)
    return newest.withColumn("age_hours", F.round(age, 3)).withColumn(
        "status",
        F.when(age.isNull() | (age > error_hours), F.lit("error"))
        .when(age > warn_hours, F.lit("warn")).otherwise(F.lit("pass")),
    )


def class_balance(df: DataFrame, label: str = "label", minimum_rows: int = 100,
                  low: float = 0.20, high: float = 0.80) -> DataFrame:
    share = F.avg(F.col(label).cast("double"))
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"), share.alias("positive_share"))
    outside = (F.col("positive_share") < low) | (F.col("positive_share") > high)
    return counts.where((F.col("total_rows") < minimum_rows) | outside).withColumn(
        "positive_share", F.round("positive_share", 6)
    )


def one_class_splits(df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    ).where("positives = 0 or negatives = 0")


def feature_outside_measured_range(features: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    value = F.col("feature_value")
    beyond = (value < F.col("min_value") - tolerance) | (value > F.col("max_value") + tolerance)
    return features.where(beyond).select(
        "hadm_id", "lab_name", "feature_value", "min_value", "max_value"
    )


def wrong_aggregation_rule(features: DataFrame) -> DataFrame:
    expected = F.when(F.col("is_acute_marker"), F.lit("first")).when(
        ~F.col("is_acute_marker"), F.lit("mean")
    )
    keys = ["lab_name", "is_acute_marker", "aggregation_rule"]
    return features.where(F.col("aggregation_rule") != expected).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("offending_rows")
    )


def stays_outside_window(stays: DataFrame, rules: StudyRules = RULES) -> DataFrame:
    hours = F.col("length_of_stay_hours")
    bad = (hours < 0) | (hours > rules.max_stay_hours) | (
        F.col("discharged_at") < F.col("admitted_at")
    )
    return stays.where(bad).select(
        "hadm_id", "admitted_at", "discharged_at", "length_of_stay_hours"
    )


def blocking_failures_in_latest_run(results: DataFrame) -> DataFrame:
    """Failed error checks of the run with the newest result (ties: higher run id)."""
    newest = results.agg(
        F.max(F.struct("checked_at", "run_id")).getField("run_id").alias("r")
    ).scalar()
    return results.where(
        (F.col("run_id") == newest) & (F.col("severity") == "error") & ~F.col("passed")
    ).select("layer", "table_name", "check_name", "details")


def subjects_across_splits(df: DataFrame) -> DataFrame:
    """Subjects found in several splits; pairs are made distinct map-side first."""
    pairs = df.where(F.col("split").isNotNull()).select("subject_id", "split").distinct()
    return pairs.groupBy("subject_id").agg(F.count(F.lit(1)).alias("splits_present")).where(
        "splits_present > 1"
    )


def imputed_features(coverage: DataFrame) -> DataFrame:
    return coverage.where((F.col("column_kind") == "lab_feature") & (F.col("null_rate") == 0)
                          ).select("column_name", "column_kind", "null_rate")
