"""Drift and regression monitors over quality, coverage and metric histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.columns import bounded_median


def soft_failures(history: DataFrame, now: Column, days: int = 7, limit: int = 50) -> DataFrame:
    """The newest warn-severity failures of the last ``days`` days."""
    recent = history.where(F.col("checked_at") >= now - F.make_dt_interval(days=F.lit(days)))
    return (
        recent.where((F.col("passed") == "false") & (F.col("severity") == "warn"))
        .select("run_id", "checked_at", "layer", "table_name", "check_name", "observed",
                "threshold")
        .orderBy(F.col("checked_at").desc(), "run_id", "layer", "table_name", "check_name")
        .limit(limit)
    )


def run_ranks(history: DataFrame, run: str = "_run_id") -> DataFrame:
    """1 for the newest run, 2 for the one before, ...: a list of runs, not of rows."""
    runs = history.select(run).distinct()
    return runs.withColumn(
        "run_rank",
        F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(F.col(run).desc())),
    )


def newest_two_runs(history: DataFrame, run: str = "_run_id") -> tuple[DataFrame, DataFrame]:
    """Rows of the newest run and of the run before it, found by two maxima."""
    newest = history.agg(F.max(run).alias("r")).scalar()
    previous = history.where(F.col(run) < newest).agg(F.max(run).alias("r")).scalar()
    return history.where(F.col(run) == newest), history.where(F.col(run) == previous)


def compare_runs(history: DataFrame, run: str = "_run_id") -> DataFrame:
    """Null rate of every column in the newest run next to the previous one."""
    current, previous = newest_two_runs(history, run)
    return current.select("column_name", F.col("null_rate").alias("current_rate")).join(
        previous.select("column_name", F.col("null_rate").alias("previous_rate")), "column_name"
    )


def null_rate_drift(history: DataFrame, jump: float = 0.15, run: str = "_run_id") -> DataFrame:
    rise = F.col("current_rate") - F.col("previous_rate")
    # The limit holds for what was measured; rounding is for reading only.
    return (
        compare_runs(history, run).where(rise > jump).withColumn("increase", F.round(rise, 6))
        .orderBy(F.col("increase").desc(), "column_name")
    )


def cohort_drift(history: DataFrame, relative: float = 0.20) -> DataFrame:
    """Tables whose row count moved by more than ``relative`` since the run before."""
    per_run = history.groupBy("layer", "table_name", "run_id").agg(
        F.max("checked_at").alias("checked_at"), F.max("row_count").alias("row_count")
    )
    in_order = Window.partitionBy("layer", "table_name").orderBy("checked_at", "run_id")
    change = F.try_divide(F.col("row_count") - F.col("previous_rows"), "previous_rows")
    return (
        per_run.withColumn("previous_rows", F.lag("row_count").over(in_order))
        .withColumn("relative_change", F.round(change, 6))
        .where(F.abs("relative_change") > relative)
    )


def regression_gate(
    metrics: DataFrame,
    run_id: str | Column,
    metric: str = "roc_auc",
    split: str = "test",
    max_drop: float = 0.03,
    min_history: int = 2,
    *,
    earlier_only: bool = True,
) -> DataFrame:
    """One verdict row: the run's best value against the median of other runs' best.

    ``earlier_only`` compares with runs trained before this one; switch it off
    to compare with every other run.
    """
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    best = metrics.where((F.col("metric_name") == metric) & (F.col("split") == split)).groupBy(
        "run_id"
    ).agg(F.max("metric_value").alias("best"), F.max("trained_at").alias("trained_at"))
    other = F.col("run_id") != run
    if earlier_only:
        current = best.where(F.col("run_id") == run)
        other = other & (F.col("trained_at") < current.agg(F.max("trained_at").alias("t")).scalar())
    summary = best.agg(
        F.count(F.lit(1)).alias("all_runs"),
        F.count_if(F.col("run_id") == run).alias("current_runs"),
        F.max(F.when(F.col("run_id") == run, F.col("best"))).alias("current_value"),
        F.count_if(other).alias("previous_runs"),
        # One value per run: the median's counters grow with runs, not with rows.
        bounded_median(F.when(other, F.col("best"))).alias("baseline"),
    )
    drop = F.col("baseline") - F.col("current_value")
    verdict = (
        F.when(F.col("all_runs") == 0, F.lit("no_history"))
        .when(F.col("current_runs") == 0, F.lit("no_metric"))
        .when(F.col("previous_runs") < min_history, F.lit("short_history"))
        .when(drop > max_drop, F.lit("regression"))
        .otherwise(F.lit("within_tolerance"))
    )
    return summary.select(
        run.alias("run_id"), "current_value", "previous_runs", "baseline", drop.alias("drop"),
        verdict.alias("verdict"),
        (~verdict.isin("no_metric", "regression")).alias("passed"),
    )


def health_report(dq_history: DataFrame, coverage: DataFrame, performance: DataFrame
                  ) -> dict[str, DataFrame]:
    """The morning check: four short frames over the reporting models."""
    newest = [F.col("checked_at").desc(), "layer", "table_name", "run_id"]
    return {
        "latest_quality": dq_history.orderBy(*newest).limit(20),
        "weak_features": coverage.where(
            F.col("completeness_tier").isin("sparse", "mostly_missing")
        ).orderBy(F.col("null_rate").desc(), "column_name"),
        "latest_models": performance.orderBy(
            F.col("trained_at").desc(), "split", "model_name"
        ).limit(10),
        "unhealthy_runs": dq_history.where(~F.col("run_healthy")).orderBy(*newest),
    }
