"""The training run as a job: fit, measure, record, choose, and fail on a regression."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.metrics import best_model, metrics_long
from cohortloom.operators.monitors import regression_gate
from cohortloom.plans.training import feature_names, train_classifiers
from cohortloom.sources.lake import Lake, materialise, path_missing, read_layer, read_runs, replace_run


class RegressionError(RuntimeError):
    """The run's best model is worse than earlier runs by more than is allowed."""


@dataclass(frozen=True)
class TrainingRun:
    """``best``: the chosen model and its metric; ``gate``: the verdict of the comparison."""

    metrics: DataFrame
    best: Row
    gate: Row


def metric_history(spark: SparkSession, lake: Lake, like: DataFrame) -> DataFrame:
    """The metrics of all runs so far; none before the first."""
    path = lake.path("_quality", "model_metrics")
    try:
        return read_runs(spark, path, like.schema)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return like.limit(0)


def record_run(scored: DataFrame, lake: Lake, run_id: str, *, n_features: int | None = None,
               trained_at: Column | None = None, max_drop: float = 0.03) -> TrainingRun:
    """Measure scored rows, store the run's metrics in place of its earlier ones, and judge it.

    The scores are stored before they are measured, since they are read several times.
    """
    spark = scored.sparkSession
    long = materialise(metrics_long(scored, run_id, trained_at, n_features), "run-metrics")
    replace_run(long, lake.path("_quality", "model_metrics"), run_id)
    history = metric_history(spark, lake, long)
    return TrainingRun(long, best_model(long).first(),
                       regression_gate(history, run_id, max_drop=max_drop).first())


def train_and_record(spark: SparkSession, lake: Lake, run_id: str, *, max_drop: float = 0.03,
                     fit: Callable[[DataFrame], DataFrame] = train_classifiers,
                     trained_at: Column | None = None) -> TrainingRun:
    """Train on the feature table of the lake and record the run.

    The metrics are kept whatever the verdict; a regression fails the job.
    """
    mart = read_layer(spark, lake, "gold", "feature_mart")
    scored = materialise(fit(mart), "scored-rows")
    run = record_run(scored, lake, run_id, n_features=len(feature_names(mart)),
                     trained_at=trained_at, max_drop=max_drop)
    if run.gate.verdict == "regression":
        raise RegressionError(
            f"{run_id}: {run.gate.current_value} after {run.gate.baseline}, more than {max_drop} down")
    return run
