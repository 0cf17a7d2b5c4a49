"""Classifier evaluation as aggregations over scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators.bounds import value_bounds
from cohortloom.operators.ranking import binned_totals

GROUPS = ("model_name", "split")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def classification_metrics(scored: DataFrame, groups: Sequence[str] = GROUPS,
                           label: str = "label", score: str = "score",
                           threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall and F1; 0 where the denominator is 0."""
    hit, said = F.col(label) == 1, F.col(score) >= threshold
    counted = scored.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(hit & said).alias("_tp"), F.count_if(~hit & said).alias("_fp"),
        F.count_if(hit & ~said).alias("_fn"), F.count_if(~hit & ~said).alias("_tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("_tp", "_fp", "_fn", "_tn"))
    return counted.select(
        *groups, "n_rows",
        _ratio(tp + tn, F.col("n_rows")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def ranking_metrics(scored: DataFrame, groups: Sequence[str] = GROUPS, label: str = "label",
                    score: str = "score") -> DataFrame:
    """Exact ROC-AUC (ties count half) and average precision; NULL with one class.

    Rows are first counted per distinct score; cumulative counts then run bin by
    bin, so neither a popular score nor a whole model sits in a single task. The
    bins are cut where a sketch of the scores says, which reads them once more.
    """
    per_score = scored.groupBy(*groups, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranked = binned_totals(per_score, groups, score, ["pos", "neg"], descending=True,
                           bounds=value_bounds(scored, score))
    # Going down the scores: a positive beats every negative still below it.
    below = F.col("total_neg") - F.col("running_neg")
    wins = F.col("pos") * (below + F.col("neg") / 2)
    at_score = F.col("running_pos") / (F.col("running_pos") + F.col("running_neg"))
    summed = ranked.groupBy(*groups).agg(
        F.sum(wins).alias("_wins"), F.sum(F.col("pos") * at_score).alias("_area"),
        F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"),
    )
    both = (F.col("_pos") > 0) & (F.col("_neg") > 0)
    return summed.select(
        *groups,
        F.when(both, F.try_divide("_wins", F.col("_pos").cast("double") * F.col("_neg")))
        .alias("roc_auc"),
        F.when(both, F.try_divide("_area", F.col("_pos").cast("double"))).alias("pr_auc"),
    )


def focal_loss(scored: DataFrame, groups: Sequence[str] = GROUPS, label: str = "label",
               logit: str = "logit", alpha: float = 0.25, gamma: float = 2.0) -> DataFrame:
    """Mean of ``alpha * (1 - p_t)**gamma * bce`` from raw logits."""
    z, y = F.col(logit), F.col(label).cast("double")
    # softplus in the form that does not overflow for large logits
    bce = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
    loss = F.lit(alpha) * F.pow(1 - F.exp(-bce), F.lit(gamma)) * bce
    return scored.groupBy(*groups).agg(F.avg(loss).alias("focal_loss"))


def evaluate(scored: DataFrame, groups: Sequence[str] = GROUPS) -> DataFrame:
    return classification_metrics(scored, groups).join(
        ranking_metrics(scored, groups), list(groups), "left"
    )


def metrics_long(scored: DataFrame, run_id: str, trained_at: Column | None = None,
                 n_features: int | None = None) -> DataFrame:
    """One row per run, model, split and metric."""
    names = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]
    return evaluate(scored).unpivot(
        [*GROUPS, "n_rows"], names, "metric_name", "metric_value"
    ).select(
        F.lit(run_id).alias("run_id"),
        (trained_at if trained_at is not None else F.current_timestamp()).alias("trained_at"),
        *GROUPS, "metric_name", "metric_value", "n_rows",
        F.lit(n_features).cast("int").alias("n_features"),
    )


def best_model(metrics: DataFrame, metric: str = "roc_auc", split: str = "test") -> DataFrame:
    """The model with the highest metric; a missing value counts as 0."""
    value = F.coalesce("metric_value", F.lit(0.0))
    return metrics.where((F.col("metric_name") == metric) & (F.col("split") == split)).agg(
        F.max_by("model_name", F.struct(value, "model_name")).alias("model_name"),
        F.max(value).alias("metric_value"),
    )


def compare_models(metrics: DataFrame, first: str, second: str) -> DataFrame:
    """Metric by metric: the two models' values and second minus first."""
    def of(model: str) -> Column:
        return F.max(F.when(F.col("model_name") == model, F.col("metric_value")))

    return (
        metrics.where(F.col("model_name").isin(first, second)).groupBy("split", "metric_name")
        .agg(of(first).alias("first_value"), of(second).alias("second_value"))
        .withColumn("difference", F.col("second_value") - F.col("first_value"))
    )


def table_profile(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Rows, features, missing cells and label balance in one pass."""
    def missing(name: str) -> Column:
        gone = F.col(name).isNull()
        if isinstance(df.schema[name].dataType, T.FractionalType):
            gone = gone | F.isnan(name)
        return F.count_if(gone)

    total = sum((missing(f) for f in features), F.lit(0).cast("long"))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(features)).alias("features"),
        total.alias("missing_cells"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )
