"""Monitors, model metrics, feature preparation and training."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.catalog.base import query
from cohortloom.catalog.sql import long_metrics, rounded
from cohortloom.catalog.tables import ITEM_NUMBERS
from cohortloom.operators import metrics, monitors, prep, signals
from cohortloom.plans import training, training_job, warehouse
from cohortloom.session import fresh_path
from cohortloom.sources.lake import Lake, materialise

LABS = tuple(ITEM_NUMBERS)
NOW = "timestamp_ntz'2024-01-11 00:00:00'"


@query("m1_soft_failures", """
select run_id, checked_at, layer, table_name, check_name, observed, threshold from dq_results
where checked_at >= timestamp '2024-01-11' - interval 7 day and passed = 'false'
  and severity = 'warn'
order by checked_at desc, run_id, layer, table_name, check_name limit 50""")
def m1(t):
    return monitors.soft_failures(t.dq_results, F.expr(NOW))


@query("m2_null_rate_drift", f"""
with ranked as (select *, dense_rank() over (order by _run_id desc) as r from coverage_history)
select c.column_name, c.null_rate as current_rate, p.null_rate as previous_rate,
  {rounded('c.null_rate - p.null_rate', 6)} as increase
from ranked c join ranked p on p.column_name = c.column_name and c.r = 1 and p.r = 2
where c.null_rate - p.null_rate > 0.15""")
def m2(t):
    return monitors.null_rate_drift(t.coverage_history)


@query("m3_cohort_drift", f"""
select *, {rounded('(row_count - previous_rows) / previous_rows', 6)} as relative_change
from (
  select layer, table_name, run_id, checked_at, row_count,
    lag(row_count) over (partition by layer, table_name order by checked_at, run_id)
      as previous_rows
  from (select layer, table_name, run_id, max(checked_at) as checked_at,
      max(row_count) as row_count from dq_results group by 1, 2, 3))
where abs((row_count - previous_rows) / nullif(previous_rows, 0)) > 0.05""")
def m3(t):
    return monitors.cohort_drift(t.dq_results, 0.05)


def gate_sql(run: str, others: str, max_drop: float) -> str:
    return f"""
select '{run}' as run_id, {rounded('current', 9)} as current_value, n as previous_runs,
  {rounded('baseline', 9)} as baseline, {rounded('baseline - current', 9)} as drop,
  case when n < 2 then 'short_history' when baseline - current > {max_drop} then 'regression'
    else 'within_tolerance' end as verdict,
  n < 2 or not (baseline - current > {max_drop}) as passed
from (
  select (select best from per_run where run_id = '{run}') as current, count(*) as n,
    quantile_cont(best, 0.5) as baseline
  from per_run where {others})"""


PER_RUN = """
with per_run as (select run_id, max(metric_value) as best from model_metrics
  where metric_name = 'roc_auc' and split = 'test' group by run_id) """


@query("m4_regression_gate", """
select * from (""" + PER_RUN + " union all ".join((
    gate_sql("run-4", "run_id < 'run-4'", 0.03), gate_sql("run-3", "run_id < 'run-3'", 0.0001),
    gate_sql("run-1", "run_id < 'run-1'", 0.03), gate_sql("run-0", "run_id <> 'run-0'", 0.03),
)) + ")")
def m4(t):
    history = t.model_metrics
    gates = [
        monitors.regression_gate(history, "run-4"),
        monitors.regression_gate(history, "run-3", max_drop=0.0001),
        monitors.regression_gate(history, "run-1"),
        monitors.regression_gate(history, "run-0", earlier_only=False),
    ]
    return reduce(DataFrame.unionByName, gates).withColumns({
        c: F.round(c, 9) for c in ("current_value", "baseline", "drop")
    })


POINT_METRICS = ("accuracy", "precision", "recall", "f1")


@query("m5_classification_metrics", f"""
select model_name, split, n_rows, {', '.join(f'{rounded(m, 6)} as {m}' for m in POINT_METRICS)}
from metrics_by_model""")
def m5(t):
    found = metrics.classification_metrics(t.scored)
    return found.withColumns({m: F.round(m, 6) for m in POINT_METRICS})


@query("m6_ranking_metrics", f"""
select model_name, split, {rounded('roc_auc', 6)} as roc_auc, {rounded('pr_auc', 6)} as pr_auc
from metrics_by_model""")
def m6(t):
    return metrics.ranking_metrics(t.scored).withColumns({
        m: F.round(m, 6) for m in ("roc_auc", "pr_auc")
    })


@query("m7_focal_loss", f"""
select model_name, split,
  {rounded('avg(0.25 * pow(1 - exp(-bce), 2.0) * bce)', 6)} as focal_loss
from (select *, greatest(logit, 0) - logit * label + ln(1 + exp(-abs(logit))) as bce from scored)
group by model_name, split""")
def m7(t):
    return metrics.focal_loss(t.scored).withColumn("focal_loss", F.round("focal_loss", 6))


@query("m8_metrics_long", f"""
select 'run-9' as run_id, timestamp '2024-01-10' as trained_at, model_name, split, metric_name,
  {rounded('metric_value', 6)} as metric_value, n_rows, 12 as n_features
from ({long_metrics('metrics_by_model', 'model_name, split, n_rows')})""")
def m8(t):
    when = F.expr("timestamp_ntz'2024-01-10 00:00:00'")
    return metrics.metrics_long(t.scored, "run-9", when, 12).withColumn(
        "metric_value", F.round("metric_value", 6)
    )


@query("m9_health_report", """
select 'latest_quality' as section, layer || '.' || table_name as subject, run_id,
    pass_rate as value
  from (select * from dq_history order by checked_at desc, layer, table_name, run_id limit 20)
union all select 'weak_features', column_name, etl_run_id, null_rate from coverage_tiers
  where completeness_tier in ('sparse', 'mostly_missing')
union all select 'latest_models', model_name || '.' || split, run_id, roc_auc
  from (select * from model_performance order by trained_at desc, split, model_name limit 10)
union all select 'unhealthy_runs', layer || '.' || table_name, run_id, pass_rate
  from dq_history where not run_healthy""")
def m9(t):
    report = monitors.health_report(
        warehouse.dq_history(warehouse.stg_dq_results(t.dq_results)),
        warehouse.feature_coverage(t.staged_coverage),
        warehouse.model_performance(warehouse.stg_model_metrics(t.model_metrics)),
    )
    shapes = {
        "latest_quality": (("layer", "table_name"), "run_id", "pass_rate"),
        "weak_features": (("column_name",), "etl_run_id", "null_rate"),
        "latest_models": (("model_name", "split"), "run_id", "roc_auc"),
        "unhealthy_runs": (("layer", "table_name"), "run_id", "pass_rate"),
    }
    return reduce(DataFrame.unionByName, [
        report[section].select(
            F.lit(section).alias("section"), F.concat_ws(".", *subject).alias("subject"),
            F.col(run).alias("run_id"), F.col(value).alias("value"),
        )
        for section, (subject, run, value) in shapes.items()
    ])


@query("m10_compare_models", f"""
select split, metric_name, {rounded('a', 6)} as first_value, {rounded('b', 6)} as second_value,
  {rounded('b - a', 6)} as difference
from (select split, metric_name, max(metric_value) filter (where model_name = 'tabular') as a,
    max(metric_value) filter (where model_name = 'combined') as b
  from ({long_metrics('metrics_by_model', 'model_name, split')}) group by split, metric_name)""")
def m10(t):
    long = metrics.metrics_long(t.scored, "run-9")
    return metrics.compare_models(long, "tabular", "combined").withColumns({
        c: F.round(c, 6) for c in ("first_value", "second_value", "difference")
    })


@query("m11_table_profile", """
select count(*) as rows, 4 as features,
  (count(*) * 4 - count(click) - count(error) - count(purchase) - count(view))
    as missing_cells,
  count(*) filter (where label = 1) as positives, count(*) filter (where label = 0) as negatives
from user_mart""")
def m11(t):
    return metrics.table_profile(t.user_mart, LABS)


# -- preparation --------------------------------------------------------------

@query("p1_missing_indicators", f"""
select hadm_id, {', '.join(f'{rounded(f"coalesce({c}, 0)", 6)} as {c}' for c in LABS)},
  {', '.join(f'({c} is null)::int as {c}_missing' for c in LABS)}
from user_wide""")
def p1(t):
    return prep.missing_indicators(t.user_wide, LABS).withColumns({
        c: F.round(c, 6) for c in LABS
    })


def train_moments(column: str) -> str:
    return (f"avg({column}) filter (where split = 'train') as {column}_mean, "
            f"stddev_pop({column}) filter (where split = 'train') as {column}_sd")


def scaled(column: str) -> str:
    unit = f"case when {column}_sd = 0 then 1 else {column}_sd end"
    return f"{rounded(f'(m.{column} - {column}_mean) / {unit}', 6)} as {column}"


@query("p2_standardise", f"""
with moments as (select {', '.join(train_moments(c) for c in LABS)} from user_mart)
select hadm_id, split, {', '.join(scaled(c) for c in LABS)} from user_mart m, moments""")
def p2(t):
    rows = t.user_mart.select("hadm_id", "split", *LABS)
    return prep.standardise(rows, LABS, F.col("split") == "train").withColumns({
        c: F.round(c, 6) for c in LABS
    })


@query("p3_impute_median", f"""
with medians as (select {', '.join(
    f"quantile_cont({c}, 0.5) filter (where split = 'train') as {c}_mid" for c in LABS)}
  from user_mart)
select hadm_id, split, {', '.join(f'{rounded(f"coalesce(m.{c}, {c}_mid)", 6)} as {c}'
                                   for c in LABS)}
from user_mart m, medians""")
def p3(t):
    rows = t.user_mart.select("hadm_id", "split", *LABS)
    return prep.impute_median(rows, LABS, F.col("split") == "train").withColumns({
        c: F.round(c, 6) for c in LABS
    })


@query("p4_train_classifiers")
def p4(t):
    """Scored held-out rows of three classifiers, with the operator's own settings."""
    contract = warehouse.training_features(t.published(t.user_mart, "feature_mart"))
    return training.train_classifiers(contract)


@query("p5_best_model", """
select model_name, metric_value from (
  select model_name, coalesce(metric_value, 0) as metric_value from model_metrics
  where metric_name = 'roc_auc' and split = 'test')
order by metric_value desc, model_name desc limit 1""")
def p5(t):
    return metrics.best_model(t.model_metrics)


LEADS = ("avf", " I ", "V9", "avr")


def lead_signals(t) -> DataFrame:
    """Embeddings as four channels of 16 samples."""
    values = F.col("embedding")
    return t.load("embeddings").select(
        "vec_id", F.array(*[F.lit(n) for n in LEADS]).alias("names"),
        F.array(*[F.slice(values, 1 + 16 * i, 16) for i in range(4)]).alias("signal"),
    )


def z_sql(start: int) -> str:
    """One channel of the embedding, z-scored, as rounded text values."""
    part = f"list_transform(embedding[{start}:{start + 15}], lambda v: v::double)"
    return f"""list_transform({part}, lambda x: {rounded(
        f"((x - list_avg({part})) / (sqrt(list_var_pop({part})) + 1e-8))::float", 4)})"""


@query("p6_normalise_signal", f"""
select vec_id, lead, place, value from (
  select vec_id, lead, unnest(list) as value, unnest(range(1, 17))::int as place from (
    select vec_id, 'I' as lead, {z_sql(17)} as list from embeddings
    union all select vec_id, 'aVR', {z_sql(49)} from embeddings
    union all select vec_id, 'aVF', {z_sql(1)} from embeddings
    union all select vec_id, 'V1', list_transform(range(16), lambda i: 0.0::double)
      from embeddings))""")
def p6(t):
    leads = ("I", "aVR", "aVF", "V1")
    ready = signals.normalise_signal(lead_signals(t), "names", "signal", leads)
    one_per_lead = ready.select("vec_id", F.posexplode("normalised").alias("_lead", "_values"))
    return one_per_lead.select(
        "vec_id", F.get(F.array(*[F.lit(x) for x in leads]), F.col("_lead")).alias("lead"),
        F.posexplode("_values").alias("_place", "_value"),
    ).select("vec_id", "lead", (F.col("_place") + 1).alias("place"),
             (F.round(F.col("_value").cast("double"), 4) + 0.0).alias("value"))


@query("p7_resample_signal")
def p7(t):
    return signals.resample_signal(lead_signals(t), "signal", 24)


@query("p8_training_job_history", "select * from model_metrics")
def p8(t):
    """Five recorded runs, the last of them twice: its metrics stand there once."""
    home = Lake(fresh_path(t.spark, "lake"))
    scored = materialise(t.scored, "scored")
    for run in (0, 1, 2, 3, 4, 4):
        rows = scored.where(F.col("run") == run).drop("run")
        when = F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + interval {run} day")
        done = training_job.record_run(rows, home, f"run-{run}", n_features=12, trained_at=when)
    history = training_job.metric_history(t.spark, home, done.metrics)
    return history.withColumn("metric_value", F.round("metric_value", 6))
