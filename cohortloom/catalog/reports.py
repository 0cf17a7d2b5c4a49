"""Warehouse models, quality suites and assertions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.catalog.base import query
from cohortloom.catalog.sql import rounded
from cohortloom.operators import assertions as check
from cohortloom.operators.features import lab_features
from cohortloom.operators.quality import Suite, persist_results
from cohortloom.plans import contracts, warehouse
from cohortloom.plans.suites import bronze_suite, gold_suites, silver_suites
from cohortloom.rules import SURROGATE_NULL
from cohortloom.session import fresh_path

FEATURE_VALUES = ("feature_value", "mean_value")


def rounded_columns(df: DataFrame, names, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in names})


def replaced(*names: str, digits: int = 6) -> str:
    return "replace (" + ", ".join(f"{rounded(n, digits)} as {n}" for n in names) + ")"


# -- models -------------------------------------------------------------------

@query("w1_stg_cohort", "select * from staged_cohort")
def w1(t):
    return t.staged_cohort


@query("w2_stg_lab_features", f"select * {replaced(*FEATURE_VALUES)} from staged_features")
def w2(t):
    return rounded_columns(t.staged_features, FEATURE_VALUES)


@query("w3_stg_feature_mart", f"""
select * {replaced('click', 'error', 'purchase', 'view')}, 'run-1' as _run_id,
  'gold.feature_mart' as _source, timestamp '2024-02-01' as _loaded_at
from user_mart""")
def w3(t):
    mart = warehouse.stg_feature_mart(t.published(t.user_mart, "feature_mart"))
    return rounded_columns(mart, ("click", "error", "purchase", "view"))


@query("w4_stg_feature_coverage", "select * from staged_coverage")
def w4(t):
    return t.staged_coverage


@query("w5_stg_dq_results", "select * from staged_dq")
def w5(t):
    return warehouse.stg_dq_results(t.dq_results)


@query("w6_stg_model_metrics", """
select run_id, trained_at, model_name, split, metric_name, metric_value, n_rows, n_features
from model_metrics""")
def w6(t):
    return warehouse.stg_model_metrics(t.model_metrics)


@query("w7_int_cohort_lab_panel", f"select * {replaced('feature_value')} from panel")
def w7(t):
    return rounded_columns(t.panel, ["feature_value"])


@query("w8_dim_patient", """
select subject_id, gender, is_male, age_years, age_bucket,
  case when age_years < 45 then 'under_45' when age_years < 65 then '45_64'
    when age_years < 80 then '65_79' else '80_plus' end as age_group,
  race, insurance, label as has_angina, cohort_group, split, etl_run_id
from staged_cohort""")
def w8(t):
    return warehouse.dim_patient(t.staged_cohort)


@query("w9_fct_admission", f"""
with facts as (
  select hadm_id, 0 as lab, 0 as draws, false as acute, null::double as hours from staged_cohort
  union all
  select hadm_id, 1, measurement_count, is_acute_marker, first_measurement_hours from panel),
stays as (
  select hadm_id, sum(lab)::bigint as distinct_labs_measured, sum(draws)::bigint as total_lab_measurements,
    count_if(acute)::bigint as acute_markers_measured, min(hours) as first_lab_hours_from_admit,
    bool_or(lab = 1) as has_any_lab
  from facts group by hadm_id)
select stays.*, subject_id, label, cohort_group, split, admitted_at, discharged_at, length_of_stay_hours,
  {rounded('length_of_stay_hours / 24.0', 2)} as length_of_stay_days, admit_year, admission_type,
  died_in_hospital, etl_run_id
from stays join staged_cohort using (hadm_id)""")
def w9(t):
    return warehouse.fct_admission(t.staged_cohort, t.staged_features)


@query("w10_fct_lab_result", f"""
select md5(coalesce(hadm_id::varchar, '{SURROGATE_NULL}') || '-'
    || coalesce(lab_itemid::varchar, '{SURROGATE_NULL}')) as lab_result_key,
  hadm_id, subject_id, lab_itemid, lab_name, is_acute_marker, aggregation_rule,
  {rounded('feature_value', 6)} as feature_value, measurement_count, first_measurement_hours,
  label, cohort_group, split
from panel""")
def w10(t):
    return rounded_columns(warehouse.fct_lab_result(t.panel), ["feature_value"])


@query("w11_training_features",
       f"select * {replaced('click', 'error', 'purchase', 'view')} from training_features")
def w11(t):
    contract = warehouse.training_features(t.published(t.user_mart, "feature_mart"))
    return rounded_columns(contract, ("click", "error", "purchase", "view"))


@query("w12_cohort_summary", f"""
select cohort_group, split, count(*) as patients, {rounded('avg(age_years)', 1)} as mean_age,
  quantile_cont(age_years, 0.5)::double as median_age,
  {rounded('avg(is_male)', 3)} as male_share,
  {rounded('avg(length_of_stay_hours)', 1)} as mean_los_hours,
  {rounded('avg(case when died_in_hospital then 1 else 0 end)', 4)} as in_hospital_mortality,
  min(admitted_at) as earliest_admission, max(admitted_at) as latest_admission
from staged_cohort group by cohort_group, split""")
def w12(t):
    return warehouse.cohort_summary(t.staged_cohort)


PROFILE_VALUES = ("angina_mean", "control_mean", "angina_median", "control_median", "angina_sd",
                  "control_sd", "mean_difference")


def profile_side(group: str, side: str) -> str:
    """One side of the profile: a row per lab from the rows of one cohort group."""
    return f"""{side} as (select lab_name, is_acute_marker, aggregation_rule,
  count(*) as admissions, avg(feature_value) as mean, median(feature_value) as median,
  stddev_samp(feature_value) as sd from panel where cohort_group = '{group}' group by all)"""


@query("w13_lab_profile", f"""
with {profile_side('angina', 'ill')}, {profile_side('control', 'well')},
profiled as (select distinct lab_name, is_acute_marker, aggregation_rule from panel)
select profiled.*, ill.admissions as angina_admissions, well.admissions as control_admissions,
  {', '.join(f"{rounded(f'{t}.{c}', 6)} as {side}_{c}" for c in ('mean', 'median', 'sd')
             for t, side in (('ill', 'angina'), ('well', 'control')))},
  {rounded('ill.mean - well.mean', 6)} as mean_difference,
  {rounded("""(ill.mean - well.mean) / nullif(sqrt(
    (pow(ifnull(ill.sd, 0), 2) + pow(ifnull(well.sd, 0), 2)) / 2.0), 0)""", 3)} as cohens_d
from profiled left join ill using (lab_name, is_acute_marker, aggregation_rule)
left join well using (lab_name, is_acute_marker, aggregation_rule)""")
def w13(t):
    return rounded_columns(warehouse.lab_profile(t.panel), PROFILE_VALUES)


@query("w14_feature_coverage", "select * from coverage_tiers")
def w14(t):
    return warehouse.feature_coverage(t.staged_coverage)


@query("w15_dq_history", "select * from dq_history")
def w15(t):
    return warehouse.dq_history(warehouse.stg_dq_results(t.dq_results))


@query("w16_model_performance",
       f"select * {replaced('roc_auc_change_vs_previous_run')} from model_performance")
def w16(t):
    return rounded_columns(
        warehouse.model_performance(warehouse.stg_model_metrics(t.model_metrics)),
        ["roc_auc_change_vs_previous_run"],
    )


# -- quality ------------------------------------------------------------------

def outcome(name: str, severity: str, observed: str, rule: str, threshold: float, source: str
            ) -> str:
    """SQL of one check: its observed value, and whether the rule holds for it."""
    return f"""
select '{name}' as check_name, '{severity}' as severity, coalesce({rule}, false) as passed,
  {rounded('observed', 6)} as observed, {threshold}::double as threshold, row_count
from (select {observed} as observed, count(*) as row_count from {source})"""


def none(name: str, violation: str, source: str, severity: str = "error") -> str:
    return outcome(name, severity, f"count(*) filter (where {violation})", "observed = 0", 0,
                   source)


def repeats(name: str, keys: str, source: str) -> str:
    counted = f"(select {keys}, count(*) as n from {source} group by {keys})"
    return f"""
select '{name}' as check_name, 'error' as severity, coalesce(sum(n - 1), 0) = 0 as passed,
  coalesce(sum(n - 1), 0)::double as observed, 0.0::double as threshold,
  coalesce(sum(n), 0)::bigint as row_count
from {counted}"""


def every(*parts: str) -> str:
    return " union all ".join(parts)


@query("q1_row_count_between", every(
    outcome("row_count_between_100_inf", "error", "count(*)", "observed >= 100", 100, "orders"),
    outcome("row_count_between_0_0", "warn", "count(*)", "observed between 0 and 0", 0,
            "orders")))
def q1(t):
    suite = Suite("raw", "orders").row_count_between(100).row_count_between(0, 0, "warn")
    return t.suite_rows(suite, t.load("orders"))


@query("q2_not_null", every(
    none("not_null__dischtime", "dischtime is null", "raw_admissions"),
    none("not_null__hadm_id", "hadm_id is null", "raw_admissions")))
def q2(t):
    suite = Suite("raw", "admissions").not_null("dischtime").not_null("hadm_id")
    return t.suite_rows(suite, t.raw_admissions)


@query("q3_unique", every(
    repeats("unique__hadm_id", "hadm_id", "raw_admissions"),
    repeats("unique__hadm_id_dischtime", "hadm_id, dischtime", "raw_admissions")))
def q3(t):
    suite = Suite("raw", "admissions").unique(["hadm_id"]).unique(["hadm_id", "dischtime"])
    return t.suite_rows(suite, t.raw_admissions)


@query("q4_values_in", every(
    none("values_in__gender", "gender not in ('m', 'MALE')", "raw_patients", "warn"),
    none("values_in__anchor_year_group", "anchor_year_group not in "
         "('group 0', 'group 1', 'group 2', 'group 3', 'group 4')", "raw_patients")))
def q4(t):
    suite = Suite("raw", "patients").values_in("gender", ["m", "MALE"], "warn").values_in(
        "anchor_year_group", [f"group {i}" for i in range(5)]
    )
    return t.suite_rows(suite, t.raw_patients)


@query("q5_between", every(
    none("between__anchor_age", "anchor_age not between 0 and 90", "raw_patients"),
    none("between__anchor_year", "anchor_year not between 2100 and 2200", "raw_patients")))
def q5(t):
    suite = Suite("raw", "patients").between("anchor_age", 0, 90).between(
        "anchor_year", 2100, 2200
    )
    return t.suite_rows(suite, t.raw_patients)


def null_share(column: str, limit: float, source: str, severity: str = "warn") -> str:
    return outcome(f"null_rate__{column}", severity,
                   f"count(*) filter (where {column} is null) / count(*)",
                   f"observed <= {limit}", limit, source)


@query("q6_null_rate_below", every(
    null_share("dischtime", 0.4, "raw_admissions"),
    null_share("hospital_expire_flag", 0.5, "raw_admissions", "error")))
def q6(t):
    suite = Suite("raw", "admissions").null_rate_below("dischtime", 0.4).null_rate_below(
        "hospital_expire_flag", 0.5, "error"
    )
    return t.suite_rows(suite, t.raw_admissions)


def balance(column: str, low: float, high: float, source: str) -> str:
    return outcome(f"class_balance__{column}", "warn",
                   f"count(*) filter (where {column} = 1) / count(*)",
                   f"observed between {low} and {high}", low, source)


@query("q7_class_balance", every(
    balance("quality", 0.2, 0.8, "labels"), balance("toxic", 0.2, 0.8, "labels")))
def q7(t):
    suite = Suite("raw", "labels").class_balance("quality", 0.2, 0.8).class_balance(
        "toxic", 0.2, 0.8
    )
    return t.suite_rows(suite, t.load("labels"))


@query("q8_custom", every(
    none("ends_before_start", "dischtime < admittime", "raw_admissions"),
    """select 'one_place_per_subject' as check_name, 'error' as severity, sum(n - 1) = 0 as passed,
  sum(n - 1)::double as observed, 0.0::double as threshold, sum(n)::bigint as row_count
from (select subject_id, count(*) as n from raw_admissions group by subject_id)"""))
def q8(t):
    from cohortloom.operators.quality import one_split_per_subject

    suite = (
        Suite("raw", "admissions")
        .custom("ends_before_start", F.count_if(F.col("dischtime") < F.col("admittime")))
        .custom("one_place_per_subject", one_split_per_subject)
    )
    return t.suite_rows(suite, t.raw_admissions)


RAW_SUITE = (
    outcome("row_count_between_1_inf", "error", "count(*)", "observed >= 1", 1, "raw_labs"),
    none("not_null__valuenum", "valuenum is null", "raw_labs", "warn"),
    none("between__valuenum", "valuenum not between 0 and 50000", "raw_labs", "warn"),
    none("values_in__flag", "flag not in ('O', 'F')", "raw_labs"),
    null_share("valuenum", 0.2, "raw_labs"),
    repeats("unique__hadm_id_itemid", "hadm_id, itemid", "raw_labs"),
)


def raw_suite() -> Suite:
    return (
        Suite("bronze", "labs").row_count_between(1).not_null("valuenum", "warn")
        .between("valuenum", 0, 50000, "warn").values_in("flag", ["O", "F"])
        .null_rate_below("valuenum", 0.2).unique(["hadm_id", "itemid"])
    )


@query("q9_suite_run", every(*RAW_SUITE))
def q9(t):
    return t.suite_rows(raw_suite(), t.raw_labs)


@query("q10_persist_results", f"""
select 'bronze' as layer, 'labs' as table_name, 'run-1' as run_id, check_name, severity,
  case when passed then 'true' else 'false' end as passed, observed, threshold, row_count
from ({every(*RAW_SUITE)})""")
def q10(t):
    path = fresh_path(t.spark, "dq")
    persist_results(raw_suite().results(t.raw_labs, "run-1"), path)
    return t.spark.read.parquet(path).select(
        "layer", "table_name", "run_id", "check_name", "severity", "passed",
        F.round("observed", 6).alias("observed"), "threshold", "row_count",
    )


def labelled(table: str, *parts: str) -> str:
    return f"select '{table}' as table_name, * from ({every(*parts)})"


def suites_over(t, pairs) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        t.suite_rows(suite, df).withColumn("table_name", F.lit(suite.table)) for suite, df in pairs
    ])


def floor_of(n: int, source: str) -> str:
    return outcome(f"row_count_between_{n}_inf", "error", "count(*)", f"observed >= {n}", n, source)


@query("q11_bronze_suites", every(
    labelled("patients", floor_of(10, "raw_patients"),
             none("not_null__subject_id", "subject_id is null", "raw_patients")),
    labelled("admissions", floor_of(10, "raw_admissions"),
             none("not_null__subject_id", "subject_id is null", "raw_admissions"),
             none("not_null__hadm_id", "hadm_id is null", "raw_admissions")),
    labelled("diagnoses_icd", floor_of(10, "raw_diagnoses"),
             none("not_null__subject_id", "subject_id is null", "raw_diagnoses")),
    labelled("d_labitems", floor_of(5, "raw_dictionary"),
             none("not_null__itemid", "itemid is null", "raw_dictionary"),
             repeats("unique__itemid", "itemid", "raw_dictionary")),
    labelled("labevents", floor_of(10, "user_draws"),
             none("not_null__subject_id", "subject_id is null", "user_draws", "warn"),
             none("not_null__itemid", "itemid is null", "user_draws", "warn")),
    labelled("chartevents", floor_of(0, "user_draws")),
    labelled("ecg_record_list", floor_of(0, "user_points"),
             none("not_null__subject_id", "subject_id is null", "user_points"),
             none("not_null__study_id", "study_id is null", "user_points"))))
def q11(t):
    frames = {
        "patients": t.raw_patients, "admissions": t.raw_admissions,
        "diagnoses_icd": t.raw_diagnoses, "d_labitems": t.raw_dictionary,
        "labevents": t.user_draws, "chartevents": t.user_draws, "ecg_record_list": t.user_points,
    }
    return suites_over(t, [(bronze_suite(name), df) for name, df in frames.items()])


@query("q12_silver_suites", every(
    labelled("patients", repeats("unique__subject_id", "subject_id", "patients"),
             none("not_null__subject_id", "subject_id is null", "patients"),
             none("values_in__gender", "gender not in ('M', 'F')", "patients", "warn"),
             none("between__anchor_age", "anchor_age not between 0 and 120", "patients")),
    labelled("admissions", repeats("unique__hadm_id", "hadm_id", "admissions"),
             none("not_null__admittime", "admittime is null", "admissions"),
             none("between__los_hours", "los_hours not between 0 and 8760", "admissions")),
    labelled("diagnoses", none("not_null__icd_code", "icd_code is null", "diagnoses"),
             repeats("unique__subject_id_hadm_id_icd_code_icd_version",
                     "subject_id, hadm_id, icd_code, icd_version", "diagnoses")),
    labelled("labevents", floor_of(1, "labs"),
             none("not_null__hadm_id", "hadm_id is null", "labs"),
             none("not_null__valuenum", "valuenum is null", "labs"),
             none("labs_within_admission_window", "hours_from_admit < 0", "labs")),
    labelled("ecg_records", repeats("unique__hadm_id", "hadm_id", "user_matches"))))
def q12(t):
    frames = {"patients": t.patients, "admissions": t.admissions, "diagnoses": t.diagnoses,
              "labevents": t.labs, "ecg_records": t.user_matches}
    return suites_over(t, [(s, frames[name]) for name, s in silver_suites().items()])


@query("q13_gold_suites", every(
    labelled("cohort", floor_of(2, "cohort"), repeats("unique__subject_id", "subject_id", "cohort"),
             repeats("unique__hadm_id", "hadm_id", "cohort"),
             none("not_null__label", "label is null", "cohort"),
             none("values_in__label", "label not in (0, 1)", "cohort"),
             none("values_in__split", "split not in ('train', 'validation', 'test')", "cohort"),
             none("between__anchor_age", "anchor_age not between 18 and 120", "cohort"),
             balance("label", 0.2, 0.8, "cohort"),
             repeats("no_patient_across_splits", "subject_id", "cohort")),
    labelled("lab_features", none("not_null__hadm_id", "hadm_id is null", "user_features"),
             repeats("unique__hadm_id_itemid", "hadm_id, itemid", "user_features"),
             none("values_in__aggregation", "aggregation not in ('first', 'mean')",
                  "user_features")),
    labelled("feature_mart", repeats("unique__hadm_id", "hadm_id", "user_mart"),
             none("not_null__label", "label is null", "user_mart"),
             balance("label", 0.2, 0.8, "user_mart"),
             null_share("age", 0.0, "user_mart", "error"))))
def q13(t):
    frames = {"cohort": t.cohort, "lab_features": lab_features(t.user_labs),
              "feature_mart": t.user_mart}
    return suites_over(t, [(s, frames[name]) for name, s in gold_suites().items()])


# -- assertions ---------------------------------------------------------------

@query("t1_not_null", """
select hadm_id, seq_num, icd_code from raw_diagnoses where icd_version is null""")
def t1(t):
    return check.is_null(t.raw_diagnoses, "icd_version").select("hadm_id", "seq_num", "icd_code")


@query("t2_unique", """
select hadm_id, count(*) as n_records from raw_admissions where hadm_id is not null
group by hadm_id having count(*) > 1""")
def t2(t):
    return check.repeated_values(t.raw_admissions, "hadm_id")


@query("t3_accepted_values", """
select gender as value_field, count(*) as n_records from raw_patients
where gender not in ('m', 'MALE') group by gender""")
def t3(t):
    return check.unexpected_values(t.raw_patients, "gender", ["m", "MALE"])


@query("t4_relationships", """
select hadm_id, itemid from raw_labs where hadm_id is not null
  and hadm_id not in (select hadm_id from admissions)""")
def t4(t):
    return check.orphans(
        t.raw_labs.select("hadm_id", "itemid"), "hadm_id", t.admissions, "hadm_id"
    )


@query("t5_accepted_range", """
select subject_id, anchor_age, anchor_year from raw_patients
where anchor_age < 18 or anchor_age > 95""")
def t5(t):
    return check.outside_range(t.raw_patients, "anchor_age", 18, 95).select(
        "subject_id", "anchor_age", "anchor_year"
    )


@query("t6_unique_combination", """
select hadm_id, itemid, count(*) as n_records from raw_labs
group by hadm_id, itemid having count(*) > 1""")
def t6(t):
    return check.repeated_combinations(t.raw_labs, ["hadm_id", "itemid"])


@query("t7_source_freshness", f"""
select max(ts) as max_loaded_at,
  {rounded("(1706745600 - (epoch_us(max(ts)) // 1000000)) / 3600.0", 3)} as age_hours,
  case when (1706745600 - (epoch_us(max(ts)) // 1000000)) / 3600.0 > 72 then 'error'
    when (1706745600 - (epoch_us(max(ts)) // 1000000)) / 3600.0 > 26 then 'warn'
    else 'pass' end as status
from events""")
def t7(t):
    now = F.expr("timestamp_ntz'2024-02-01 00:00:00'")
    return check.freshness(t.load("events"), now, "ts")


@query("t8_class_balance", f"""
select count(*) as total_rows, {rounded('avg(toxic)', 6)} as positive_share from labels
having count(*) < 100 or avg(toxic) < 0.2 or avg(toxic) > 0.8""")
def t8(t):
    return check.class_balance(t.load("labels"), "toxic")


@query("t9_every_split_has_both_classes", """
select split, count(*) filter (where label = 1) as positives,
  count(*) filter (where label = 0) as negatives
from (select *, (o_orderstatus = 'F')::int as label,
    case when o_orderstatus = 'O' then 'test' else 'train' end as split from orders)
group by split having positives = 0 or negatives = 0""")
def t9(t):
    rows = t.load("orders").select(
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.when(F.col("o_orderstatus") == "O", "test").otherwise("train").alias("split"),
    )
    return check.one_class_splits(rows)


@query("t10_feature_within_range", f"""
select hadm_id, lab_name, {rounded('feature_value', 6)} as feature_value, min_value, max_value
from (select * replace (mean_value + case when lab_name = 'view' then max_value else 0 end
    as feature_value) from staged_features)
where feature_value is not null
  and (feature_value < min_value - 1e-9 or feature_value > max_value + 1e-9)""")
def t10(t):
    """One lab is spoilt on purpose so that the assertion has something to find."""
    spoilt = t.staged_features.withColumn(
        "feature_value", F.col("mean_value")
        + F.when(F.col("lab_name") == "view", F.col("max_value")).otherwise(0.0)
    )
    return rounded_columns(check.feature_outside_measured_range(spoilt), ["feature_value"])


@query("t11_aggregation_rule", """
select lab_name, is_acute_marker, 'first' as aggregation_rule, count(*) as offending_rows
from staged_features where not is_acute_marker group by lab_name, is_acute_marker""")
def t11(t):
    return check.wrong_aggregation_rule(
        t.staged_features.withColumn("aggregation_rule", F.lit("first"))
    )


@query("t12_stay_window", """
select hadm_id, admittime as admitted_at, dischtime as discharged_at,
  ((epoch_us(dischtime) // 1000000) - (epoch_us(admittime) // 1000000)) / 3600.0
    as length_of_stay_hours
from raw_admissions where dischtime < admittime""")
def t12(t):
    raw = t.raw_admissions.select(
        "hadm_id", F.col("admittime").alias("admitted_at"),
        F.col("dischtime").alias("discharged_at"),
        ((F.col("dischtime").cast("timestamp").cast("long")
          - F.col("admittime").cast("timestamp").cast("long")) / 3600.0)
        .alias("length_of_stay_hours"),
    )
    return check.stays_outside_window(raw)


@query("t13_no_blocking_failure", """
select layer, table_name, check_name, details from staged_dq
where severity = 'error' and not passed
  and run_id = (select max(run_id) from staged_dq
    where checked_at = (select max(checked_at) from staged_dq))""")
def t13(t):
    return check.blocking_failures_in_latest_run(warehouse.stg_dq_results(t.dq_results))


@query("t14_no_subject_across_splits", """
select o_custkey as subject_id, count(distinct o_orderstatus) as splits_present from orders
group by o_custkey having count(distinct o_orderstatus) > 1""")
def t14(t):
    rows = t.load("orders").select(F.col("o_custkey").alias("subject_id"),
                                   F.col("o_orderstatus").alias("split"))
    return check.subjects_across_splits(rows)


@query("t15_features_not_imputed", """
select column_name, 'lab_feature' as column_kind, null_rate from user_coverage
where null_rate = 0""")
def t15(t):
    every_column = t.user_coverage.withColumn("column_kind", F.lit("lab_feature"))
    return check.imputed_features(every_column)


# -- declared contracts ---------------------------------------------------------

def offenders(model: str, assertion: str, rows: str, severity: str = "error") -> str:
    return f"""select '{model}' as model, '{assertion}' as assertion, '{severity}' as severity,
  (select count(*) from ({rows})) as offenders"""


def missing(model: str, source: str, *columns: str) -> list[str]:
    return [offenders(model, f"not_null__{c}", f"select 1 from {source} where {c} is null") for c in columns]


def repeated(model: str, source: str, *columns: str) -> str:
    keys = ", ".join(columns)
    return offenders(model, f"unique__{'_'.join(columns)}",
                     f"select {keys} from {source} where {columns[0]} is not null group by {keys} having count(*) > 1")


def foreign(model: str, source: str, column: str, parent: str, parent_source: str) -> str:
    return offenders(model, f"relationships__{column}__{parent}", f"""select 1 from {source}
  where {column} is not null and {column} not in (select {column} from {parent_source})""")


TRAINING, COVERAGE = "mart_angina_training_features", "analytics_feature_coverage"
CONTRACTS = [
    *missing("dim_patient", "staged_cohort", "subject_id"),
    repeated("dim_patient", "staged_cohort", "subject_id"),
    offenders("dim_patient", "accepted_values__age_group", "select 1 where false"),
    offenders("dim_patient", "accepted_values__has_angina", "select 1 from staged_cohort where label not in (0, 1)"),
    *missing("fct_admission", "staged_cohort", "hadm_id", "subject_id"),
    repeated("fct_admission", "staged_cohort", "hadm_id"),
    foreign("fct_admission", "staged_cohort", "subject_id", "dim_patient", "staged_cohort"),
    offenders("fct_admission", "accepted_range__length_of_stay_days",
              "select 1 from staged_cohort where length_of_stay_hours <= -0.12"),
    offenders("fct_admission", "accepted_range__total_lab_measurements",
              "select hadm_id from staged_features group by 1 having sum(measurement_count) < 0"),
    repeated("fct_lab_result", "panel", "hadm_id", "lab_itemid"),
    offenders("fct_lab_result", "not_null__lab_result_key", "select 1 where false"),
    offenders("fct_lab_result", "unique__lab_result_key",
              "select hadm_id, lab_itemid from panel group by all having count(*) > 1"),
    foreign("fct_lab_result", "panel", "hadm_id", "fct_admission", "staged_cohort"),
    offenders("fct_lab_result", "aggregation_rule_matches_marker", """select distinct lab_name, is_acute_marker
  from panel where aggregation_rule <> if(is_acute_marker, 'first', 'mean')"""),
    *missing(TRAINING, "training_features", "hadm_id", "subject_id", "label", "split", "age"),
    repeated(TRAINING, "training_features", "hadm_id"),
    repeated(TRAINING, "training_features", "subject_id"),
    offenders(TRAINING, "accepted_values__label", "select 1 from training_features where label not in (0, 1)"),
    offenders(TRAINING, "accepted_values__split",
              "select 1 from training_features where split not in ('train', 'validation', 'test')"),
    offenders(TRAINING, "accepted_range__age", "select 1 from training_features where age < 18 or age > 120"),
    offenders(TRAINING, "class_balance", """select 1 from (select count(*) as n, avg(label) as share
  from training_features) where n < 100 or share < 0.2 or share > 0.8""", "warn"),
    offenders(TRAINING, "every_split_has_both_classes", """select split from training_features group by split
  having count(*) filter (where label = 1) = 0 or count(*) filter (where label = 0) = 0"""),
    offenders(TRAINING, "no_subject_across_splits", """select subject_id from training_features
  group by subject_id having count(distinct split) > 1"""),
    offenders(COVERAGE, "accepted_values__completeness_tier", "select 1 where false"),
    offenders(COVERAGE, "features_not_imputed",
              "select 1 from staged_coverage where column_kind = 'lab_feature' and null_rate = 0"),
    offenders("analytics_lab_profile_by_cohort", "not_null__lab_name", "select 1 from panel where lab_name is null"),
]


def published_models(t):
    return {
        "dim_patient": warehouse.dim_patient(t.staged_cohort),
        "fct_admission": warehouse.fct_admission(t.staged_cohort, t.staged_features),
        "fct_lab_result": warehouse.fct_lab_result(t.panel),
        "analytics_lab_profile_by_cohort": warehouse.lab_profile(t.panel),
        TRAINING: warehouse.training_features(warehouse.stg_feature_mart(
            t.published(t.user_mart, "feature_mart"))),
        COVERAGE: warehouse.feature_coverage(t.staged_coverage),
    }


@query("t16_declared_contracts", "select *, offenders = 0 as passed from ("
       + "\nunion all ".join(CONTRACTS) + ")")
def t16(t):
    """Offending rows of every declared assertion on the published models."""
    return contracts.outcomes(published_models(t))
