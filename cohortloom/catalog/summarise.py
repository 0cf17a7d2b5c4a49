"""Aggregations, sampling, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.catalog.base import query
from cohortloom.catalog.sql import MART_COLUMNS, ordinal, rounded, split_of
from cohortloom.functions.columns import conditional_count, conditional_max, sample_sd
from cohortloom.operators import cohort as co
from cohortloom.operators import features, monitors, ranking, rolling
from cohortloom.plans import warehouse

MEASURED = """hadm_id, itemid, label, is_acute_marker, first_value, max_value, min_value,
  measurement_count, first_measurement_hours"""


@query("a1_aggregate_measurements", f"""
select {MEASURED}, {rounded('mean_value', 6)} as mean_value from user_features""")
def a1(t):
    return features.aggregate_measurements(t.user_labs).withColumn(
        "mean_value", F.round("mean_value", 6)
    )


@query("a1_measurements_of_orders", f"""
select hadm_id, itemid, label, is_acute_marker,
  arg_min(valuenum, (charttime, valuenum)) as first_value,
  {rounded('avg(valuenum)', 6)} as mean_value, max(valuenum) as max_value,
  min(valuenum) as min_value, count(*)::int as measurement_count,
  min(hours_from_admit) as first_measurement_hours
from labs group by hadm_id, itemid, label, is_acute_marker""")
def a1_orders(t):
    return features.aggregate_measurements(t.labs).withColumn(
        "mean_value", F.round("mean_value", 6)
    )


@query("a2_promote_by_kind", f"""
select hadm_id, itemid, label, aggregation, {rounded('feature_value', 6)} as feature_value
from user_features""")
def a2(t):
    return t.user_features.select("hadm_id", "itemid", "label", "aggregation",
                                  F.round("feature_value", 6).alias("feature_value"))


WIDE = ", ".join(f"{rounded(c, 6)} as {c}" for c in ("click", "error", "purchase", "view"))


@query("a3_pivot_features", f"select hadm_id, {WIDE} from user_wide")
def a3(t):
    wide = t.user_wide
    return wide.select("hadm_id", *[F.round(c, 6).alias(c) for c in wide.columns[1:]])


@query("a4_coverage_filter", f"""
with stays as (select count(distinct hadm_id) as n from user_features)
select label, stays, n as all_stays, {rounded('stays / n', 6)} as coverage
from (select label, count(distinct hadm_id) filter (where feature_value is not null) as stays
  from user_features group by label), stays
where stays / n >= 0.55""")
def a4(t):
    return features.coverage_filter(t.user_features, 0.55).withColumn(
        "coverage", F.round("coverage", 6)
    )


@query("a5_coverage_report", "select * from user_coverage")
def a5(t):
    return t.user_coverage


@query("a6_distinct_keys", """
select distinct subject_id from raw_diagnoses where icd_version = 10""")
def a6(t):
    return co.distinct_keys(t.raw_diagnoses, "subject_id", F.col("icd_version") == 10)


@query("a7_first_per_group", """
select subject_id, hadm_id, admittime from admissions
qualify row_number() over (partition by subject_id order by admittime, hadm_id) = 1""")
def a7(t):
    return ranking.first_per_group(
        t.admissions.select("subject_id", "hadm_id", "admittime"), "subject_id",
        ["admittime", "hadm_id"],
    )


@query("a8_assign_split", f"""
select c_custkey, split_bucket, {split_of('split_bucket')} as split
from (select c_custkey, ({ordinal('angina-v1', 'c_custkey')} % 100)::int as split_bucket
  from customer)""")
def a8(t):
    return co.assign_split(t.load("customer").select("c_custkey"), "c_custkey", mode="md5")


@query("a8_assign_split_murmur3")
def a8_murmur(t):
    """Spark's own hash has no twin outside Spark: tested for stability instead."""
    return co.assign_split(t.load("customer").select("c_custkey"), "c_custkey")


@query("a9_hash_sample", f"""
select c_custkey, c_acctbal from customer
qualify row_number() over (order by {ordinal('ctl', 'c_custkey')}, c_custkey)
  <= (select count(*) from customer where c_mktsegment = 'BUILDING')""")
def a9(t):
    customers = t.load("customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    keep = customers.where("c_mktsegment = 'BUILDING'").agg(
        F.count(F.lit(1)).alias("n")
    ).scalar()
    return ranking.hash_sample(
        customers.drop("c_mktsegment"), keep, "c_custkey", "ctl", "md5"
    )


@query("a10_stratified_split", f"""
select o_orderkey, o_orderstatus,
  case when r <= ceil(n * 0.2::double) then 'test'
    when r <= ceil(n * 0.2::double) + ceil((n - ceil(n * 0.2::double)) * 0.1::double)
      then 'validation'
    else 'train' end as split
from (select o_orderkey, o_orderstatus, count(*) over (partition by o_orderstatus) as n,
    row_number() over (partition by o_orderstatus
      order by {ordinal('42', 'o_orderkey')}, o_orderkey) as r
  from orders)""")
def a10(t):
    return co.stratified_split(
        t.load("orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey"
    )


COHORT = """
select subject_id, hadm_id, label, gender, anchor_age, admittime, dischtime, los_hours,
  admit_year, admission_type, insurance, race, died_in_hospital, split, split_bucket from """


@query("a11_build_cohort", COHORT + "cohort")
def a11(t):
    return t.cohort_plan


@query("a11_build_cohort_of_users", COHORT + "user_cohort")
def a11_users(t):
    return t.user_cohort_plan


MART_SQL = ", ".join(
    f"{rounded(c, 6)} as {c}" if c in ("click", "error", "purchase", "view") else c
    for c in MART_COLUMNS
)


@query("a12_build_feature_mart", f"""
select subject_id, hadm_id, label, split, {MART_SQL} from user_mart""")
def a12(t):
    return t.user_mart_plan.withColumns({
        c: F.round(c, 6) for c in ("click", "error", "purchase", "view")
    })


@query("a13_conditional_aggregates", f"""
select l_returnflag, count(*) filter (where l_linestatus = 'F') as finished,
  max(l_quantity) filter (where l_linestatus = 'O') as largest_open,
  {rounded('quantile_cont(l_extendedprice, 0.5)', 6)} as median_price,
  {rounded('stddev_samp(l_discount)', 6)} as sd_discount
from lineitem group by l_returnflag""")
def a13(t):
    lines = t.load("lineitem")
    flags = lines.groupBy("l_returnflag").agg(
        conditional_count(F.col("l_linestatus") == "F").alias("finished"),
        conditional_max("l_quantity", F.col("l_linestatus") == "O").alias("largest_open"),
        F.round(sample_sd("l_discount"), 6).alias("sd_discount"),
    )
    medians = ranking.exact_quantile(lines, ["l_returnflag"], "l_extendedprice").select(
        "l_returnflag", F.round("quantile", 6).alias("median_price")
    )
    return flags.join(medians, "l_returnflag")


@query("n2_first_value", """
select hadm_id, itemid, arg_min(valuenum, (charttime, valuenum)) as first_value,
  min(charttime) as first_time
from user_labs group by hadm_id, itemid""")
def n2(t):
    return t.user_labs.groupBy("hadm_id", "itemid").agg(
        F.min_by("valuenum", F.struct("charttime", "valuenum")).alias("first_value"),
        F.min("charttime").alias("first_time"),
    )


@query("n3_global_hash_rank", f"""
select c_custkey, row_number() over (order by {ordinal('ctl', 'c_custkey')}, c_custkey) as rank
from customer""")
def n3(t):
    customers = t.load("customer").select("c_custkey")
    ranked = ranking.binned_rank(
        customers, [], ranking.hash_ordinal("c_custkey", "ctl", "md5"), ["c_custkey"]
    )
    return ranked.select("c_custkey", "rank")


@query("n4_run_ranks", """
select _run_id, dense_rank() over (order by _run_id desc)::int as run_rank
from (select distinct _run_id from coverage_history)""")
def n4(t):
    return monitors.run_ranks(t.coverage_history)


@query("n5_lag_of_metric", f"""
select run_id, model_name, split,
  {rounded('roc_auc_change_vs_previous_run', 6)} as change from model_performance""")
def n5(t):
    return warehouse.model_performance(warehouse.stg_model_metrics(t.model_metrics)).select(
        "run_id", "model_name", "split",
        F.round("roc_auc_change_vs_previous_run", 6).alias("change"),
    )


@query("n6_report_order", """
select admission_type, los_hours, subject_id, hadm_id from admissions
order by los_hours desc nulls last, admission_type, hadm_id""")
def n6(t):
    return t.admissions.select("admission_type", "los_hours", "subject_id", "hadm_id").orderBy(
        F.col("los_hours").desc_nulls_last(), F.col("admission_type").asc_nulls_last(), "hadm_id"
    )


@query("n7_newest_rows", """
select hadm_id, admittime from admissions order by admittime desc, hadm_id limit 50""")
def n7(t):
    return t.admissions.select("hadm_id", "admittime").orderBy(
        F.col("admittime").desc(), "hadm_id"
    ).limit(50)


@query("n8_union_by_name", """
select subject_id, hadm_id, 1 as label from admissions
  where hadm_id in (select hadm_id from diagnoses where is_angina)
union all select subject_id, hadm_id, 0 from admissions
  where subject_id not in (select subject_id from diagnoses where is_circulatory)""")
def n8(t):
    cases = co.case_stays(t.admissions, t.diagnoses).select(
        "subject_id", "hadm_id", F.lit(1).alias("label")
    )
    controls = co.unexposed_subjects(t.admissions, t.diagnoses).select(
        F.lit(0).alias("label"), "hadm_id", "subject_id"
    )
    return cases.unionByName(controls)


@query("n9_unique_keys", """
select hadm_id, itemid, charttime, min(valuenum) as valuenum from raw_labs
where valuenum is not null group by hadm_id, itemid, charttime""")
def n9(t):
    rows = t.raw_labs.where("valuenum is not null").select(
        "hadm_id", "itemid", "charttime", "valuenum"
    )
    return ranking.keep_first(rows, ["hadm_id", "itemid", "charttime"])


@query("n10_rolling_measures", f"""
select event_id, hadm_id, n_in_span, {rounded('mean', 6)} as mean_in_span,
  {rounded('if(isnan(slope), null, slope)', 6)} as slope_in_span
from (select event_id, hadm_id, count(valuenum) over w as n_in_span, avg(valuenum) over w as mean,
    regr_slope(valuenum, hours_from_admit) over w as slope
  from user_labs window w as (partition by hadm_id order by charttime
    range between interval 48 hours preceding and current row))""")
def n10(t):
    """Number, mean and slope of the last 48 hours of a stay, at each measurement."""
    rows = t.user_labs.select("event_id", "hadm_id", "charttime", "valuenum", "hours_from_admit")
    found = rolling.rolling(rows, rolling.trend("valuenum", "hours_from_admit"), by="hadm_id",
                            at="charttime", seconds=48 * 3600)
    return found.select("event_id", "hadm_id", "n_in_span", F.round("mean_in_span", 6).alias("mean_in_span"),
                        F.round("slope_in_span", 6).alias("slope_in_span"))
