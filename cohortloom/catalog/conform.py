"""Cleaning rules, one by one and composed per entity."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.catalog.base import query
from cohortloom.catalog.sql import NAMES_OF_LABEL, hours, label_core, rounded
from cohortloom.catalog.tables import ORDER_RULES
from cohortloom.functions import columns as fn
from cohortloom.operators import cleaning, features
from cohortloom.plans.warehouse import NOT_LAB_COLUMNS
from cohortloom.rules import SEX_CODES


@query("c1_normalise_category", """
select subject_id, anchor_year, case when upper(trim(gender)) in ('M', 'MALE') then 'M'
  when upper(trim(gender)) in ('F', 'FEMALE') then 'F' end as gender
from raw_patients""")
def c1(t):
    return t.raw_patients.select("subject_id", "anchor_year",
                                 fn.map_category("gender", SEX_CODES).alias("gender"))


@query("c2_null_outside", """
select subject_id, anchor_year, case when anchor_age between 0 and 60 then anchor_age end
  as anchor_age
from raw_patients""")
def c2(t):
    return t.raw_patients.select("subject_id", "anchor_year",
                                 fn.null_outside("anchor_age", 0, 60).alias("anchor_age"))


@query("c3_flag_adult", """
select is_adult, count(*) as n_rows from (
  select case when anchor_age >= 0 then anchor_age end >= 18 as is_adult from raw_patients)
group by is_adult""")
def c3(t):
    age = fn.null_outside("anchor_age", 0, 120)
    return t.raw_patients.groupBy(fn.at_least(age, 18).alias("is_adult")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("c4_clean_patients", "select * from patients")
def c4(t):
    return t.patients


@query("c5_valid_interval", """
select subject_id, hadm_id, admittime, dischtime from raw_admissions
where admittime is not null and (dischtime is null or dischtime >= admittime)""")
def c5(t):
    return cleaning.valid_interval(t.raw_admissions, "admittime", "dischtime").select(
        "subject_id", "hadm_id", "admittime", "dischtime"
    )


@query("c6_elapsed_hours", f"""
select hadm_id, {hours('admittime', 'dischtime', 2)} as stay_hours,
  {hours('admittime', 'dischtime', 3)} as event_hours
from user_stays""")
def c6(t):
    return t.user_stays.select(
        "hadm_id",
        fn.elapsed_hours("admittime", "dischtime", 2).alias("stay_hours"),
        fn.elapsed_hours("admittime", "dischtime", 3).alias("event_hours"),
    )


@query("c7_clean_admissions", "select * from admissions")
def c7(t):
    return t.admissions


@query("c8_normalise_code", """
select hadm_id, seq_num, upper(replace(trim(icd_code), '.', '')) as icd_code,
  coalesce(icd_version, 10) as icd_version
from raw_diagnoses""")
def c8(t):
    return t.raw_diagnoses.select(
        "hadm_id", "seq_num", fn.normalise_code("icd_code").alias("icd_code"),
        F.coalesce("icd_version", F.lit(10)).alias("icd_version"),
    )


@query("c9_starts_with_any", """
select flagged, count(*) as n_rows from (
  select coalesce(icd_version, 10) = 10 and (code like 'BRAND#25%' or code like 'BRAND#13%')
    as flagged
  from (select icd_version, upper(replace(trim(icd_code), '.', '')) as code from raw_diagnoses))
group by flagged""")
def c9(t):
    code = fn.normalise_code("icd_code")
    current = F.coalesce("icd_version", F.lit(10)) == 10
    flagged = current & fn.starts_with_any(code, ("BRAND#25", "BRAND#13"))
    return t.raw_diagnoses.groupBy(flagged.alias("flagged")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("c10_clean_diagnoses", """
select subject_id, hadm_id, seq_num, icd_code, icd_version, is_angina, is_circulatory, is_primary
from diagnoses""")
def c10(t):
    return t.diagnoses


@query("c11_contains_any", """
select itemid, label, regexp_matches(lower(trim(label)), 'ring|bolt|gear|anvil') as is_target,
  contains(lower(trim(label)), 'ring') as is_acute
from raw_dictionary""")
def c11(t):
    return t.raw_dictionary.select(
        "itemid", "label",
        fn.contains_any("label", ORDER_RULES.target_patterns).alias("is_target"),
        fn.contains_any("label", ORDER_RULES.acute_patterns).alias("is_acute"),
    )


@query("c12_clean_lab_dictionary", "select * from dictionary")
def c12(t):
    return t.dictionary


@query("c13_normalise_label", f"""
select label, {NAMES_OF_LABEL} as column_name
from (select label, {label_core('label')} as core from (
  select distinct p_size || '% ' || p_name || ', ' || p_brand || ' / ' || p_type || ' + (A)' as label
  from part
  union select distinct p_name || repeat(' -- long tail', p_size % 7) from part
  union select distinct repeat('?!', p_size % 3) from part))""")
def c13(t):
    part = t.load("part")
    labels = part.select(F.concat(
        F.col("p_size").cast("string"), F.lit("% "), "p_name", F.lit(", "), "p_brand",
        F.lit(" / "), "p_type", F.lit(" + (A)")).alias("label"))
    tails = part.select(F.concat("p_name", F.repeat(F.lit(" -- long tail"), F.col("p_size") % 7)))
    marks = part.select(F.repeat(F.lit("?!"), F.col("p_size") % 3))
    return labels.union(tails).union(marks).distinct().select(
        "label", fn.normalise_label("label").alias("column_name")
    )


@query("c14_unique_names", r"""
with named as (
    select p_partkey, case when p_size < 20 then replace(p_name, ' ', '_')
      else replace(p_name, ' ', '_') || '_' || p_size end as name from part),
  counted as (select *, row_number() over (partition by name order by p_partkey) as nth from named),
  taken as (select distinct regexp_extract(name, '^(.+)_([1-9][0-9]*)$', 1) as stem,
      regexp_extract(name, '^(.+)_([1-9][0-9]*)$', 2) as number
    from named where regexp_matches(name, '^(.+)_([1-9][0-9]*)$')),
  sizes as (select name, count(*) as n from named group by name),
  free as (
    select name, candidate, row_number() over (partition by name order by candidate) + 1 as nth
    from (select name, unnest(range(2, n + 102)) as candidate from sizes) c
    where not exists (select 1 from taken
      where taken.stem = c.name and taken.number = c.candidate::varchar))
select p_partkey, c.name, case when c.nth = 1 then c.name else c.name || '_' || f.candidate end
  as unique_name
from counted c left join free f on f.name = c.name and f.nth = c.nth""")
def c14(t):
    plain = F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    named = t.load("part").select(
        "p_partkey",
        F.when(F.col("p_size") < 20, plain)
        .otherwise(F.concat_ws("_", plain, F.col("p_size").cast("string"))).alias("name"),
    )
    return features.unique_names(named, "name", ["p_partkey"])


@query("c15_numeric_features", """
select los_hours, admit_year, died_in_hospital::double as died_in_hospital, anchor_age
from cohort""")
def c15(t):
    return features.numeric_features(
        t.cohort, ("subject_id", "hadm_id", "label", "split_bucket")
    )


LABS = ("click", "error", "purchase", "view")


@query("c15_lab_columns", f"""
select {', '.join(f'{rounded(c, 6)} as {c}' for c in LABS)} from user_mart""")
def c15_labs(t):
    labs = features.numeric_features(t.user_mart, NOT_LAB_COLUMNS)
    return labs.select(*[F.round(c, 6).alias(c) for c in labs.columns])


@query("c16_column_or_null", f"""
select hadm_id, {rounded('click', 6)} as click, null::double as troponin_t from user_wide""")
def c16(t):
    wide = t.user_wide
    return wide.select(
        "hadm_id", F.round(features.column_or_null(wide, "CLICK"), 6).alias("click"),
        features.column_or_null(wide, "troponin_t").alias("troponin_t"),
    )
