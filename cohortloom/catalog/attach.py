"""Joins: measurements to stays, points to intervals, semi and anti joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.catalog.base import query
from cohortloom.catalog.sql import hours, rounded
from cohortloom.operators import cohort as co
from cohortloom.operators import asof, joins, monitors, ranking
from cohortloom.operators.assertions import blocking_failures_in_latest_run
from cohortloom.operators.features import build_feature_mart
from cohortloom.plans import warehouse


@query("j1_dictionary_join", """
select l.hadm_id, l.itemid, l.charttime, l.valuenum, d.label
from raw_labs l join dictionary d on d.itemid = l.itemid and d.is_target_lab""")
def j1(t):
    items = t.dictionary.where("is_target_lab").select("itemid", "label")
    events = t.raw_labs.select("hadm_id", "itemid", "charttime", "valuenum")
    return joins.dictionary_join(events, items)


@query("j2_stay_join", """
select l.hadm_id, l.itemid, l.charttime, l.valuenum, a.admittime, a.dischtime
from raw_labs l join admissions a on a.hadm_id = l.hadm_id""")
def j2(t):
    events = t.raw_labs.select("hadm_id", "itemid", "charttime", "valuenum")
    stays = t.admissions.select("hadm_id", "admittime", "dischtime")
    return joins.stay_join(events, stays, "hadm_id", ["itemid", "charttime"]).drop("_part")


@query("j2_stay_join_hot", """
select hadm_id, count(*) as n_rows, min(itemid) as first_item, min(admittime) as admittime from (
  select l.hadm_id, l.itemid, a.admittime
  from raw_labs l join admissions a on a.hadm_id = l.hadm_id) group by hadm_id""")
def j2_hot(t):
    """The same join with every stay of more than two rows cut into parts."""
    events = t.raw_labs.select("hadm_id", "itemid", "charttime")
    stays = t.admissions.select("hadm_id", "admittime")
    joined = joins.stay_join(events, stays, "hadm_id", ["itemid", "charttime"], hot_rows=2)
    return joined.groupBy("hadm_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("itemid").alias("first_item"),
        F.min("admittime").alias("admittime"),
    )


@query("j3_within_window", """
select l.hadm_id, l.itemid, l.charttime, l.valuenum
from raw_labs l join admissions a on a.hadm_id = l.hadm_id
where l.charttime >= a.admittime and l.charttime <= coalesce(a.dischtime, l.charttime)""")
def j3(t):
    events = t.raw_labs.select("hadm_id", "itemid", "charttime", "valuenum")
    stays = t.admissions.select("hadm_id", "admittime", "dischtime")
    return joins.within_window(events, stays).select("hadm_id", "itemid", "charttime", "valuenum")


@query("j3_interval_join", """
select hadm_id, event_id, subject_id, charttime, hours_from_admit from user_labs""")
def j3_interval(t):
    return t.user_labs_plan.select("hadm_id", "event_id", "subject_id", "charttime",
                                   "hours_from_admit")


@query("j4_clean_events", "select * from labs")
def j4(t):
    return t.labs_plan


@query("j5_match_to_interval", """
select subject_id, hadm_id, study_id, file_name, path, ecg_time, hours_from_admit
from user_matches""")
def j5(t):
    return t.user_matches


STRICT = """
select c.subject_id, c.hadm_id, c.label, p.study_id, p.ecg_time
from user_cohort c join user_points p on p.subject_id = c.subject_id
  and p.ecg_time >= c.admittime and p.ecg_time <= c.dischtime
qualify row_number() over (partition by c.hadm_id order by p.ecg_time, p.study_id) = 1"""


def strict_match(t):
    """Stay times are dropped first, so they are looked up again."""
    bare = t.user_cohort.select("subject_id", "hadm_id", "label")
    records = t.user_points.select("subject_id", "study_id", "ecg_time", "path")
    return joins.match_first_strict(bare, records, t.user_stays)


@query("j6_match_first_strict", STRICT)
def j6(t):
    return strict_match(t).select("subject_id", "hadm_id", "label", "study_id", "ecg_time")


@query("j6_match_without_time", """
select c.subject_id, c.hadm_id, p.study_id
from user_cohort c join user_points p on p.subject_id = c.subject_id""")
def j6_untimed(t):
    people = t.user_cohort.select("subject_id", "hadm_id", "admittime", "dischtime")
    return joins.match_first_strict(people, t.user_points.select("subject_id", "study_id")).select(
        "subject_id", "hadm_id", "study_id"
    )


@query("j7_adult_restriction", """
select subject_id, hadm_id, admittime from admissions
where subject_id in (select subject_id from patients where is_adult)""")
def j7(t):
    adults = t.patients.where("is_adult").select("subject_id")
    return co.only_in(t.admissions, adults, "subject_id").select(
        "subject_id", "hadm_id", "admittime"
    )


@query("j8_case_semi_join", """
select subject_id, hadm_id, admittime from admissions
where hadm_id in (select hadm_id from diagnoses where is_angina)""")
def j8(t):
    return co.case_stays(t.admissions, t.diagnoses).select("subject_id", "hadm_id", "admittime")


@query("j9_control_anti_join", """
select subject_id, hadm_id, admittime from admissions
where subject_id not in (select subject_id from diagnoses where is_circulatory)""")
def j9(t):
    return co.unexposed_subjects(t.admissions, t.diagnoses).select(
        "subject_id", "hadm_id", "admittime"
    )


@query("j10_attribute_rejoin", """
select a.hadm_id, a.subject_id, p.gender, p.anchor_age
from admissions a join patients p on p.subject_id = a.subject_id and p.is_adult""")
def j10(t):
    adults = t.patients.where("is_adult").select("subject_id", "gender", "anchor_age")
    return co.attach_unique(t.admissions.select("hadm_id", "subject_id"), adults, "subject_id")


@query("j11_cohort_events", """
select hadm_id, itemid, charttime, valuenum from labs
where hadm_id in (select hadm_id from cohort)""")
def j11(t):
    return co.only_in(t.labs, t.cohort.select("hadm_id"), "hadm_id").select(
        "hadm_id", "itemid", "charttime", "valuenum"
    )


@query("j12_mart_left_joins", f"""
select c.hadm_id, c.label, {rounded('w.click', 6)} as click, {rounded('w.view', 6)} as view, m.study_id as ecg_study_id,
  m.study_id is not null as has_ecg
from user_cohort c left join user_wide w on w.hadm_id = c.hadm_id
left join user_matches m on m.hadm_id = c.hadm_id""")
def j12(t):
    return build_feature_mart(t.user_cohort, t.user_wide, t.user_matches).select(
        "hadm_id", "label", F.round("click", 6).alias("click"), F.round("view", 6).alias("view"),
        "ecg_study_id", "has_ecg",
    )


@query("j13_panel_and_activity", """
select c.hadm_id, count(f.lab_itemid) as panel_rows, count(f.lab_itemid) > 0 as has_any_lab
from staged_cohort c left join staged_features f on f.hadm_id = c.hadm_id group by c.hadm_id""")
def j13(t):
    """Inner panel join and left activity join agree on every stay."""
    per_stay = t.panel.groupBy("hadm_id").agg(F.count(F.lit(1)).alias("panel_rows"))
    facts = warehouse.fct_admission(t.staged_cohort, t.staged_features)
    return facts.select("hadm_id", "has_any_lab").join(per_stay, "hadm_id", "left").select(
        "hadm_id", F.coalesce("panel_rows", F.lit(0).cast("long")).alias("panel_rows"),
        "has_any_lab",
    )


@query("j14_newest_and_previous_run", """
with ranked as (select *, dense_rank() over (order by _run_id desc) as r from coverage_history)
select c.column_name, c.null_rate as current_rate, p.null_rate as previous_rate
from ranked c join ranked p on p.column_name = c.column_name and c.r = 1 and p.r = 2""")
def j14(t):
    return monitors.compare_runs(t.coverage_history)


@query("j15_latest_run_join", """
select r.layer, r.table_name, r.check_name, r.details from staged_dq r
join (select run_id from staged_dq order by checked_at desc, run_id desc limit 1) l
  on l.run_id = r.run_id
where r.severity = 'error' and not r.passed""")
def j15(t):
    return blocking_failures_in_latest_run(warehouse.stg_dq_results(t.dq_results))


LAST_CLICK = """
with clicks as (select subject_id, ecg_time, min(study_id) as study_id from user_points
  group by subject_id, ecg_time)
select d.event_id, d.subject_id, d.charttime, c.study_id, c.ecg_time
from user_draws d asof left join clicks c on c.subject_id = d.subject_id and c.ecg_time {} d.charttime"""


@query("j16_asof_last_point", LAST_CLICK.format("<="))
def j16(t):
    """Each measurement with the last point record of its subject up to then."""
    return asof.asof_join(
        t.user_draws.select("event_id", "subject_id", "charttime"),
        t.user_points.select("subject_id", "study_id", "ecg_time"),
        by="subject_id", at="charttime", point_at="ecg_time", ties=[F.col("study_id")])


@query("j16_asof_next_point", LAST_CLICK.format(">"))
def j16_next(t):
    """Each measurement with the next point record after it."""
    return asof.asof_join(
        t.user_draws.select("event_id", "subject_id", "charttime"),
        t.user_points.select("subject_id", "study_id", "ecg_time"), by="subject_id",
        at="charttime", point_at="ecg_time", ties=[F.col("study_id")], direction="forward",
        strict=True)


@query("a14_match_coverage", f"""
with m as ({STRICT})
select coalesce(c.label::varchar, 'all') as cohort_label, count(*) as stays,
  count(m.hadm_id) as matched_stays, {rounded('count(m.hadm_id) / count(*)', 6)} as coverage
from user_cohort c left join m on m.hadm_id = c.hadm_id
group by grouping sets ((c.label), ())""")
def a14(t):
    return joins.match_coverage(t.user_cohort, strict_match(t))


@query("n1_keep_first", f"""
select p.subject_id, s.hadm_id, p.study_id, {hours('s.admittime', 'p.ecg_time', 3)} as hours
from user_points p join user_stays s on s.subject_id = p.subject_id
  and p.ecg_time >= s.admittime and p.ecg_time <= coalesce(s.dischtime, p.ecg_time)
qualify row_number() over (partition by s.hadm_id order by p.ecg_time, p.study_id) = 1""")
def n1(t):
    pairs = joins.interval_join(
        t.user_points.select("subject_id", "study_id", "ecg_time"), t.user_stays,
        by="subject_id", at="ecg_time", start="admittime", end="dischtime",
    )
    first = ranking.keep_first(pairs, ["hadm_id"], [F.col("ecg_time"), F.col("study_id")])
    return first.select(
        "subject_id", "hadm_id", "study_id",
        F.round((F.col("ecg_time").cast("timestamp").cast("long")
                 - F.col("admittime").cast("timestamp").cast("long")) / 3600.0, 3).alias("hours"),
    )
