"""Raw entity tables to conformed ones: typed, flagged, one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import (
    at_least,
    contains_any,
    elapsed_hours,
    map_category,
    normalise_code,
    null_outside,
    starts_with_any,
)
from cohortloom.operators.joins import (
    HOT_KEY_ROWS,
    dictionary_join,
    match_to_interval,
    within_window,
)
from cohortloom.operators.ranking import keep_first
from cohortloom.rules import RULES, SEX_CODES, StudyRules


def present(*names: str) -> Column:
    """All of the named columns carry a value."""
    test = F.col(names[0]).isNotNull()
    for name in names[1:]:
        test = test & F.col(name).isNotNull()
    return test


def valid_interval(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows that start, and do not end before they start; an open end is fine."""
    return df.where(present(start) & F.coalesce(F.col(end) >= F.col(start), F.lit(True)))


def clean_patients(raw: DataFrame, rules: StudyRules = RULES) -> DataFrame:
    low, high = rules.age_range
    conformed = raw.where(present("subject_id")).select(
        "subject_id",
        map_category("gender", SEX_CODES).alias("gender"),
        null_outside("anchor_age", low, high).alias("anchor_age"),
        "anchor_year", "anchor_year_group", "dod",
    )
    single = keep_first(conformed, ["subject_id"], [F.col("anchor_year").asc_nulls_last()])
    return single.select(
        "subject_id", "gender", "anchor_age",
        at_least("anchor_age", rules.adult_age).alias("is_adult"),
        "anchor_year", "anchor_year_group", "dod",
    )


def clean_admissions(raw: DataFrame) -> DataFrame:
    timed = valid_interval(raw.where(present("hadm_id", "subject_id")), "admittime", "dischtime")
    kept = timed.select(
        "subject_id", "hadm_id", "admittime", "dischtime", "admission_type",
        "admission_location", "discharge_location", "insurance", "marital_status", "race",
        (F.coalesce("hospital_expire_flag", F.lit(0)) == 1).alias("died_in_hospital"),
    )
    single = keep_first(kept, ["hadm_id"], [F.col("admittime").asc()])
    return single.select(
        "subject_id", "hadm_id", "admittime", "dischtime",
        elapsed_hours("admittime", "dischtime", 2).alias("los_hours"),
        F.year("admittime").alias("admit_year"),
        "admission_type", "admission_location", "discharge_location", "insurance",
        "marital_status", "race", "died_in_hospital",
    )


def clean_diagnoses(raw: DataFrame, rules: StudyRules = RULES) -> DataFrame:
    coded = raw.where(present("hadm_id", "icd_code")).select(
        "subject_id", "hadm_id", "seq_num",
        normalise_code("icd_code").alias("icd_code"),
        F.coalesce("icd_version", F.lit(rules.code_version)).alias("icd_version"),
    )
    single = keep_first(
        coded, ["subject_id", "hadm_id", "icd_code", "icd_version"],
        [F.col("seq_num").asc_nulls_last()],
    )

    def flagged(prefixes) -> Column:
        current = F.col("icd_version") == rules.code_version
        return current & starts_with_any("icd_code", prefixes)

    return single.select(
        "subject_id", "hadm_id", "seq_num", "icd_code", "icd_version",
        flagged(rules.case_prefixes).alias("is_angina"),
        flagged(rules.exclusion_prefixes).alias("is_circulatory"),
        (F.coalesce("seq_num", F.lit(rules.unranked_sequence)) == 1).alias("is_primary"),
    )


def clean_lab_dictionary(raw: DataFrame, rules: StudyRules = RULES) -> DataFrame:
    named = raw.where(present("label")).select(
        "itemid", F.trim("label").alias("label"), "fluid", "category"
    )
    return keep_first(named, ["itemid"]).select(
        "*",
        contains_any("label", rules.target_patterns).alias("is_target_lab"),
        contains_any("label", rules.acute_patterns).alias("is_acute_marker"),
    )


def clean_events(
    raw: DataFrame,
    admissions: DataFrame,
    dictionary: DataFrame,
    rules: StudyRules = RULES,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Numeric measurements of the target items taken during their own stay.

    The raw side is filtered to the wanted items and narrowed, then shuffled
    once: the stay join and the de-duplication share one partitioning by
    (stay, part). Item names are attached last so they are never shuffled.
    """
    items = dictionary.where("is_target_lab").select(
        "itemid", "label", "category", "is_acute_marker"
    )
    usable = (
        raw.where(present("hadm_id", "valuenum", "charttime"))
        .select("hadm_id", "itemid", "charttime", "valuenum", "valueuom", "flag")
        .join(items.select("itemid"), "itemid", "left_semi")
    )
    measured = ["itemid", "charttime", "valuenum"]
    placed = within_window(
        usable, admissions.select("hadm_id", "admittime", "dischtime"),
        spread_by=measured, inside_only=rules.inside_stay_only, hot_rows=hot_rows,
    )
    single = keep_first(placed.drop("dischtime"), ["hadm_id", *measured], within=["_part"])
    return dictionary_join(single, items).select(
        "hadm_id", "itemid", "label", "category", "is_acute_marker",
        F.when(F.col("is_acute_marker"), "acute").otherwise("routine").alias("marker_type"),
        "charttime", elapsed_hours("admittime", "charttime", 3).alias("hours_from_admit"),
        "valuenum", "valueuom", "flag",
    )


def clean_point_records(
    raw: DataFrame, admissions: DataFrame, rules: StudyRules = RULES
) -> DataFrame:
    """One point record per stay, linked by subject and time."""
    return match_to_interval(
        raw, admissions,
        grace_hours=rules.point_grace_hours, reach_hours=rules.point_reach_hours,
    ).select(
        "subject_id", "hadm_id", "study_id", "file_name", "path", "ecg_time", "hours_from_admit"
    )
