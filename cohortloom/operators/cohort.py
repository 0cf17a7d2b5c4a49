"""Case/control cohort: eligibility, sampling, one stay per subject, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import banded, hash_bucket, hash_ordinal
from cohortloom.operators.ranking import binned_rank, first_per_group, hash_sample
from cohortloom.rules import (
    CONTROL_SALT,
    RULES,
    SPLIT_NAMES,
    SPLIT_SALT,
    SPLIT_WEIGHTS,
    StudyRules,
)

COHORT_COLUMNS = (
    "subject_id", "hadm_id", "label", "gender", "anchor_age", "admittime", "dischtime",
    "los_hours", "admit_year", "admission_type", "insurance", "race", "died_in_hospital",
    "split", "split_bucket",
)


def distinct_keys(df: DataFrame, key: str, condition: Column | None = None) -> DataFrame:
    """Distinct keys of the rows that meet the condition.

    Used ahead of semi and anti joins so that a key repeated in a third of the
    rows is reduced on the map side instead of travelling to one task.
    """
    rows = df if condition is None else df.where(condition)
    return rows.select(key).distinct()


def only_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys, key, "left_semi")


def not_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys, key, "left_anti")


def attach_unique(df: DataFrame, attributes: DataFrame, key: str) -> DataFrame:
    """Add columns of a frame with one row per key; rows without it are dropped."""
    return df.join(attributes, key)


def assign_split(
    df: DataFrame,
    key: str = "subject_id",
    salt: str = SPLIT_SALT,
    weights: Sequence[int] = SPLIT_WEIGHTS,
    mode: str = "murmur3",
) -> DataFrame:
    """``split_bucket`` and ``split`` from the key alone: no shuffle, no state."""
    bucketed = df.withColumn("split_bucket", hash_bucket(key, salt, sum(weights), mode))
    bands, upper = [], 0
    for name, weight in zip(SPLIT_NAMES, weights, strict=True):
        upper += weight
        bands.append((name, upper))
    last, _ = bands.pop()
    split = banded("split_bucket", bands, last, inclusive=False)
    return bucketed.withColumn("split", split)


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    *,
    test_share: float = 0.20,
    validation_share: float = 0.10,
    salt: str = "42",
    mode: str = "md5",
) -> DataFrame:
    """Split that keeps the label mix: ``test_share`` of each label, then
    ``validation_share`` of what is left of it, in salted-hash order."""
    ranked = binned_rank(df, [label], hash_ordinal(key, salt, mode), [key])
    rows = F.col("stratum_rows")
    test_rows = F.ceil(rows * F.lit(test_share))
    validation_rows = F.ceil((rows - test_rows) * F.lit(validation_share))
    train, validation, test = SPLIT_NAMES
    return ranked.withColumn(
        "split",
        F.when(F.col("rank") <= test_rows, F.lit(test))
        .when(F.col("rank") <= test_rows + validation_rows, F.lit(validation))
        .otherwise(F.lit(train)),
    ).drop("rank", "stratum_rows")


def case_stays(admissions: DataFrame, diagnoses: DataFrame) -> DataFrame:
    return only_in(admissions, distinct_keys(diagnoses, "hadm_id", F.col("is_angina")), "hadm_id")


def unexposed_subjects(stays: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Stays of subjects without an excluded diagnosis anywhere in their record."""
    excluded = distinct_keys(diagnoses, "subject_id", F.col("is_circulatory"))
    return not_in(stays, excluded, "subject_id")


def build_cohort(
    patients: DataFrame,
    admissions: DataFrame,
    diagnoses: DataFrame,
    rules: StudyRules = RULES,
    *,
    balance: bool = True,
    mode: str = "murmur3",
) -> DataFrame:
    """One labelled stay per subject, as a single lazy plan.

    Adulthood and exclusion are properties of the subject, so the first stay
    is picked before those joins: each map task then forwards one row per
    subject instead of a subject's whole history.
    """
    adults = patients.where("is_adult").select("subject_id", "gender", "anchor_age")
    order = ["admittime", "hadm_id"]

    first_cases = first_per_group(case_stays(admissions, diagnoses), "subject_id", order)
    cases = attach_unique(first_cases, adults, "subject_id").withColumn("label", F.lit(1))

    first_stays = first_per_group(admissions, "subject_id", order)
    controls = attach_unique(
        unexposed_subjects(first_stays, diagnoses), adults, "subject_id"
    ).withColumn("label", F.lit(0))

    if balance:
        wanted = F.greatest(
            F.floor(F.count(F.lit(1)) * F.lit(rules.controls_per_case)),
            F.lit(rules.minimum_controls),
        )
        keep = cases.agg(wanted.alias("keep")).scalar()
        controls = hash_sample(controls, keep, "subject_id", CONTROL_SALT, mode)

    labelled = cases.unionByName(controls)
    return assign_split(labelled, mode=mode).select(*COHORT_COLUMNS)
