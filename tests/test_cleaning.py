from __future__ import annotations

from collections import Counter
from dataclasses import replace

from conftest import moment, plan_of
from pyspark.sql import functions as F

from cohortloom.catalog import tables
from cohortloom.functions.columns import normalise_label
from cohortloom.operators import cleaning
from cohortloom.operators.features import unique_names
from cohortloom.operators.ranking import keep_first
from cohortloom.rules import RULES

RAW_PATIENTS = ("subject_id int, gender string, anchor_age int, anchor_year int, "
                "anchor_year_group string, dod timestamp")
RAW_STAYS = ("subject_id int, hadm_id int, admittime timestamp, dischtime timestamp, "
             "admission_type string, admission_location string, discharge_location string, "
             "insurance string, marital_status string, race string, hospital_expire_flag int")


def test_patients_are_conformed_and_unique(spark):
    raw = spark.createDataFrame([
        (1, " f ", 60, 2110, "g", None), (1, "male", 61, 2111, "g", None),
        (2, "MALE", 17, 2110, "g", None), (3, "?", 205, 2110, "g", None),
        (None, "M", 40, 2110, "g", None), (4, "M", 18, None, "g", None),
        (4, "F", 44, 2101, "g", None),
    ], RAW_PATIENTS)
    found = {r.subject_id: (r.gender, r.anchor_age, r.is_adult)
             for r in cleaning.clean_patients(raw).collect()}
    assert found == {1: ("F", 60, True), 2: ("M", 17, False), 3: (None, None, None),
                     4: ("F", 44, True)}


def stays(spark, rows):
    return spark.createDataFrame(
        [(s, h, moment(a), d and moment(d), "t", "l", "d", "i", "m", "r", e)
         for s, h, a, d, e in rows], RAW_STAYS)


def test_impossible_stays_are_dropped_and_open_ones_kept(spark):
    raw = stays(spark, [
        (1, 10, "2120-01-01 08:00:00", "2120-01-03 08:20:00", None),
        (1, 10, "2120-01-01 08:00:00", "2120-01-03 08:20:00", None),
        (1, 11, "2120-02-01 08:00:00", "2120-01-31 08:00:00", 1),
        (2, 12, "2120-03-01 08:00:00", None, 1),
    ])
    found = {r.hadm_id: (r.los_hours, r.died_in_hospital, r.admit_year)
             for r in cleaning.clean_admissions(raw).collect()}
    assert found == {10: (48.33, False, 2120), 12: (None, True, 2120)}


def test_codes_are_normalised_flagged_and_lowest_sequence_wins(spark):
    raw = spark.createDataFrame([
        (1, 10, 2, " i25.110 ", 10), (1, 10, 1, "I25110", None), (1, 10, 3, "I50.9", 10),
        (1, 10, 4, "E11", 10), (1, 10, 5, "I20.9", 9), (1, 10, None, "I20.0", 10),
        (1, None, 1, "I20", 10),
    ], "subject_id int, hadm_id int, seq_num int, icd_code string, icd_version int")
    found = {(r.icd_code, r.icd_version): (r.seq_num, r.is_angina, r.is_circulatory, r.is_primary)
             for r in cleaning.clean_diagnoses(raw).collect()}
    assert found == {
        ("I25110", 10): (1, True, True, True), ("I509", 10): (3, False, True, False),
        ("E11", 10): (4, False, False, False), ("I209", 9): (5, False, False, False),
        ("I200", 10): (None, True, True, False),
    }


def dictionary(spark):
    raw = spark.createDataFrame([
        (1, " Troponin T ", "Blood", "Chemistry"), (2, "Glucose", "Blood", "Chemistry"),
        (3, "Colour", "Urine", "Misc"), (4, None, "Blood", "Misc"),
        (2, "Sugar", "Blood", "Chemistry"),
    ], "itemid int, label string, fluid string, category string")
    return cleaning.clean_lab_dictionary(raw)


def test_dictionary_flags(spark):
    found = {r.itemid: (r.label, r.is_target_lab, r.is_acute_marker)
             for r in dictionary(spark).collect()}
    assert found == {1: ("Troponin T", True, True), 2: ("Glucose", True, False),
                     3: ("Colour", False, False)}


def events(spark):
    rows = [
        (10, 1, "2120-01-01 10:00:00", 0.4, "a"), (10, 1, "2120-01-01 10:00:00", 0.4, "b"),
        (10, 2, "2119-06-01 10:00:00", 90.0, "a"), (10, 2, "2120-01-09 10:00:00", 91.0, "a"),
        (10, 2, "2120-01-02 10:00:00", None, "a"), (10, 3, "2120-01-02 10:00:00", 5.0, "a"),
        (12, 2, "2125-01-01 00:00:00", 99.0, "a"), (None, 2, "2120-01-02 10:00:00", 5.0, "a"),
    ]
    return spark.createDataFrame(
        [(h, i, moment(t), v, u, "") for h, i, t, v, u in rows],
        "hadm_id int, itemid int, charttime timestamp, valuenum double, valueuom string, "
        "flag string")


def clean_stays(spark):
    return cleaning.clean_admissions(stays(spark, [
        (1, 10, "2120-01-01 08:00:00", "2120-01-03 08:00:00", None),
        (2, 12, "2120-03-01 08:00:00", None, None),
    ]))


def test_events_stay_inside_their_window(spark):
    found = cleaning.clean_events(events(spark), clean_stays(spark), dictionary(spark)).collect()
    assert {(r.hadm_id, r.itemid, r.valuenum, r.valueuom, r.marker_type, r.hours_from_admit)
            for r in found} == {(10, 1, 0.4, "a", "acute", 2.0),
                                (12, 2, 99.0, "a", "routine", 42400.0)}
    anywhere = cleaning.clean_events(events(spark), clean_stays(spark), dictionary(spark),
                                     replace(RULES, inside_stay_only=False))
    assert anywhere.count() == 4


def test_hot_stays_give_the_same_events(spark):
    plain = cleaning.clean_events(events(spark), clean_stays(spark), dictionary(spark))
    cut = cleaning.clean_events(events(spark), clean_stays(spark), dictionary(spark), hot_rows=1)
    assert sorted(plain.collect()) == sorted(cut.collect())


def test_events_are_shuffled_once_between_join_and_deduplication(spark, small):
    from cohortloom.catalog.tables import Tables

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(Tables(spark, small).labs_plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan[plan.index("WindowGroupLimit"):]
    above_join = final[:final.index("SortMergeJoin [hadm_id")]
    assert "Exchange" not in above_join


def test_keep_first_is_limited_before_the_shuffle_and_stable(spark):
    rows = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") % 7).alias("o"), F.col("id").alias("v"))
    first = keep_first(rows, ["k"], [F.col("o")])
    plan = plan_of(first)
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index(
        "row_number(), 1, Partial")
    again = keep_first(rows.repartition(5, "v"), ["k"], [F.col("o")])
    assert sorted(first.collect()) == sorted(again.collect())


def test_labels_become_safe_names(spark):
    cases = {
        "Cholesterol, LDL, Calculated": "cholesterol_ldl_calculated",
        "% Hemoglobin A1c": "pct_hemoglobin_a1c", "Urea/Creatinine": "urea_per_creatinine",
        "25-OH Vitamin D": "lab_25_oh_vitamin_d", "  ": "unnamed", "???": "unnamed",
        "a" * 80: "a" * 55, "#1 + x": "num_1_plus_x", "b" * 54 + " tail": "b" * 54,
    }
    df = spark.createDataFrame([(k,) for k in cases], "label string")
    found = {r[0]: r[1] for r in df.select("label", normalise_label("label")).collect()}
    assert found == cases


def test_names_never_collide(spark):
    names = ["foo", "foo", "foo_2", "foo", "bar", "foo_3", "foo_2", "foo_02"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, name string")
    found = [r.unique_name for r in unique_names(df, "name", ["i"]).orderBy("i").collect()]
    assert len(set(found)) == len(names)
    assert found == ["foo", "foo_4", "foo_2", "foo_5", "bar", "foo_3", "foo_2_2", "foo_02"]


def test_diagnoses_of_many_orders_are_in_tasks_of_few_lines(spark, tmp_path, monkeypatch):
    n = 4000
    key = F.col("id")
    frames = {
        "part": spark.range(50).select(
            key.alias("p_partkey"), F.concat(F.lit("Brand#"), (key % 30).cast("string")).alias("p_brand"),
            F.lit("ECONOMY").alias("p_type")),
        "orders": spark.range(n // 4).select(
            F.when(key % 90 != 0, key).alias("o_orderkey"), (key % 70).alias("o_custkey")),
        "lineitem": spark.range(n).select(
            F.when(key % 80 != 0, F.floor(key / 4)).alias("l_orderkey"),
            F.when(key % 33 != 0, key * 7 % 50).alias("l_partkey"),
            (1 + key % 7).cast("int").alias("l_linenumber")),
    }
    for name, df in frames.items():
        # Rows that come twice, too.
        df.unionByName(df.where(F.rand(1) < 0.1)).write.parquet(str(tmp_path / f"{name}.parquet"))

    def found():
        rows = tables.Tables(spark, str(tmp_path)).diagnoses.withColumn("_task", F.spark_partition_id())
        rows = rows.collect()
        sizes = Counter(r["_task"] for r in rows)
        return sorted((tuple(r)[:-1] for r in rows), key=str), sizes

    whole, _ = found()
    monkeypatch.setattr(tables, "FEW_ORDERS", 100, raising=False)
    monkeypatch.setattr(tables, "TASK_LINES", 200, raising=False)
    for broadcast in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        try:
            rows, sizes = found()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert rows == whole and len(rows) > 3000
        assert max(sizes.values()) <= 2 * 200
