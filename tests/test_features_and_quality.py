from __future__ import annotations

import numpy as np
import pytest
from conftest import moment, plan_of
from pyspark.sql import functions as F

from cohortloom.operators import features, metrics, prep, signals
from cohortloom.operators.cohort import build_cohort
from cohortloom.operators.quality import QualityError, Suite

LABS = ("hadm_id int, itemid int, label string, is_acute_marker boolean, charttime timestamp, "
        "hours_from_admit double, valuenum double")


def labs(spark):
    t = "2120-01-01 0{}:00:00"
    return spark.createDataFrame([
        (1, 10, "Troponin T", True, moment(t.format(3)), 3.0, 0.10),
        (1, 10, "Troponin T", True, moment(t.format(1)), 1.0, 0.40),
        (1, 10, "Troponin T", True, moment(t.format(2)), 2.0, 0.16),
        (1, 20, "Glucose", False, moment(t.format(1)), 1.0, 100.0),
        (1, 20, "Glucose", False, moment(t.format(4)), 4.0, 140.0),
        (1, 21, "Glucose", False, moment(t.format(4)), 4.0, 999.0),
        (2, 21, "Glucose", False, moment(t.format(4)), 4.0, 50.0),
    ], LABS)


def test_first_for_acute_mean_for_stable(spark):
    found = {(r.hadm_id, r.itemid): (r.aggregation, r.feature_value, r.measurement_count,
                                     r.first_measurement_hours, r.min_value, r.max_value)
             for r in features.lab_features(labs(spark)).collect()}
    assert found[(1, 10)] == ("first", 0.40, 3, 1.0, 0.10, 0.40)
    assert found[(1, 20)] == ("mean", 120.0, 2, 1.0, 100.0, 140.0)


def test_pivot_prefers_the_smallest_item_and_never_fills(spark):
    wide = features.pivot_features(features.lab_features(labs(spark)))
    assert wide.columns == ["hadm_id", "glucose", "troponin_t"]
    assert sorted(map(tuple, wide.collect())) == [(1, 120.0, 0.40), (2, 50.0, None)]


def test_pivot_coverage_and_odd_labels(spark):
    rows = [(s, 1, "Common", float(s)) for s in range(10)] + [(0, 2, "Rare, rare", 1.0)]
    rows += [(s, 3, "A-b", 2.0) for s in range(10)] + [(s, 4, "a B", 3.0) for s in range(10)]
    long = spark.createDataFrame(rows, "hadm_id int, itemid int, label string, "
                                       "feature_value double")
    wide = features.pivot_features(long, min_coverage=0.2)
    assert wide.columns == ["hadm_id", "a_b", "common", "a_b_2"]
    assert {r.a_b for r in wide.collect()} == {2.0}
    assert features.pivot_features(long.where("false")).columns == ["hadm_id"]


def cohort_inputs(spark):
    people = [(s, "M", 50 + s, True) for s in range(1, 13)] + [(13, "F", 16, False)]
    patients = spark.createDataFrame(people, "subject_id int, gender string, anchor_age int, "
                                             "is_adult boolean")
    stays = [(s, 100 * s + k, moment(f"2120-0{k}-01 00:00:00"), None, 1.0, 2120, "t", "l", "d",
              "i", "m", "r", False) for s in range(1, 14) for k in (1, 2)]
    admissions = spark.createDataFrame(
        stays, "subject_id int, hadm_id int, admittime timestamp, dischtime timestamp, "
               "los_hours double, admit_year int, admission_type string, "
               "admission_location string, discharge_location string, insurance string, "
               "marital_status string, race string, died_in_hospital boolean")
    codes = [(s, 100 * s + 2, True, True) for s in (1, 2, 13)]
    codes += [(s, 100 * s + 1, False, True) for s in (5, 6)]
    diagnoses = spark.createDataFrame(codes, "subject_id int, hadm_id int, is_angina boolean, "
                                             "is_circulatory boolean")
    return patients, admissions, diagnoses


@pytest.mark.parametrize("mode", ["md5", "murmur3"])
def test_cohort_rules(spark, mode):
    inputs = cohort_inputs(spark)
    full = build_cohort(*inputs, balance=False, mode=mode).collect()
    assert {(r.subject_id, r.hadm_id) for r in full if r.label == 1} == {(1, 102), (2, 202)}
    assert {r.subject_id for r in full if r.label == 0} == {3, 4, 7, 8, 9, 10, 11, 12}
    assert all(r.hadm_id == 100 * r.subject_id + 1 for r in full if r.label == 0)
    balanced = build_cohort(*inputs, mode=mode)
    assert balanced.groupBy("label").count().where("count = 2").count() == 2
    shuffled = build_cohort(*[df.repartition(3) for df in inputs], mode=mode)
    assert sorted(balanced.collect()) == sorted(shuffled.collect())
    plan = plan_of(build_cohort(*inputs, mode=mode))
    assert "LeftSemi" in plan and "LeftAnti" in plan and "Cartesian" not in plan


def test_mart_keeps_missing_values(spark):
    cohort = spark.createDataFrame([(1, 10, 1, "M", 60, "train"), (2, 11, 0, None, 61, "test")],
                                   "subject_id int, hadm_id int, label int, gender string, "
                                   "anchor_age int, split string")
    wide = spark.createDataFrame([(10, 1.5)], "hadm_id int, glucose double")
    mart = features.build_feature_mart(cohort, wide)
    found = {r.hadm_id: (r.glucose, r.gender_male, r.age, r.has_ecg) for r in mart.collect()}
    assert found == {10: (1.5, 1, 60, False), 11: (None, 0, 61, False)}
    report = {r.column_name: r for r in features.coverage_report(mart, ["glucose"]).collect()}
    assert (report["glucose"].null_rate, report["glucose"].column_kind) == (0.5, "lab_feature")
    empty = features.coverage_report(mart.where("false"), ["glucose"])
    assert {r.null_rate for r in empty.collect()} == {1.0}


def test_mart_renames_features_that_clash(spark):
    cohort = spark.createDataFrame([(1, 10, 1, "M", 60, "train")],
                                   "subject_id int, hadm_id int, label int, gender string, "
                                   "anchor_age int, split string")
    wide = spark.createDataFrame([(10, 1.5, 2.5, 3.5)],
                                 "hadm_id int, ecg_path double, Age double, glucose double")
    points = spark.createDataFrame([(10, 7, "p/x", 0.5)],
                                   "hadm_id int, study_id int, path string, hours_from_admit double")
    row = features.build_feature_mart(cohort, wide, points).first()
    assert (row.lab_ecg_path, row.lab_Age, row.glucose, row.ecg_path, row.age) == (
        1.5, 2.5, 3.5, "p/x", 60)


def test_wide_label_sets_are_pivoted_in_groups(spark, monkeypatch):
    monkeypatch.setattr(features, "PIVOT_GROUP", 2)
    long = spark.createDataFrame(
        [(s, i, f"lab {i}", float(s + i)) for s in (1, 2) for i in range(5)],
        "hadm_id int, itemid int, label string, feature_value double")
    rows = {r.hadm_id: r for r in features.pivot_features(long).collect()}
    assert [rows[2][f"lab_{i}"] for i in range(5)] == [2.0, 3.0, 4.0, 5.0, 6.0]


def test_suite_reports_persists_and_then_blocks(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, 0), (1, None, 1), (2, 3, 5), (None, 4, 0), (None, 4, 0)],
                               "id int, value int, label int")
    suite = (Suite("gold", "t").row_count_between(1, 4).not_null("value", "warn").unique(["id"])
             .values_in("label", [0, 1]).between("value", 2, 4, "warn")
             .null_rate_below("value", 0.5).class_balance("label", 0.1, 0.8)
             .custom("no_five", F.count_if(F.col("label") == 5)))
    found = {r.check_name: (r.passed, r.observed) for r in suite.evaluate(df).collect()}
    assert found == {
        "row_count_between_1_4": (False, 5.0), "not_null__value": (False, 1.0),
        "unique__id": (False, 2.0), "values_in__label": (False, 1.0),
        "between__value": (False, 1.0), "null_rate__value": (True, 0.2),
        "class_balance__label": (True, 0.2), "no_five": (False, 1.0),
    }
    path = str(tmp_path / "dq")
    with pytest.raises(QualityError, match="unique__id"):
        suite.run(df, persist_to=path, run_id="r")
    saved = spark.read.parquet(path)
    assert saved.count() == 8 and saved.where("passed = 'false'").count() == 6
    soft = Suite("gold", "t").not_null("value", "warn")
    assert len(soft.run(df)) == 1
    nothing = {r.check_name: (r.passed, r.observed) for r in Suite("g", "t").null_rate_below(
        "value", 1.0).class_balance("label", 0, 1).evaluate(df.where("false")).collect()}
    assert nothing == {"null_rate__value": (False, 1.0), "class_balance__label": (False, 0.0)}


def test_single_column_checks_share_one_aggregation(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    suite = Suite("s", "orders").row_count_between(1).not_null("o_custkey").between(
        "o_totalprice", 0, 1e9).null_rate_below("o_orderdate", 0.1)
    plan = plan_of(suite.evaluate(orders))
    assert plan.count("FileScan") == 1


def brute_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    levels = sorted(set(scores), reverse=True)
    ap, last = 0.0, 0.0
    for level in levels:
        hits = sum(1 for p in pos if p >= level)
        said = hits + sum(1 for n in neg if n >= level)
        ap += (hits / len(pos) - last) * hits / said
        last = hits / len(pos)
    return wins / (len(pos) * len(neg)), ap


def test_ranking_metrics_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 2, 200).tolist()
    scores = np.round(rng.uniform(0, 1, 200) * 0.7 + 0.3 * np.array(labels), 2).tolist()
    rows = [("m", "test", int(y), float(s)) for y, s in zip(labels, scores)]
    rows += [("m", "one", 1, 0.5), ("m", "one", 1, 0.1)]
    df = spark.createDataFrame(rows, "model_name string, split string, label int, score double")
    found = {r.split: (r.roc_auc, r.pr_auc) for r in metrics.ranking_metrics(df).collect()}
    assert found["test"] == pytest.approx(brute_auc(labels, scores))
    assert found["one"] == (None, None)


def test_preparation_is_fitted_on_training_rows(spark):
    df = spark.createDataFrame(
        [("train", 1.0, 5.0), ("train", 3.0, 5.0), ("train", None, 5.0), ("test", 100.0, None)],
        "split string, a double, b double")
    train = F.col("split") == "train"
    filled = prep.impute_median(df, ["a", "b"], train).collect()
    assert sorted(r.a for r in filled) == [1.0, 2.0, 3.0, 100.0]
    assert [r.b for r in filled if r.split == "test"] == [5.0]
    scaled = prep.standardise(prep.missing_indicators(df, ["a", "b"]), ["a", "b"], train).collect()
    values = np.array([1.0, 3.0, 0.0])
    wanted = (100.0 - values.mean()) / values.std()
    last = next(r for r in scaled if r.split == "test")
    assert last.a == pytest.approx(wanted) and last.b == -5.0 and last.b_missing == 1


def test_signals(spark):
    rng = np.random.default_rng(1)
    lead, limb = rng.normal(2, 3, 50), rng.normal(0, 1, 50)
    broken = limb.copy()
    broken[3], broken[4] = np.nan, np.inf
    df = spark.createDataFrame([(["avr ", "I"], [broken.tolist(), lead.tolist()])],
                               "names array<string>, signal array<array<double>>")
    got = signals.normalise_signal(df, "names", "signal").first().normalised
    clean = np.nan_to_num(broken, nan=0.0, posinf=0.0)
    assert len(got) == 12 and len(got[0]) == 50
    assert np.allclose(got[0], (lead - lead.mean()) / (lead.std() + 1e-8), atol=1e-5)
    assert np.allclose(got[3], (clean - clean.mean()) / (clean.std() + 1e-8), atol=1e-5)
    assert not any(got[1])
    time = np.arange(64) / 64
    wave = np.sin(2 * np.pi * 3 * time) + 0.5 * np.cos(2 * np.pi * 5 * time)
    for length in (100, 48, 33, 64):
        there = np.arange(length) / length
        wanted = np.sin(2 * np.pi * 3 * there) + 0.5 * np.cos(2 * np.pi * 5 * there)
        assert np.allclose(signals.fourier_resample(wave, length), wanted)
    frame = spark.createDataFrame([(1, [wave.tolist(), wave.tolist()])],
                                  "id int, signal array<array<float>>")
    row = signals.resample_signal(frame, "signal", 100).first()
    assert [len(c) for c in row.signal] == [100, 100]


def test_empty_and_null_signals(spark):
    df = spark.createDataFrame(
        [(1, ["I"], []), (2, ["I"], None), (3, ["I", "II"], [None, [1.0, 2.0]]), (4, ["I"], [[]])],
        "id int, names array<string>, signal array<array<double>>")
    got = {r.id: r.normalised for r in signals.normalise_signal(
        df, "names", "signal", ("I", "II")).collect()}
    assert got[1] == [[], []] and got[4] == [[], []] and got[2] == [[], []]
    assert got[3][0] == [0.0, 0.0] and np.allclose(got[3][1], [-1, 1])
    sized = {r.id: r.signal for r in signals.resample_signal(df, "signal", 4).collect()}
    assert sized[1] == [] and sized[2] is None and sized[4] == [[0.0] * 4]
    assert sized[3][0] is None and len(sized[3][1]) == 4
