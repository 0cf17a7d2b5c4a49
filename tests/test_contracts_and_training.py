from __future__ import annotations

import os
import threading

import pytest
from conftest import plan_of
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortloom import cli
from cohortloom.catalog.reports import published_models
from cohortloom.catalog.scans import write_raw
from cohortloom.catalog.tables import Tables
from cohortloom.operators import prep
from cohortloom.operators.quality import QualityError, Suite
from cohortloom.plans import contracts, jobs, training
from cohortloom.plans.training_job import RegressionError, metric_history, train_and_record
from cohortloom.sources import lake


@pytest.fixture(scope="module")
def models(spark, small):
    return published_models(Tables(spark, small))


def test_one_pass_counts_the_row_rules_of_a_model(spark):
    patients = spark.createDataFrame(
        [(1, "45_64", 1), (1, "old", 0), (None, "65_79", 2), (3, None, None)],
        "subject_id int, age_group string, has_angina int")
    chosen = [a for a in contracts.declared() if a.model == "dim_patient"]
    found = contracts.outcomes({"dim_patient": patients}, chosen)
    got = {r.assertion: r.offenders for r in found.collect()}
    assert got == {"not_null__subject_id": 1, "unique__subject_id": 1,
                   "accepted_values__age_group": 1, "accepted_values__has_angina": 1}
    rows_only = [a for a in chosen if a.bad is not None]
    plan = plan_of(contracts.outcomes({"dim_patient": patients}, rows_only))
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") == 1
    named = {a.name: a for a in chosen}
    assert named["accepted_values__age_group"].offenders({"dim_patient": patients}).first().age_group == "old"


def test_enforce_raises_for_errors_only(spark, models):
    broken = {**models, "fct_admission": models["fct_admission"].withColumn("subject_id", F.lit(-1))}
    with pytest.raises(QualityError, match="relationships__subject_id__dim_patient"):
        contracts.enforce(broken)
    warned = [a for a in contracts.declared() if a.severity == "warn"]
    tiny = {"mart_angina_training_features": models["mart_angina_training_features"].limit(1)}
    assert not contracts.enforce(tiny, warned).first().passed
    assert all(a.model in models for a in contracts.declared())


def scores(shift: float):
    """A stand-in for the fit: scores of the mart's rows, worse as ``shift`` grows."""
    def fit(mart):
        noise = F.pmod(F.xxhash64("hadm_id"), F.lit(1000)) / 1000.0
        score = F.least(F.greatest(F.col("label") * (1 - shift) + noise * 0.8, F.lit(0.0)), F.lit(1.0))
        return mart.where("split <> 'train'").select(
            F.explode(F.array(F.lit("a"), F.lit("b"))).alias("model_name"), "split", "label",
            (score * F.when(F.col("model_name") == "b", 0.5).otherwise(1.0)).alias("score"))
    return fit


def test_the_training_job_records_and_fails_on_a_regression(spark, tmp_path):
    home = lake.Lake(str(tmp_path / "lake"))
    mart = spark.range(2000).select(
        F.col("id").alias("hadm_id"), (F.col("id") % 2).cast("int").alias("label"),
        F.element_at(F.array(*map(F.lit, ("train", "validation", "test"))),
                     (F.pmod(F.hash("id"), F.lit(3)) + 1).cast("int")).alias("split"),
        F.col("id").cast("double").alias("age"))
    lake.write_layer(mart, home, "gold", "feature_mart")

    def run(name, shift, day):
        return train_and_record(spark, home, name, fit=scores(shift),
                                trained_at=F.expr(f"timestamp'2024-01-0{day} 00:00:00'"))

    first = run("r1", 0.2, 1)
    assert first.best.model_name == "b" or first.best.model_name == "a"
    assert first.gate.verdict == "short_history" and first.metrics.first().n_features == 1
    run("r2", 0.2, 2)
    run("r2", 0.2, 2)  # a rerun replaces its own rows
    run("r3", 0.25, 3)
    with pytest.raises(RegressionError, match="r4"):
        run("r4", 0.9, 4)
    history = metric_history(spark, home, first.metrics)
    assert history.groupBy("run_id").count().select("count").distinct().count() == 1
    assert {r.run_id for r in history.select("run_id").collect()} == {"r1", "r2", "r3", "r4"}


def test_gated_writes_store_once_and_failures_leave_the_old_table(spark, tmp_path):
    home = lake.Lake(str(tmp_path / "lake"))
    good = Suite("s", "silver").not_null("id")
    assert jobs.gated_write(spark.range(100), good, home, "silver", "t", run_id="one") == 100
    before = set(os.listdir(home.path("silver", "t")))
    with pytest.raises(QualityError):
        jobs.gated_write(spark.range(9).select(F.lit(None).cast("long").alias("id")), good, home,
                         "silver", "t", run_id="two")
    assert set(os.listdir(home.path("silver", "t"))) == before
    assert os.listdir(tmp_path / "lake" / "_staging") == []
    # Reading the table while rewriting it is allowed: the new one is whole before the swap.
    table = lake.read_layer(spark, home, "silver", "t")
    jobs.gated_write(table.select("id").where("id < 7"), good, home, "silver", "t", run_id="three",
                     partition_by=[])
    assert lake.read_layer(spark, home, "silver", "t").count() == 7
    results = lake.read_history(spark, home.quality)
    assert {(r.run_id, r.passed) for r in results.collect()} >= {("one", "true"), ("two", "false")}
    empty = jobs.gated_write(spark.range(0).withColumn("p", F.lit("x")), good, home, "silver", "e",
                             partition_by=["p"])
    assert empty == 0 and os.listdir(tmp_path / "lake" / "_staging") == []


def test_jobs_from_the_command_line(spark, small, tmp_path, capsys, monkeypatch):
    t, source, home = Tables(spark, small), str(tmp_path / "raw"), str(tmp_path / "lake")
    write_raw(t.items, source, "d_labitems")
    counts = cli.run(["bronze", "--source", source, "--lake", home, "--tables", "d_labitems", "patients",
                      "--skip-missing"])
    assert counts == {"d_labitems": t.items.count()}
    monkeypatch.setattr("sys.argv", ["cohortloom", "bronze", "--source", source, "--lake", home,
                                     "--tables", "patients"])
    assert cli.main() == 1 and "patients" in capsys.readouterr().err
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["gold"])
    given = cli.parser().parse_args(["gold", "--lake", home, "--no-balance", "--run-id", "r"])
    assert given.no_balance and given.min_coverage == 0.02


def numbered_rows(spark):
    rows = spark.range(120).select(
        F.col("id").alias("subject_id"), F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split"),
        (F.col("id") % 7 > 3).cast("double").alias("label"), (F.col("id") % 7).cast("double").alias("a"),
        (F.col("id") % 2).cast("double").alias("b"))
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    return rows.select("subject_id", "split", "label", "features")


def test_small_trees_are_grown_in_few_parts_within_the_same_bound(spark, monkeypatch):
    rows = numbered_rows(spark)
    train, held_out = rows.where("split = 'train'"), rows.where("split = 'test'")
    forest = RandomForestClassifier(numTrees=12, maxDepth=30, minInstancesPerNode=3, seed=7)
    monkeypatch.setattr(training, "MOST_NODES", 110)
    parts, store = [], training.materialise
    monkeypatch.setattr(training, "materialise", lambda df, name: parts.append(name) or store(df, name))
    assert training.forest_parts(12, 80) == [2] * 6
    got = {r.subject_id: r.score for r in training.forest_scores(forest, train, held_out, 80).collect()}
    assert len(parts) < 6

    want, grown, nodes = dict.fromkeys(got, 0.0), 0, 0
    for i in range(len(parts)):
        n = min(12 - grown, max(2, training.small_trees(80, grown, nodes)) if grown else 2)
        own = forest.copy({forest.numTrees: n, forest.seed: 7 + i * training.SEED_STEP}).fit(train)
        assert own.totalNumNodes <= 110
        grown, nodes = grown + n, nodes + own.totalNumNodes
        for r in own.transform(held_out).select(
                "subject_id", vector_to_array("probability")[1].alias("p")).collect():
            want[r.subject_id] += n * r.p / 12
    assert grown == 12 and len(got) == 40
    assert all(abs(got[k] - want[k]) < 1e-12 for k in got)
    # Many rows bound a part even where trees have hardly any nodes.
    assert training.small_trees(training.MOST_DRAWS // 4, 10, 30) <= 4


def test_models_are_fitted_side_by_side(spark, monkeypatch):
    together, declared = threading.Barrier(3, timeout=60), training.classifiers

    class Waiting:
        """Fits only when all the others have begun."""

        def __init__(self, estimator):
            self.estimator = estimator

        def __getattr__(self, name):
            return getattr(self.estimator, name)

        def fit(self, rows):
            together.wait()
            return self.estimator.fit(rows)

    monkeypatch.setattr(training, "classifiers", lambda *a: {
        k: Waiting(v) for k, v in declared(*a).items()})
    df = spark.range(120).select(
        F.col("id").alias("subject_id"), (F.col("id") % 2).cast("int").alias("label"),
        F.element_at(F.array(*map(F.lit, ("train", "validation", "test"))),
                     (F.col("id") % 3 + 1).cast("int")).alias("split"),
        (F.col("id") % 11).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    found = training.train_classifiers(df, ["a", "b"], trees=3, rounds=2, depth=4)
    counts = {(r.model_name, r.split): r["count"] for r in found.groupBy("model_name", "split").count().collect()}
    assert counts == {(m, s): 40 for m in declared(1) for s in ("validation", "test")}


def test_fitted_statistics_are_planned_once_however_many_columns_use_them(spark):
    names = [f"x{i}" for i in range(6)]
    df = spark.range(40).select("id", *[
        F.when(F.col("id") % (i + 2) != 0, F.col("id") * (i + 1.0)).alias(n) for i, n in enumerate(names)])
    fit_on = F.col("id") < 30
    ready = prep.standardise(prep.impute_median(df, names, fit_on), names, fit_on)
    assert ready.columns == df.columns
    plan = ready._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery#") < 10
    assert ready.where("x0 is null or isnan(x0)").count() == 0
