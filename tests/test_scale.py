"""Steps that grew with the rows where they need not."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortloom.operators import features
from cohortloom.plans import training


def test_a_large_forest_is_grown_in_parts_and_scores_are_the_mean_of_all_trees(spark, monkeypatch):
    rows = spark.range(120).select(
        F.col("id").alias("subject_id"), F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split"),
        (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 7).cast("double").alias("a"),
        (F.col("id") % 11).cast("double").alias("b"))
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).select(
        "subject_id", "split", "label", "features")
    train, held_out = rows.where("split = 'train'"), rows.where("split = 'test'")
    forest = RandomForestClassifier(numTrees=5, maxDepth=30, minInstancesPerNode=3, seed=7)
    assert training.forest_parts(300, 1000) == [300]
    assert max(training.forest_parts(300, 300_000)) * 200_000 <= training.MOST_NODES

    monkeypatch.setattr(training, "MOST_NODES", 110)
    parts = training.forest_parts(5, 80)
    assert parts == [2, 2, 1]
    want = {}
    for i, n in enumerate(parts):
        own = forest.copy({forest.numTrees: n, forest.seed: 7 + i * training.SEED_STEP}).fit(train)
        assert own.totalNumNodes <= 110
        for r in own.transform(held_out).select(
                "subject_id", vector_to_array("probability")[1].alias("p")).collect():
            want[r.subject_id] = want.get(r.subject_id, 0.0) + n * r.p / 5
    got = {r.subject_id: r.score for r in training.forest_scores(forest, train, held_out, 80).collect()}
    assert got.keys() == want.keys() and len(got) == 40
    assert all(abs(got[k] - want[k]) < 1e-12 for k in got)
    # The forest of a small table is fitted whole, as by itself.
    monkeypatch.undo()
    one = {r.subject_id: r.score for r in training.forest_scores(forest, train, held_out, 80).collect()}
    whole = forest.fit(train).transform(held_out).select(
        "subject_id", vector_to_array("probability")[1].alias("p"))
    assert one == {r.subject_id: r.p for r in whole.collect()}


def test_labels_are_named_once_and_not_in_every_row(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    clean = features.normalise_label

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    monkeypatch.setattr(features, "normalise_label", lambda label: clean(counted(F.col(label))))
    long = spark.range(5000).select(
        F.col("id").alias("hadm_id"), F.col("id").alias("itemid"),
        F.concat(F.lit("Lab "), (F.col("id") % 3).cast("string")).alias("label"),
        F.col("id").cast("double").alias("feature_value"))
    assert features.feature_columns(long) == [("Lab 0", "lab_0"), ("Lab 1", "lab_1"), ("Lab 2", "lab_2")]
    assert seen.value <= 100
