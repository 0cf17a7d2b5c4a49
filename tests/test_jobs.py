from __future__ import annotations

import pytest
from conftest import moment
from pyspark.sql import functions as F

from cohortloom.catalog.scans import _first_admissions, write_raw
from cohortloom.catalog.tables import ORDER_RULES, Tables
from cohortloom.operators import monitors
from cohortloom.operators.cleaning import clean_events
from cohortloom.operators.quality import QualityError, Suite
from cohortloom.plans import warehouse
from cohortloom.plans.jobs import (
    bronze_ingest,
    build_gold,
    build_silver,
    publish_warehouse,
)
from cohortloom.sources import lake, manifest
from cohortloom.sources.schemas import TABLES
from cohortloom.sources.warehouse_sink import Warehouse, publish_history, publish_jdbc
from cohortloom.streaming.incremental import load_events, raw_event_stream


@pytest.fixture(scope="module")
def home(spark, small, tmp_path_factory):
    """Raw files of the orders view taken through all three layers."""
    source = str(tmp_path_factory.mktemp("raw"))
    home = lake.Lake(str(tmp_path_factory.mktemp("lake")))
    t = Tables(spark, small)
    write_raw(t.raw_patients, source, "patients")
    write_raw(_first_admissions(t), source, "admissions")
    write_raw(t.raw_diagnoses, source, "diagnoses_icd")
    write_raw(t.items, source, "d_labitems")
    write_raw(t.raw_labs.withColumn("subject_id", F.col("hadm_id")), source, "labevents")
    points = t.raw_admissions.select(
        "subject_id", F.col("hadm_id").alias("study_id"), F.lit("f").alias("file_name"),
        F.col("admittime").alias("ecg_time"), F.lit("p.hea").alias("path"))
    write_raw(points, source, "ecg_record_list")
    counts = bronze_ingest(spark, source, home, skip_missing=True)
    assert set(counts) == set(TABLES) - {"chartevents"}
    silver = build_silver(spark, home, ORDER_RULES)
    gold = build_gold(spark, home, ORDER_RULES, run_id="run-a")
    return home, source, counts, silver, gold


def test_layers_end_to_end(spark, home):
    lake_home, _, counts, silver, gold = home
    assert counts["labevents"] == 6000 and silver["patients"] == 150
    cohort = lake.read_layer(spark, lake_home, "gold", "cohort")
    assert gold["cohort"] == cohort.count() == cohort.select("subject_id").distinct().count()
    assert {r.label for r in cohort.select("label").distinct().collect()} == {0, 1}
    mart = lake.read_layer(spark, lake_home, "gold", "feature_mart")
    assert mart.count() == gold["cohort"]
    types = dict(mart.dtypes)
    assert types["has_ecg"] == "boolean" and types["died_in_hospital"] == "boolean"
    assert all(len(c) <= 63 for c in mart.columns)
    labs = lake.read_layer(spark, lake_home, "silver", "labevents")
    assert dict(labs.dtypes)["is_acute_marker"] == "boolean"
    assert labs.where("hours_from_admit < 0").count() == 0
    results = spark.read.parquet(lake_home.quality)
    # 17 bronze checks less the one of the absent table, 14 silver, 16 gold
    assert results.count() == 17 - 1 + 14 + 16


def test_rerun_changes_nothing_but_appends_coverage_history(spark, home):
    lake_home, *_ = home
    before = sorted(lake.read_layer(spark, lake_home, "gold", "cohort")
                    .select("subject_id", "hadm_id", "split").collect())
    build_gold(spark, lake_home, ORDER_RULES, run_id="run-b")
    after = sorted(lake.read_layer(spark, lake_home, "gold", "cohort")
                   .select("subject_id", "hadm_id", "split").collect())
    assert before == after
    history = spark.read.parquet(lake_home.coverage_history)
    assert history.groupBy("_run_id").count().count() == 2
    assert monitors.null_rate_drift(history).count() == 0


def test_models_over_the_published_layers(spark, home):
    lake_home, *_ = home
    sources = {n: lake.read_layer(spark, lake_home, "gold", n)
               for n in ("cohort", "lab_features", "feature_mart", "feature_coverage")}
    sources["dq_results"] = spark.read.parquet(lake_home.quality)
    models = warehouse.build_models(sources, ORDER_RULES)
    assert len(models) == 14
    warehouse.register_views(models)
    assert spark.sql("select * from dim_patient").count() == sources["cohort"].count()
    assert all(m.count() > 0 for m in models.values())


def test_publication_drops_internal_lineage(spark, home):
    lake_home, *_ = home
    seen = {}
    done = publish_warehouse(
        spark, lake_home, Warehouse("jdbc:none", 2),
        write=lambda df, target, table, mode: seen.update({table: (df.columns, mode)}))
    assert sorted(done) == sorted(seen) and "dq_results" in seen
    columns, mode = seen["cohort"]
    assert mode == "overwrite" and "_run_id" in columns and "_source" not in columns
    results = spark.read.parquet(lake_home.quality)
    fresh = {}
    publish_history(results, results.where("layer = 'gold'"), Warehouse("jdbc:none", 2),
                    write=lambda df, *a, **k: fresh.update(n=df.count()))
    assert fresh["n"] == results.where("layer <> 'gold'").count()


def test_jdbc_options():
    calls = {}

    class Writer:
        def format(self, kind):
            calls["format"] = kind
            return self

        def options(self, **settings):
            calls["options"] = settings
            return self

        def mode(self, m):
            calls["mode"] = m
            return self

        def save(self):
            calls["saved"] = True

    class Frame:
        write = Writer()

    with pytest.raises(TypeError, match="connections"):
        Warehouse("jdbc:x")
    publish_jdbc(Frame(), Warehouse("jdbc:x", 4, properties={"user": "u"}), "cohort")
    assert calls == {"format": "jdbc", "mode": "overwrite", "saved": True, "options": {
        "user": "u", "url": "jdbc:x", "dbtable": "lake.cohort", "batchsize": "10000",
        "numPartitions": "4", "truncate": "true"}}


def test_failing_gate_blocks_the_write_and_absent_files_are_told_apart(spark, home, tmp_path):
    _, source, *_ = home
    target = lake.Lake(str(tmp_path))
    few = spark.createDataFrame([(1, "a", "b", "c")], "itemid int, label string, fluid string, "
                                                      "category string")
    write_raw(few, str(tmp_path / "raw"), "d_labitems")
    with pytest.raises(QualityError, match="row_count_between_5_inf"):
        bronze_ingest(spark, str(tmp_path / "raw"), target, tables=["d_labitems"],
                      skip_missing=True)
    assert lake.read_optional(spark, target, "bronze", "d_labitems") is None
    assert spark.read.parquet(target.quality).count() == 3
    with pytest.raises(QualityError, match="PATH_NOT_FOUND"):
        bronze_ingest(spark, source, target, tables=["chartevents"])
    with pytest.raises(KeyError, match="nothing"):
        lake.read_raw(spark, source, "nothing")


def test_csv_cells_that_do_not_parse_are_null(spark, tmp_path):
    (tmp_path / "x.csv").write_text(
        'itemid,label,fluid,category\n1,"say ""hi"", now",Blood,\nseven,b,c,d\n')
    rows = lake.read_csv(spark, str(tmp_path / "x.csv"), TABLES["d_labitems"].schema).collect()
    assert [tuple(r) for r in rows] == [(1, 'say "hi", now', "Blood", None),
                                        (None, "b", "c", "d")]


def test_histories_and_runs_are_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([("r1", "a", 1), ("r2", "a", 2)], "run_id string, m string, v int")
    path = str(tmp_path / "h")
    assert lake.append_history(rows, path, ["run_id", "m"]) == 2
    assert lake.append_history(rows, path, ["run_id", "m"]) == 0
    runs = str(tmp_path / "r")
    def stored():
        return sorted((r.run_id, r.v) for r in lake.read_runs(spark, runs, rows.schema).collect())

    lake.replace_run(rows, runs, "r1")
    lake.replace_run(rows, runs, "r2")
    lake.replace_run(rows.withColumn("v", F.lit(9)), runs, "r2")
    assert stored() == [("r1", 1), ("r2", 9)]
    # A rerun without rows leaves none; a run that looks like a number stays text.
    lake.replace_run(rows.where("v > 99"), runs, "r2")
    dated = rows.withColumn("run_id", F.lit("20240101"))
    lake.replace_run(dated.where("m = 'a'").limit(1), runs, "20240101")
    assert stored() == [("20240101", stored()[0][1]), ("r1", 1)]


def test_partitioned_writes_are_rebalanced(spark, tmp_path):
    df = spark.range(0, 4000, 1, 40).withColumn("p", (F.col("id") % 4).cast("int"))
    path = tmp_path / "t"
    assert lake.write_parquet(df, str(path), partition_by=["p"]) == 4000
    files = list(path.glob("p=*/*.parquet"))
    assert 4 <= len(files) <= 8
    assert spark.read.parquet(str(path)).count() == 4000


def test_headers_and_manifest(spark, tmp_path):
    raw = spark.createDataFrame([(1, 2, "a/b.dat", "t")], ["Subject ID", "study", "Path", "start"])
    found = manifest.harmonise_columns(raw)
    assert found.columns == ["subject_id", "study_id", "path", "ecg_time"]
    with pytest.raises(ValueError, match="subject_id"):
        manifest.harmonise_columns(raw.withColumn("subject_2", F.lit(1)))
    manifest.write_manifest(found, str(tmp_path))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "files")).collect()) == [
        "a/b.dat", "a/b.hea"]


def test_run_id_comes_from_the_environment(monkeypatch):
    monkeypatch.delenv("RUN_ID", raising=False)
    monkeypatch.delenv("AIRFLOW_CTX_LOGICAL_DATE", raising=False)
    assert lake.current_run_id() == "manual"
    monkeypatch.setenv("AIRFLOW_CTX_LOGICAL_DATE", "2024-01-01")
    assert lake.current_run_id() == "2024-01-01"
    monkeypatch.setenv("RUN_ID", "x")
    assert lake.current_run_id() == "x"


def metric_rows(spark, values):
    rows = [(f"r{i}", moment(f"2024-01-0{i + 1} 00:00:00"), "m", "test", "roc_auc", v)
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "run_id string, trained_at timestamp, model_name string, "
                                       "split string, metric_name string, metric_value double")


@pytest.mark.parametrize(("values", "run", "verdict", "passed"), [
    ([0.80, 0.82, 0.81], "r2", "within_tolerance", True),
    ([0.80, 0.82, 0.70], "r2", "regression", False),
    ([0.80, 0.82], "r1", "short_history", True),
    ([0.80, 0.82], "r9", "no_metric", False),
    ([], "r0", "no_history", True),
])
def test_regression_gate(spark, values, run, verdict, passed):
    row = monitors.regression_gate(metric_rows(spark, values), run).first()
    assert (row.verdict, row.passed) == (verdict, passed)


def test_stream_equals_batch(spark, small, tmp_path):
    t = Tables(spark, small)
    folder = str(tmp_path / "in")
    raw = t.raw_labs.withColumn("subject_id", F.col("hadm_id"))
    from cohortloom.catalog.scans import as_raw_file

    as_raw_file(raw, "labevents").repartition(3, "hadm_id").write.csv(
        folder, header=True, escape='"')
    target = lake.Lake(str(tmp_path / "lake"))
    stays = lake.materialise(t.admissions, "stays")
    items = lake.materialise(t.dictionary, "items")
    suite = Suite("silver", "labevents_stream").not_null("valuenum")

    def load():
        load_events(raw_event_stream(spark, folder, 1), lambda: stays, lambda: items, target,
                    rules=ORDER_RULES, suite=suite,
                    checkpoint=str(tmp_path / "checkpoint")).awaitTermination(120)

    load()
    keys = ["hadm_id", "itemid", "charttime", "valuenum"]
    batch = clean_events(raw, stays, items, ORDER_RULES)

    def streamed():
        return spark.read.parquet(target.path("silver", "labevents_stream"))

    def rows(df):
        return sorted(map(tuple, df.select(*keys).withColumn(
            "charttime", F.col("charttime").cast("timestamp")).collect()))

    assert streamed().select("batch").distinct().count() == 3
    assert rows(streamed()) == rows(batch)
    # Old rows that come again add nothing; one that was never there is kept, however late.
    late = raw.join(batch.orderBy("charttime", "hadm_id", "itemid").limit(1).select("hadm_id", "itemid"),
                    ["hadm_id", "itemid"])
    more = late.unionByName(late.withColumn("valuenum", F.col("valuenum") + 1000))
    as_raw_file(more, "labevents").coalesce(1).write.mode("append").csv(
        folder, header=True, escape='"')
    load()
    assert rows(streamed()) == rows(clean_events(
        raw.unionByName(more), stays, items, ORDER_RULES))


def test_keys_above_32_bits_are_read(spark, tmp_path):
    (tmp_path / "x.csv").write_text("itemid,label,fluid,category\n3000000000,a,b,c\n")
    rows = lake.read_csv(spark, str(tmp_path / "x.csv"), TABLES["d_labitems"].schema)
    assert rows.first().itemid == 3_000_000_000
