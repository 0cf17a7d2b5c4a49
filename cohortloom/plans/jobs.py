"""The layer-to-layer jobs. Every one returns the row counts it wrote."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from cohortloom.operators.cleaning import (
    clean_admissions,
    clean_diagnoses,
    clean_events,
    clean_lab_dictionary,
    clean_patients,
    clean_point_records,
)
from cohortloom.operators.cohort import build_cohort, only_in
from cohortloom.operators.features import (
    build_feature_mart,
    coverage_report,
    feature_columns,
    lab_features,
    mart_columns,
    pivot_features,
)
from cohortloom.operators.quality import QualityError, Suite
from cohortloom.plans.suites import bronze_suite, gold_suites, silver_suites
from cohortloom.rules import RULES, StudyRules
from cohortloom.sources.files import Files
from cohortloom.sources.lake import (
    Lake,
    append_history,
    drop_lineage,
    path_missing,
    read_history,
    read_layer,
    read_optional,
    read_raw,
    with_lineage,
    write_parquet,
)
from cohortloom.sources.schemas import TABLES
from cohortloom.sources.warehouse_sink import (
    PUBLISHED,
    Warehouse,
    publish_history,
    publish_jdbc,
    publish_tables,
)

log = logging.getLogger("cohortloom.jobs")


def gated_write(df: DataFrame, suite: Suite | None, lake: Lake, layer: str, table: str, *,
                partition_by: Sequence[str] = (), repartition: int | None = None,
                run_id: str | None = None) -> int:
    """Write once beside the table, check what was written, and publish it when it passes.

    Publishing renames folders: the table is away for the moment between two renames, and
    never half there. A table that fails leaves the old one as it is. Results of the
    checks are persisted before a failure is raised.
    """
    spark = df.sparkSession
    stamped = with_lineage(df, f"{layer}.{table}", run_id)
    files, staged = Files(spark, lake.root), f"_staging/{layer}-{table}-{uuid.uuid4().hex}"
    path = f"{files.root}/{staged}"
    rows = write_parquet(stamped, path, partition_by=partition_by, repartition=repartition)
    try:
        if suite is not None:
            ready = drop_lineage(spark.read.schema(stamped.schema).parquet(path))
            suite.run(ready, persist_to=lake.quality, run_id=run_id)
    except QualityError:
        files.delete(staged)
        raise
    files.replace(staged, f"{layer}/{table}")
    return rows


def bronze_ingest(spark: SparkSession, source: str, lake: Lake, *,
                  tables: Iterable[str] | None = None, skip_missing: bool = False,
                  repartition: int | None = None) -> dict[str, int]:
    """Raw files to typed tables. A failing table does not stop the others, but
    fails the job at the end. ``skip_missing`` excuses absent files only."""
    counts, failures = {}, []
    for table in sorted(TABLES) if tables is None else tables:
        try:
            raw = read_raw(spark, source, table)
            counts[table] = gated_write(
                raw, bronze_suite(table), lake, "bronze", table,
                partition_by=TABLES[table].partition_by, repartition=repartition,
            )
        except AnalysisException as error:
            if skip_missing and path_missing(error):
                log.warning("no file for %s, skipped", table)
                continue
            failures.append(f"{table}: {error}")
        except QualityError as error:
            failures.append(f"{table}: {error}")
    if failures:
        raise QualityError("; ".join(failures))
    return counts


def build_silver(spark: SparkSession, lake: Lake, rules: StudyRules = RULES) -> dict[str, int]:
    suites = silver_suites(rules)
    counts: dict[str, int] = {}

    def publish(df: DataFrame, table: str, **options) -> DataFrame:
        counts[table] = gated_write(df, suites.get(table), lake, "silver", table, **options)
        return read_layer(spark, lake, "silver", table)

    def bronze(table: str) -> DataFrame:
        return read_layer(spark, lake, "bronze", table)

    publish(clean_patients(bronze("patients"), rules), "patients")
    stays = publish(clean_admissions(bronze("admissions")), "admissions",
                    partition_by=["admit_year"])
    publish(clean_diagnoses(bronze("diagnoses_icd"), rules), "diagnoses")
    items = publish(clean_lab_dictionary(bronze("d_labitems"), rules), "lab_dictionary")
    publish(clean_events(bronze("labevents"), stays, items, rules), "labevents",
            partition_by=["marker_type"])
    points = read_optional(spark, lake, "bronze", "ecg_record_list")
    if points is not None:
        publish(clean_point_records(points, stays, rules), "ecg_records")
    return counts


def build_gold(spark: SparkSession, lake: Lake, rules: StudyRules = RULES, *,
               min_coverage: float = 0.02, balance: bool = True, mode: str = "murmur3",
               run_id: str | None = None) -> dict[str, int]:
    suites = gold_suites(rules)
    counts: dict[str, int] = {}

    def publish(df: DataFrame, table: str, **options) -> DataFrame:
        counts[table] = gated_write(
            df, suites.get(table), lake, "gold", table, run_id=run_id, **options
        )
        return read_layer(spark, lake, "gold", table).select(*df.columns)

    def silver(table: str) -> DataFrame:
        return read_layer(spark, lake, "silver", table)

    cohort = publish(
        build_cohort(silver("patients"), silver("admissions"), silver("diagnoses"), rules,
                     balance=balance, mode=mode),
        "cohort", partition_by=["split"],
    )
    events = only_in(silver("labevents"), cohort.select("hadm_id"), "hadm_id")
    long = publish(lab_features(events), "lab_features")
    columns = feature_columns(long, min_coverage, reserved=mart_columns(cohort))
    points = read_optional(spark, lake, "silver", "ecg_records")
    mart = publish(
        build_feature_mart(cohort, pivot_features(long, columns), points), "feature_mart",
        partition_by=["split"],
    )
    coverage = coverage_report(mart, [name for _, name in columns])
    published = publish(coverage, "feature_coverage")
    append_history(
        with_lineage(published, "gold.feature_coverage", run_id), lake.coverage_history,
        ["_run_id", "column_name"],
    )
    return counts


def publish_warehouse(spark: SparkSession, lake: Lake, warehouse: Warehouse, *,
                      tables: Iterable[str] = PUBLISHED, mode: str = "overwrite",
                      published: DataFrame | None = None, write=publish_jdbc) -> list[str]:
    """Gold tables and the new quality results to the warehouse.

    ``published`` holds the results the warehouse has already, when there are any;
    the write step transforms nothing.
    """
    frames = {t: read_layer(spark, lake, "gold", t) for t in tables}
    done = publish_tables(frames, warehouse, mode=mode, write=write)
    results = read_history(spark, lake.quality)
    if results is not None:
        publish_history(results, results.where("false") if published is None else published,
                        warehouse, write=write)
        done.append("dq_results")
    return done
