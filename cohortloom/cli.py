"""The jobs from the command line: ``python -m cohortloom.cli bronze --source ... --lake ...``."""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Sequence

from cohortloom.operators.quality import QualityError
from cohortloom.plans.jobs import bronze_ingest, build_gold, build_silver, publish_warehouse
from cohortloom.plans.training_job import RegressionError, train_and_record
from cohortloom.session import build_session
from cohortloom.sources.lake import Lake, current_run_id
from cohortloom.sources.warehouse_sink import PUBLISHED, Warehouse

#: The password is never an argument, which other users of a machine could read.
PASSWORD = "WAREHOUSE_PASSWORD"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cohortloom")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        one = jobs.add_parser(name, help=text)
        one.add_argument("--lake", required=True, help="root folder of the lake")
        one.add_argument("--master", help="Spark master; by default what spark-submit gives")
        return one

    bronze = job("bronze", "raw files to typed tables")
    bronze.add_argument("--source", required=True)
    bronze.add_argument("--tables", nargs="+")
    bronze.add_argument("--skip-missing", action="store_true")
    bronze.add_argument("--repartition", type=int)
    job("silver", "typed tables to cleaned ones")
    gold = job("gold", "cleaned tables to cohort and features")
    gold.add_argument("--min-coverage", type=float, default=0.02)
    gold.add_argument("--no-balance", action="store_true")
    gold.add_argument("--run-id")
    train = job("train", "fit the models, record their metrics, fail on a regression")
    train.add_argument("--run-id")
    train.add_argument("--max-drop", type=float, default=0.03)
    publish = job("publish", "gold tables to the warehouse")
    publish.add_argument("--url", required=True)
    publish.add_argument("--user", required=True)
    publish.add_argument("--schema", default="lake")
    publish.add_argument("--connections", type=int, default=8)
    publish.add_argument("--tables", nargs="+", default=list(PUBLISHED))
    publish.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    return top


def run(arguments: Sequence[str] | None = None) -> dict:
    """Run the job that the arguments name; returns what it reports."""
    given = parser().parse_args(arguments)
    spark, lake = build_session(f"cohortloom-{given.job}", given.master), Lake(given.lake)
    if given.job == "bronze":
        return bronze_ingest(spark, given.source, lake, tables=given.tables,
                             skip_missing=given.skip_missing, repartition=given.repartition)
    if given.job == "silver":
        return build_silver(spark, lake)
    if given.job == "gold":
        return build_gold(spark, lake, min_coverage=given.min_coverage,
                          balance=not given.no_balance, run_id=given.run_id)
    if given.job == "train":
        done = train_and_record(spark, lake, given.run_id or current_run_id(), max_drop=given.max_drop)
        return {"best": done.best.asDict(), "gate": done.gate.asDict()}
    warehouse = Warehouse(given.url, given.connections, given.schema, {
        "user": given.user, "password": os.environ[PASSWORD]})
    return {"published": publish_warehouse(spark, lake, warehouse, tables=given.tables, mode=given.mode)}


def main() -> int:
    try:
        print(json.dumps(run(), default=str))
    except (QualityError, RegressionError) as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
