"""Incremental loading of measurements as files arrive.

A stream of raw CSV files goes through the same cleaning as the batch job, one
micro-batch at a time, and is appended behind the same quality gate.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortloom.operators.cleaning import clean_events
from cohortloom.operators.quality import Suite
from cohortloom.rules import RULES, StudyRules
from cohortloom.sources.lake import Lake, RawFormat, materialise, read_history, with_lineage
from cohortloom.sources.schemas import TABLES

EVENT_KEYS = ("hadm_id", "itemid", "charttime", "valuenum")


def raw_event_stream(spark: SparkSession, folder: str, max_files: int | None = None
                     ) -> DataFrame:
    """New measurement files of a folder, with the declared schema."""
    reader = RawFormat().open(spark.readStream, TABLES["labevents"].schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def not_loaded(batch: DataFrame, target: str, number: int) -> DataFrame:
    """Rows of a batch whose keys no other batch has stored, however late they come.

    Only the stored batches' key columns are read. A batch that is replayed does
    not see what it wrote itself.
    """
    known = read_history(batch.sparkSession, target)
    if known is None:
        return batch
    keys = known.where(F.col("batch") != number).select(
        *(F.col(c).alias(f"_{c}") for c in EVENT_KEYS)).distinct()
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in EVENT_KEYS))
    return batch.join(keys, same, "left_anti")


def load_events(
    stream: DataFrame, stays: Callable[[], DataFrame], dictionary: Callable[[], DataFrame],
    lake: Lake, *, rules: StudyRules = RULES, suite: Suite | None = None, checkpoint: str,
) -> StreamingQuery:
    """Clean each micro-batch, check it and append it; started with availableNow.

    ``stays`` and ``dictionary`` are read anew for every batch. Nothing is dropped
    for being late: repeats are told from what is stored, so the stream keeps no
    state. The batch number is part of the output path's partitioning and each batch
    overwrites only its own partition, so a batch replayed after a failure replaces
    itself instead of appearing twice.
    """
    target = lake.path("silver", "labevents_stream")

    def load(batch: DataFrame, number: int) -> None:
        cleaned = clean_events(batch, stays(), dictionary(), rules)
        ready = materialise(not_loaded(cleaned, target, number), "labevents-batch")
        if suite is not None:
            suite.run(ready, persist_to=lake.quality, run_id=f"batch-{number}")
        with_lineage(ready, "silver.labevents", f"batch-{number}").withColumn(
            "batch", F.lit(number)
        ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch"
        ).parquet(target)

    return (
        stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
