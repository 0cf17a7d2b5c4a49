"""A corpus pipeline: host rules, near copies, decontamination, mixing, sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import digest_bin
from cohortloom.llm.decontaminate import clean_documents
from cohortloom.llm.host_rules import judge_hosts
from cohortloom.llm.jaccard_join import keep_one_each
from cohortloom.llm.mixture import mix
from cohortloom.llm.reshard import reshard
from cohortloom.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

OLD_SHARDS, NEW_SHARDS = 6, 8


def whole_row(docs: DataFrame) -> Column:
    return F.struct(*(F.col(c) for c in docs.columns)).alias("_row")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that fail the base rules or stand on a rejected host."""
    rows = docs.select(whole_row(docs), "source", "text")
    return judge_hosts(rows, carry=("_row",)).where("kept").select("_row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones."""
    return keep_one_each(docs, by="component")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark window."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights draw them."""
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, and shard and slot, from six uneven shards into eight equal ones."""
    rows = docs.select(
        whole_row(docs), "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("_size"),
        F.xxhash64(*(F.col(c) for c in docs.columns)).alias("_tie"),
        digest_bin("source", OLD_SHARDS).alias("_old"))
    placed = reshard(rows, size="_size", old="_old", capacities=NEW_SHARDS,
                     order=["doc_id", "_tie"], old_shards=OLD_SHARDS)
    return placed.select("_row.*", "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("near_copies", near_copies),
    ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding),
]

#: Components of links and hash orders have no plain SQL; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
