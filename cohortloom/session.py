"""Session settings and the shared folder jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Whole-table rewrites stay static; the run-scoped writers ask for dynamic
    # overwrite on their own write only.
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's defaults; ``settings`` win over them.

    Cluster sizing (executors, memory, shuffle partitions) stays with
    spark-submit: nothing here overrides what the deployment chose.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
