"""Registration of named queries and of the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortloom.catalog import sql as shared_sql
from cohortloom.catalog.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The builders by themselves: several can share the derived layers of one ``Tables``.
BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {}


def query(name: str, sql: str | None = None):
    """Register a builder ``Tables -> DataFrame`` and, when there is one, its SQL.

    ``sql`` may use the shared definitions of ``catalog.sql`` by name.
    """
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain_times(build(Tables(spark, folder)))

        QUERIES[name] = run
        BUILDERS[name] = build
        if sql is not None:
            ORACLES[name] = shared_sql.with_definitions(sql)
        return build

    return register


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables hold them."""
    casts = {c: df[c].cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"}
    return df.withColumns(casts) if casts else df
