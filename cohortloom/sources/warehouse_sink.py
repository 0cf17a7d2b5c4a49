"""Batched JDBC publication of finished tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from cohortloom.sources.lake import drop_lineage, new_history_rows

PUBLISHED = ("cohort", "lab_features", "feature_mart", "feature_coverage")
KEPT_LINEAGE = ("_run_id", "_loaded_at")
HISTORY_KEYS = ("run_id", "checked_at", "layer", "table_name", "check_name")


@dataclass(frozen=True)
class Warehouse:
    """A database to publish to, and how much it takes at once.

    ``connections`` bounds the tasks that write side by side: what the database
    can take, whatever the cluster has.
    """

    url: str
    connections: int
    schema: str = "lake"
    properties: Mapping[str, str] = field(default_factory=dict)
    rows_per_batch: int = 10_000

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}"

    def options(self, name: str) -> dict[str, str]:
        """Settings of Spark's JDBC sink for one table."""
        return {
            **self.properties, "url": self.url, "dbtable": self.table(name),
            "batchsize": str(self.rows_per_batch), "numPartitions": str(self.connections),
            # An overwrite empties the table; its definition and grants stay.
            "truncate": "true",
        }


def publish_jdbc(df: DataFrame, warehouse: Warehouse, table: str, *, mode: str = "overwrite"
                 ) -> None:
    df.write.format("jdbc").options(**warehouse.options(table)).mode(mode).save()


def publish_tables(tables: Mapping[str, DataFrame], warehouse: Warehouse, *,
                   mode: str = "overwrite", write=publish_jdbc) -> list[str]:
    done = []
    for name in PUBLISHED:
        if name in tables:
            write(drop_lineage(tables[name], KEPT_LINEAGE), warehouse, name, mode=mode)
            done.append(name)
    return done


def publish_history(results: DataFrame, published: DataFrame, warehouse: Warehouse,
                    write=publish_jdbc) -> None:
    """Append the quality results the warehouse does not have yet."""
    fresh = new_history_rows(results, published, HISTORY_KEYS)
    write(fresh, warehouse, "dq_results", mode="append")
