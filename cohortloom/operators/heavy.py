"""Keys that hold many rows, from a summary of counters kept while the rows are read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Counters of a summary. Counts are off by at most 3.5 / COUNTERS of all rows.
COUNTERS = 1 << 17


def heavy_keys(df: DataFrame, key: str, hot_rows: int, counters: int = COUNTERS,
               out: str = "_parts") -> DataFrame:
    """Keys with about ``hot_rows`` rows or more, and how many parts to cut each into.

    One job reads the key column alone: each task keeps up to ``counters`` counters of
    the keys it sees most, and the tasks' summaries are merged into one of the same
    size. Nothing is shuffled by key. A key with more rows than ``hot_rows`` and than
    7 / ``counters`` of all rows is always found; how many parts it gets follows its
    estimated count. The list has at most ``counters`` rows, and no more than rows /
    ``hot_rows``, so it may be broadcast. Nulls are left out. The list is taken once and
    is a constant of the plans that use it.
    """
    summary = F.expr(f"approx_top_k_accumulate(`{key}`, {counters})")
    found = df.where(F.col(key).isNotNull()).select(key).agg(summary.alias("summary")).select(
        F.explode(F.expr(f"approx_top_k_estimate(summary, {counters})")).alias("found"))
    hot = found.where(F.col("found.count") > hot_rows).select(
        F.col("found.item"), F.ceil(F.col("found.count") / hot_rows).alias(out)).collect()
    schema = T.StructType([df.schema[key], T.StructField(out, T.LongType())])
    return df.sparkSession.createDataFrame([tuple(r) for r in hot], schema)
