"""Measures over a moving span of time in a key, with one long key as many tasks.

Rows are cut into bins of time by a sketch of the moments. A bin's windows need the rows
of the span before it, so each row is copied to the later bins that its span reaches
into. The bins of a key are then independent of each other.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.asof import micros
from cohortloom.operators.bounds import RANGE_BINS, value_bounds, with_bin_by_steps


def rolling(df: DataFrame, measures: Mapping[str, Column], *, by: str, at: str, seconds: int,
            bins: int = RANGE_BINS) -> DataFrame:
    """Adds each measure, an aggregate of columns, over the rows of the same ``by`` from
    ``seconds`` before the row's moment up to it; rows of that moment all count.

    Rows with a null ``by`` or moment are kept with null measures. A row is copied as
    often as bins begin within ``seconds`` after it: few while the span is short next
    to the time a bin covers, ``bins`` at most. Bounds are taken by a job over the
    moments.
    """
    span = seconds * 1_000_000
    placeable = F.col(by).isNotNull() & F.col(at).isNotNull()
    rows = df.where(placeable).withColumns({"_at": micros(at), "_until": micros(at) + F.lit(span)})
    bounds = value_bounds(rows, "_at", bins)
    rows = with_bin_by_steps(with_bin_by_steps(rows, "_at", bounds, "_home"), "_until", bounds, "_last")
    copies = rows.withColumn("_bin", F.explode(F.sequence("_home", "_last")))
    span_before = Window.partitionBy(by, "_bin").orderBy("_at").rangeBetween(-span, 0)
    measured = copies.withColumns({name: m.over(span_before) for name, m in measures.items()})
    found = measured.where(F.col("_bin") == F.col("_home")).select(*df.columns, *measures)
    return found.unionByName(df.where(~placeable), allowMissingColumns=True)


def trend(value: str, hours: str) -> dict[str, Column]:
    """Number, mean and slope per hour of a measurement."""
    return {"n_in_span": F.count(value), "mean_in_span": F.avg(value),
            "slope_in_span": F.regr_slope(F.col(value), F.col(hours))}
