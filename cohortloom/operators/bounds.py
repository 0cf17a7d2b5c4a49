"""Cutting ordered data by its own distribution.

A quantile sketch is built while the rows are read, one per task, and merged into one.
Its quantiles are the bounds of bins with about as many rows each, wherever the values
lie: any bin, and so any bin of any group, holds a bounded share of all rows. What is
computed inside and across the bins stays exact, because every row has exactly one bin
and bins follow the order of the values; the sketch decides their width only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import as_column

#: Bins of one cut, and the sketch's size: its ranks are off by less than 0.001.
RANGE_BINS = 1024
SKETCH_SIZE = 8192


def number_array(numbers: list[float]) -> Column:
    """A constant array, written as one text that the optimizer folds."""
    return F.split(F.lit(",".join(map(repr, numbers))), ",").cast("array<double>")


def bounds_and(df: DataFrame, value: Column | str, bins: int, also: Column) -> tuple[list[float], object]:
    """The bounds of ``value_bounds``, and another aggregate of the same pass."""
    ranks = number_array([i / bins for i in range(1, bins)] or [0.5])
    sketch = F.kll_sketch_agg_double(as_column(value).cast("double"), SKETCH_SIZE)
    number = F.kll_sketch_get_n_double("sketch")
    row = df.agg(sketch.alias("sketch"), also.alias("also")).select(
        F.when(number > 0, F.kll_sketch_get_quantile_double("sketch", ranks)).alias("bounds"),
        "also").first()
    return sorted(set(row.bounds or [])) if bins > 1 else [], row.also


def value_bounds(df: DataFrame, value: Column | str, bins: int = RANGE_BINS) -> list[float]:
    """At most ``bins`` - 1 rising values that cut the rows into parts of about one size.

    Runs one job over the column and brings back one row. Nulls and NaN are left out;
    a value that many rows share appears once. Sketches are drawn with chance, so the
    bounds are taken once and become constants: every use in a plan, and every attempt
    of a task, sees the same.
    """
    return bounds_and(df, value, bins, F.lit(None))[0]


def with_bin(df: DataFrame, value: Column | str, bounds: list[float], out: str = "_bin"
             ) -> DataFrame:
    """Adds how many bounds are not above the value; 0 for a null.

    Found by halving inside one expression: as a chain of projections the steps compile
    better, but the optimizer's constraints on the chain double with each of them.
    """
    number = as_column(value).cast("double")
    if not bounds:
        return df.withColumn(out, F.lit(0))
    held = number_array(bounds)
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))))
    return df.withColumn(out, F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(held, at + step - 1) <= number, at + step).otherwise(at)))


def with_bin_by_steps(df: DataFrame, value: Column | str, bounds: list[float], out: str = "_bin"
                      ) -> DataFrame:
    """As ``with_bin``, one projection per step: for plans that the optimizer cannot take
    with the one expression.

    A step names the step before twice. Rules that follow a join key down to the scan write
    all steps out as one expression, which grows by that factor with each of them.
    """
    number = as_column(value).cast("double")
    df = df.withColumn(out, F.lit(0))
    held = number_array(bounds)
    for step in (1 << i for i in reversed(range(len(bounds).bit_length()))):
        at = F.col(out)
        df = df.withColumn(out, at + F.when(
            F.get(held, at + (step - 1)) <= number, F.lit(step)).otherwise(F.lit(0)))
    return df
