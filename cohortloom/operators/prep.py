"""Feature preparation fitted on training rows and applied to all rows.

Fitted statistics reach the rows as scalar subqueries: one row, computed by one
aggregation inside the same plan. A subquery is named once, as a column that the
others read: each mention would be planned by itself, with all that stands below it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators.ranking import exact_quantile

#: Holds the fitted statistics while they are applied.
FITTED = "_fitted_statistics"


def _missing(df: DataFrame, name: str) -> Column:
    gone = F.col(name).isNull()
    return gone | F.isnan(name) if isinstance(df.schema[name].dataType, T.FractionalType) else gone


def missing_indicators(df: DataFrame, columns: Sequence[str], suffix: str = "_missing"
                       ) -> DataFrame:
    """Zero-fill the columns and add a 0/1 column each that says what was filled."""
    flags = {f"{c}{suffix}": _missing(df, c).cast("int") for c in columns}
    filled = {c: F.when(_missing(df, c), F.lit(0)).otherwise(F.col(c)).cast("double")
              for c in columns}
    return df.withColumns(flags).withColumns(filled)


def standardise(df: DataFrame, columns: Sequence[str], fit_on: Column) -> DataFrame:
    """Zero mean and unit population variance over the fitting rows.

    A column that is constant there is centred and left unscaled.
    """
    moments = F.struct(*[
        field for c in columns
        for field in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_sd"))
    ])
    statistics = df.where(fit_on).agg(moments.alias("fitted")).scalar()
    fitted = F.col(FITTED)

    def scaled(name: str) -> Column:
        sd = fitted.getField(f"{name}_sd")
        unit = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        return (F.col(name) - fitted.getField(f"{name}_mean")) / unit

    return df.withColumn(FITTED, statistics).withColumns({c: scaled(c) for c in columns}).drop(FITTED)


def impute_median(df: DataFrame, columns: Sequence[str], fit_on: Column) -> DataFrame:
    """Fill missing values with the exact median of the fitting rows."""
    long = df.where(fit_on).unpivot(
        [], [F.when(~_missing(df, c), F.col(c).cast("double")).alias(c) for c in columns],
        "_column", "_value",
    )
    medians = exact_quantile(long, ["_column"], "_value").agg(F.struct(*[
        F.max(F.when(F.col("_column") == c, F.col("quantile"))).alias(c) for c in columns
    ]).alias("fitted")).scalar()
    return df.withColumn(FITTED, medians).withColumns({
        c: F.when(_missing(df, c), F.col(FITTED).getField(c)).otherwise(F.col(c)) for c in columns
    }).drop(FITTED)
