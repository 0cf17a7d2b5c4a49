"""Ordering without handing a whole table, or a whole group, to one task.

Two tools carry the module. ``keep_first`` leans on Catalyst's group-limit
rewrite: each map task keeps one row per key before the shuffle, so a key that
holds a third of the table still sends only one row per task. ``binned_totals``
and ``binned_rank`` cut an ordered group into many bins, rank inside the bins
in parallel and shift by the totals of the bins before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.columns import ORDINAL_SPAN, hash_ordinal
from cohortloom.operators.bounds import RANGE_BINS, bounds_and, value_bounds, with_bin

DEFAULT_BINS = 65_536
#: Groups whose wanted bins, two rows each, are sent to all tasks; more are shuffled.
MOST_GROUPS = 100_000


def _sortable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (T.MapType, T.VariantType))


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), within: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the first by ``order``, ties settled by every other column.

    The order is total up to identical rows, so reruns, retries and
    repartitioning give the same row. ``within`` names columns that are a
    function of the keys and that the data is already partitioned by; naming
    them lets Spark reuse that partitioning.
    """
    fixed = {*keys, *within}
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in fixed and _sortable(df, c)]
    window = Window.partitionBy(*within, *keys).orderBy(*order, *(ties or [F.lit(1)]))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def first_per_group(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    return keep_first(df, [key], [F.col(c).asc() for c in order])


def _group(groups: Sequence[str]) -> Column:
    """The group columns as one value; structs compare NULL fields as equal."""
    return F.struct(F.lit(0).alias("_"), *groups)


def _bin_offsets(binned: DataFrame, weights: Sequence[str], descending: bool = False) -> DataFrame:
    """Per (group, bin): weight totals, and totals of all bins before it.

    The frame has one row per occupied bin, a number set by the bin width and
    not by the row count, so ordering it per group is cheap.
    """
    totals = binned.groupBy("_group", "_bin").agg(*[F.sum(w).alias(f"_bin_{w}") for w in weights])
    group = Window.partitionBy("_group")
    order = F.col("_bin").desc() if descending else F.col("_bin").asc()
    before = group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_group", "_bin",
        *[f"_bin_{w}" for w in weights],
        *[F.coalesce(F.sum(f"_bin_{w}").over(before), F.lit(0)).alias(f"_before_{w}")
          for w in weights],
        *[F.sum(f"_bin_{w}").over(group).alias(f"_all_{w}") for w in weights],
    )


def _inside_bin(order: Column, *ties: str):
    return Window.partitionBy("_group", "_bin").orderBy(order, *ties)


def _so_far(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def binned_totals(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    weights: Sequence[str],
    *,
    descending: bool = False,
    bounds: list[float] | None = None,
) -> DataFrame:
    """Running totals of ``weights`` over distinct values, per group.

    ``df`` has one row per (group, value). Adds ``running_<w>`` (up to and
    including the row) and ``total_<w>`` (the group's total). Bins are cut at
    ``bounds``, by default those of a sketch of the values, which takes a job.
    """
    if bounds is None:
        bounds = value_bounds(df, value)
    binned = with_bin(df.withColumn("_group", _group(groups)), value, bounds)
    placed = binned.join(_bin_offsets(binned, weights, descending), ["_group", "_bin"])
    inside = _so_far(_inside_bin(F.col(value).desc() if descending else F.col(value).asc()))
    return placed.select(
        *df.columns,
        *[(F.sum(w).over(inside) + F.col(f"_before_{w}")).alias(f"running_{w}") for w in weights],
        *[F.col(f"_all_{w}").alias(f"total_{w}") for w in weights],
    )


def binned_rank(
    df: DataFrame,
    strata: Sequence[str],
    ordinal: Column,
    ties: Sequence[str],
    *,
    span: int = ORDINAL_SPAN,
    bins: int = DEFAULT_BINS,
    at_most: Column | None = None,
) -> DataFrame:
    """Exact row number per stratum by (ordinal, ties), for ordinals in [0, span).

    Adds ``rank`` and ``stratum_rows``. A hash ordinal fills the bins evenly,
    so no task sorts more than about 1/bins of a stratum. With ``at_most``,
    bins that start past that rank are dropped before anything is shuffled.
    """
    numbered = (
        df.withColumn("_group", _group(strata))
        .withColumn("_ordinal", ordinal)
        .withColumn("_bin", F.floor(F.col("_ordinal") / F.lit(span // bins)))
        .withColumn("_n", F.lit(1).cast("long"))
    )
    offsets = _bin_offsets(numbered, ["_n"])
    if at_most is not None:
        offsets = offsets.where(F.col("_before__n") < at_most)
    placed = numbered.join(offsets, ["_group", "_bin"])
    ranked = placed.select(
        *df.columns,
        (F.row_number().over(_inside_bin(F.col("_ordinal"), *ties)) + F.col("_before__n"))
        .alias("rank"),
        F.col("_all__n").alias("stratum_rows"),
    )
    return ranked.where(F.col("rank") <= at_most) if at_most is not None else ranked


def hash_sample(
    df: DataFrame, keep: Column, key: str, salt: str, mode: str = "murmur3",
    bins: int = DEFAULT_BINS,
) -> DataFrame:
    """The ``keep`` rows with the lowest salted hash of ``key`` (ties by key)."""
    ordinal = hash_ordinal(key, salt, mode)
    return binned_rank(df, [], ordinal, [key], bins=bins, at_most=keep).select(*df.columns)


def exact_quantile(
    df: DataFrame, groups: Sequence[str], value: str, share: float = 0.5,
    bins: int = RANGE_BINS,
) -> DataFrame:
    """Interpolated quantile per group, exact, with no group held by one task.

    A sketch of all values cuts them into bins of about one size. One count per
    group and bin, combined before the shuffle, shows which one or two bins hold
    the wanted positions, and only the values of those are shuffled and sorted:
    about 1 / ``bins`` of the rows. The sketch's job also estimates the number of groups,
    so that the list of wanted bins is broadcast only while it is short. Returns the group columns and ``quantile``; a
    group without values has no row. NaN is larger than all other values.
    """
    rows = df.select(*groups, F.col(value).cast("double").alias("_value")).where(
        F.col("_value").isNotNull())
    bounds, n_groups = bounds_and(rows, "_value", bins, F.approx_count_distinct(F.xxhash64(
        F.lit(0), *groups)))
    binned = with_bin(rows.withColumns({"_group": _group(groups), "_n": F.lit(1).cast("long")}),
                      "_value", bounds)
    wanted = (
        _bin_offsets(binned, ["_n"])
        .withColumn("_position", F.lit(share) * (F.col("_all__n") - 1))
        .where(F.col("_before__n") <= F.ceil("_position"))
        .where(F.col("_before__n") + F.col("_bin__n") > F.floor("_position"))
        .select("_group", "_bin", "_before__n", "_position")
    )
    if n_groups <= MOST_GROUPS:
        wanted = F.broadcast(wanted)
    counts = binned.join(wanted, ["_group", "_bin"]).groupBy("_group", "_bin", "_value").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_before__n").alias("_before__n"),
        F.max("_position").alias("_position"))
    end = F.col("_before__n") + F.sum("_n").over(_so_far(_inside_bin(F.col("_value"))))
    ranked = counts.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_n"))

    def value_at(index: Column) -> Column:
        return F.max(F.when((F.col("_start") <= index) & (index < F.col("_end")), F.col("_value")))

    found = ranked.groupBy("_group").agg(
        value_at(F.floor("_position")).alias("_lower"),
        value_at(F.ceil("_position")).alias("_upper"),
        F.max(F.col("_position") - F.floor("_position")).alias("_part"),
    )
    return found.select(
        *(F.col("_group").getField(g).alias(g) for g in groups),
        (F.col("_lower") + (F.col("_upper") - F.col("_lower")) * F.col("_part")).alias("quantile"),
    )
