"""As-of matching: for each row the last and the next point in time, without pairs.

Rows and points stand in one order. Inside a bin of time the last point seen is carried
on; across bins the ends of the bins are carried. Bins are cut by a sketch of the
moments, so a subject whose rows crowd into a day, or a minute, is as many tasks as
its share of the rows asks for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.bounds import RANGE_BINS, value_bounds, with_bin_by_steps
from cohortloom.operators.ranking import keep_first

FIRST, LAST = Window.unboundedPreceding, Window.unboundedFollowing


def micros(moment: str) -> Column:
    return F.unix_micros(F.col(moment).cast("timestamp"))


def neighbours(marks: DataFrame, points: DataFrame, *, by: str, at: str, point_at: str | None = None,
               ties: Sequence[Column] = (), before: str = "before", after: str = "after",
               bins: int = RANGE_BINS) -> DataFrame:
    """Every row of ``marks`` with the nearest points of its ``by`` on both sides.

    ``before`` is the last point at or before ``at``, ``after`` the first at or after it:
    structs of the points' columns, null where there is none. Of points at one moment
    the first by ``ties``, then by their other columns, counts. Rows and points with a
    null ``by`` or moment match nothing; such rows are kept. Bounds are taken by a job
    over the moments. A side that is not used later is not computed.
    """
    point_at = point_at or at
    single = keep_first(
        points.where(F.col(by).isNotNull() & F.col(point_at).isNotNull()), [by, point_at], ties)
    left = marks.select(F.col(by).alias("_by"), micros(at).alias("_at"),
                        F.struct(*marks.columns).alias("_mark"))
    right = single.select(F.col(by).alias("_by"), micros(point_at).alias("_at"),
                          F.struct(*points.columns).alias("_point"))
    placeable = F.col("_by").isNotNull() & F.col("_at").isNotNull()
    united = left.where(placeable).unionByName(right, allowMissingColumns=True)
    moments = marks.select(micros(at).alias("_at")).unionByName(
        points.select(micros(point_at).alias("_at")))
    binned = with_bin_by_steps(united, "_at", value_bounds(moments, "_at", bins))

    cell = Window.partitionBy("_by", "_bin")
    points_first = F.col("_mark").isNotNull()
    so_far = {
        before: cell.orderBy(F.col("_at").asc(), points_first),
        after: cell.orderBy(F.col("_at").desc(), points_first)}
    inside = binned.withColumns({
        f"_{name}": F.last("_point", ignorenulls=True).over(order.rowsBetween(FIRST, 0))
        for name, order in so_far.items()}).where(F.col("_mark").isNotNull())

    # One row per subject and bin: its last and first point, if it has any.
    moment = F.when(F.col("_point").isNotNull(), F.col("_at"))
    ends = binned.groupBy("_by", "_bin").agg(
        F.max_by("_point", moment).alias("_last"), F.min_by("_point", moment).alias("_first"))
    across = Window.partitionBy("_by").orderBy("_bin")
    ends = ends.select(
        "_by", "_bin",
        F.last("_last", ignorenulls=True).over(across.rowsBetween(FIRST, -1)).alias("_carried"),
        F.first("_first", ignorenulls=True).over(across.rowsBetween(1, LAST)).alias("_awaited"))
    found = inside.join(ends, ["_by", "_bin"]).select(
        "_mark", F.coalesce(f"_{before}", "_carried").alias(before),
        F.coalesce(f"_{after}", "_awaited").alias(after))
    rest = left.where(~placeable).select("_mark")
    return found.unionByName(rest, allowMissingColumns=True).select("_mark.*", before, after)


def asof_join(marks: DataFrame, points: DataFrame, *, by: str, at: str, point_at: str,
              ties: Sequence[Column] = (), direction: str = "backward", strict: bool = False,
              most_seconds: int | None = None, bins: int = RANGE_BINS) -> DataFrame:
    """``marks`` with the columns of their last point (``backward``) or next one (``forward``).

    Left join: rows without a point, or with one farther than ``most_seconds``, have
    nulls. ``strict`` leaves out points at the row's own moment. Columns of the points
    must not have names of ``marks``, but for ``by``.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be 'backward' or 'forward', not {direction!r}")
    rows = marks
    if strict:
        # Moments have whole microseconds, so one less is the moment before.
        step = F.make_dt_interval(secs=F.lit(0.000001).cast("decimal(18,6)"))
        rows = marks.withColumn("_anchor", F.col(at) - step if direction == "backward" else F.col(at) + step)
    near = neighbours(rows, points, by=by, at="_anchor" if strict else at, point_at=point_at,
                      ties=ties, before="_backward", after="_forward", bins=bins)
    point = f"_{direction}"
    if most_seconds is not None:
        reach = F.lit(most_seconds) * 1_000_000
        apart = F.abs(micros(at) - F.unix_micros(F.col(f"{point}.{point_at}").cast("timestamp")))
        near = near.withColumn(point, F.when(apart <= reach, F.col(point)))
    return near.select(*marks.columns, *(
        F.col(f"{point}.{c}").alias(c) for c in points.columns if c != by))
