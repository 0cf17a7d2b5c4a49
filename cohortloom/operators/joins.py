"""Joins that attach measurements and point records to the stays around them.

Dimension sides carry no broadcast hint: Catalyst broadcasts them while their
size is under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a
shuffled join beyond it. The only hinted side is a list of hot keys, whose
length is bounded by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import elapsed_hours, epoch_seconds, time_slice
from cohortloom.operators.asof import neighbours
from cohortloom.operators.heavy import heavy_keys
from cohortloom.operators.ranking import keep_first

DAY = 86_400
#: Rows of one key that a single task is allowed to hold.
HOT_KEY_ROWS = 5_000_000


def dictionary_join(events: DataFrame, items: DataFrame, key: str = "itemid") -> DataFrame:
    """Events of the listed items, with the items' attributes."""
    return events.join(items, key)


def stay_join(
    events: DataFrame,
    stays: DataFrame,
    key: str,
    spread_by: Sequence[str],
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Inner join of events to one-row-per-key stays, with hot keys cut in parts.

    An event's part comes from the hash of its ``spread_by`` columns, so equal
    events share a part; a stay is copied once per part of its key. The result
    carries ``_part`` and is partitioned by (key, _part): a later step keyed on
    (key, spread_by) runs without another shuffle. The hot keys are found by a
    job over the key column; the join itself reads the events once.
    """
    hot = F.broadcast(heavy_keys(events, key, hot_rows))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    cut = (
        events.join(hot, key, "left")
        .withColumn("_part", F.pmod(F.xxhash64(*spread_by), parts))
        .drop("_parts")
    )
    copied = (
        stays.join(hot, key, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .drop("_parts")
    )
    return cut.join(copied, [key, "_part"])


def inside(at: Column | str, start: Column | str, end: Column | str) -> Column:
    """``start <= at <= end``, an open end admitting every later moment."""
    at, start, end = (F.col(c) if isinstance(c, str) else c for c in (at, start, end))
    return (at >= start) & (end.isNull() | (at <= end))


def within_window(
    events: DataFrame,
    stays: DataFrame,
    *,
    key: str = "hadm_id",
    at: str = "charttime",
    start: str = "admittime",
    end: str = "dischtime",
    spread_by: Sequence[str] | None = None,
    inside_only: bool = True,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Events joined to their own stay, kept when they happened during it."""
    joined = stay_join(events, stays, key, spread_by or [at], hot_rows)
    return joined.where(inside(at, start, end)) if inside_only else joined


def sliced_join(
    points: DataFrame,
    spans: DataFrame,
    by: str,
    at: str,
    first_slice: Column,
    last_slice: Column,
    seconds: int = DAY,
) -> DataFrame:
    """Candidate (point, span) pairs that share ``by`` and a slice of time.

    A point has one slice, a span is copied to every slice it touches. The join
    key (by, slice) spreads a busy subject over its timeline, and pairs that
    are far apart in time are never formed.
    """
    placed = points.withColumn("_slice", time_slice(at, seconds))
    copies = spans.withColumn("_slice", F.explode(F.sequence(first_slice, last_slice)))
    return placed.join(copies, [by, "_slice"]).drop("_slice")


def within_reach(
    points: DataFrame, spans: DataFrame, by: str, at: str, start: str, end: str, seconds: int
) -> DataFrame:
    """Spans with the slices they touch, clipped to where their subject has points.

    Clipping bounds the copies of open or absurdly long spans by the subject's
    own timeline and drops spans of subjects without points. The bounds are one
    row per subject, combined on the map side.
    """
    moment = time_slice(at, seconds)
    reach = points.groupBy(by).agg(F.min(moment).alias("_low"), F.max(moment).alias("_high"))
    return (
        spans.join(reach, by)
        .withColumn("_low", F.greatest("_low", time_slice(start, seconds)))
        .withColumn("_high", F.least("_high", time_slice(end, seconds)))
        .where(F.col(start).isNotNull() & (F.col("_low") <= F.col("_high")))
    )


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    *,
    by: str,
    at: str,
    start: str,
    end: str,
    seconds: int = DAY,
) -> DataFrame:
    """Every (point, span) pair of a subject with ``start <= at <= end``; a span
    without an end is open."""
    reached = within_reach(points, spans, by, at, start, end, seconds)
    pairs = sliced_join(points, reached, by, at, F.col("_low"), F.col("_high"), seconds)
    return pairs.where(inside(at, start, end)).drop("_low", "_high")


def match_to_interval(
    points: DataFrame,
    stays: DataFrame,
    *,
    key: str = "subject_id",
    point_id: str = "study_id",
    at: str = "ecg_time",
    stay_id: str = "hadm_id",
    start: str = "admittime",
    end: str = "dischtime",
    grace_hours: int = 12,
    reach_hours: int = 72,
    hours: str = "hours_from_admit",
) -> DataFrame:
    """The point nearest to each stay's start, from ``grace_hours`` before it to
    ``reach_hours`` after it and never past its end. Ties go to the lower id.

    The last point before and the first after a start are carried to it, which settles
    how near the nearest is. Distances are rounded hours, so several moments may be as
    near: they are whole seconds known by then, and are looked up by their second.
    """
    # Of several points at the same moment only the lowest id can win.
    distinct = keep_first(
        points.where(F.col(key).isNotNull() & F.col(at).isNotNull()), [key, at], [F.col(point_id)]
    )
    marks = stays.where(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        key, stay_id, start, end, F.least(start, F.coalesce(end, start)).alias("_anchor"))
    near = neighbours(marks, points.select(key, at), by=key, at="_anchor", point_at=at)

    def allowed(moment: Column) -> Column:
        return (moment >= F.col(start) - F.make_dt_interval(hours=F.lit(grace_hours))) & (
            F.col(end).isNull() | (moment <= F.col(end))) & (
            elapsed_hours(F.col(start), moment, 3) <= reach_hours)

    def distance(side: str) -> Column:
        moment = F.col(f"{side}.{at}")
        return F.when(allowed(moment), F.abs(elapsed_hours(F.col(start), moment, 3)))

    least = near.select(key, stay_id, start, end, F.least(
        distance("before"), distance("after")).alias("_least")).where(F.col("_least").isNotNull())
    about = F.floor(F.col("_least") * 3600).cast("long")
    whole = F.filter(F.sequence(about - 3, about + 3), lambda s: (s >= 0) & (
        F.round(s / F.lit(3600.0), 3) == F.col("_least")))
    apart = F.array_distinct(F.concat(whole, F.transform(whole, lambda s: -s)))
    wanted = least.withColumn("_second", F.explode(F.transform(
        apart, lambda s: epoch_seconds(start) + s)))
    pairs = distinct.withColumn("_second", epoch_seconds(at)).join(wanted, [key, "_second"])
    near = pairs.where(allowed(F.col(at))).withColumn(hours, elapsed_hours(start, at, 3))
    best = keep_first(near.drop("_second", "_least"), [stay_id],
                      [F.abs(hours).asc(), F.col(point_id).asc()])
    return best.drop(start, end)


def match_first_strict(
    cohort: DataFrame,
    records: DataFrame,
    stays: DataFrame | None = None,
    *,
    key: str = "subject_id",
    stay_id: str = "hadm_id",
    at: str = "ecg_time",
    start: str = "admittime",
    end: str = "dischtime",
) -> DataFrame:
    """First record of each cohort stay taken between its start and its end.

    A stay without an end never matches. Stay times missing from the cohort are
    looked up in ``stays``; records without a time column match on the subject
    alone and are all kept. The first record from the start on is carried back to
    the stay; no pairs are formed.
    """
    if not {start, end} <= set(cohort.columns):
        times = stays.select(key, stay_id, start, end)
        cohort = cohort.drop(start, end).join(times, [key, stay_id], "left")
    if at not in records.columns:
        return cohort.join(records, key)
    closed = cohort.where(F.col(end) >= F.col(start))
    next_record = F.col("_after")
    during = neighbours(closed, records, by=key, at=start, point_at=at, before="_before",
                        after="_after").where(next_record[at] <= F.col(end))
    matched = during.select(
        key, *(next_record[c].alias(c) for c in records.columns if c != key),
        *(c for c in closed.columns if c != key))
    return keep_first(matched, [stay_id], [F.col(at).asc()])


def match_coverage(cohort: DataFrame, matched: DataFrame, stay_id: str = "hadm_id",
                   label: str = "label") -> DataFrame:
    """Per label and overall: stays, stays with a match, and their share."""
    hits = matched.select(stay_id).distinct().withColumn("_hit", F.lit(1))
    per_label = (
        cohort.select(stay_id, label).distinct().join(hits, stay_id, "left")
        .groupBy(F.col(label).cast("string").alias("cohort_label"))
        .agg(F.count(F.lit(1)).alias("stays"), F.count("_hit").alias("matched_stays"))
    )
    total = per_label.agg(
        F.lit("all").alias("cohort_label"),
        F.coalesce(F.sum("stays"), F.lit(0)).alias("stays"),
        F.coalesce(F.sum("matched_stays"), F.lit(0)).alias("matched_stays"),
    )
    return per_label.unionByName(total).withColumn(
        "coverage", F.round(F.try_divide("matched_stays", "stays"), 6)
    )
