from __future__ import annotations

import random
from datetime import timedelta

import pytest
from conftest import moment, plan_of
from pyspark.sql import functions as F

from cohortloom.operators import joins
from cohortloom.operators.asof import asof_join, neighbours
from cohortloom.operators.bounds import value_bounds, with_bin

START = moment("2024-01-01 00:00:00")


def second(n):
    return START + timedelta(seconds=n)


@pytest.fixture(scope="module")
def crowded():
    """Most rows are one subject's within one minute; moments and ids repeat."""
    rng = random.Random(12)
    marks = [(1 if rng.random() < 0.7 else rng.choice([2, 3, None]), i,
              None if i % 50 == 7 else second(rng.choice([rng.randint(0, 60), rng.randint(0, 10**6)])))
             for i in range(500)]
    points = [(1 if rng.random() < 0.7 else rng.choice([2, 4, None]), rng.randint(0, 200),
               None if i % 40 == 3 else second(rng.choice([rng.randint(0, 60), rng.randint(0, 10**6)])))
              for i in range(400)]
    return marks, points


def frames(spark, crowded):
    marks, points = crowded
    return (spark.createDataFrame(marks, "subject int, mark int, at timestamp").repartition(5),
            spark.createDataFrame(points, "subject int, point int, seen timestamp").repartition(3))


def by_hand(crowded, direction, strict, most=None):
    for subject, mark, at in crowded[0]:
        near = []
        for other, point, seen in crowded[1]:
            if at is None or subject is None or other != subject or seen is None:
                continue
            gap = (at - seen).total_seconds() * (1 if direction == "backward" else -1)
            if gap >= (1e-6 if strict else 0) and (most is None or gap <= most):
                near.append((gap, point))
        yield mark, min(near)[1] if near else None


@pytest.mark.parametrize("bins", [1, 37])
@pytest.mark.parametrize("options", [
    {}, {"direction": "forward"}, {"strict": True}, {"direction": "forward", "strict": True},
    {"most_seconds": 30}])
def test_equals_brute_force(spark, crowded, bins, options):
    marks, points = frames(spark, crowded)
    got = asof_join(marks, points, by="subject", at="at", point_at="seen", bins=bins, **options)
    want = by_hand(crowded, options.get("direction", "backward"), options.get("strict", False),
                   options.get("most_seconds"))
    assert sorted((r.mark, r.point) for r in got.collect()) == sorted(want)
    assert got.columns == ["subject", "mark", "at", "point", "seen"]


def test_both_sides_and_empty_tables(spark, crowded):
    marks, points = frames(spark, crowded)
    both = neighbours(marks, points, by="subject", at="at", point_at="seen")
    assert both.count() == marks.count()
    assert both.where("before.seen > at or after.seen < at").count() == 0
    alone = neighbours(marks, points.limit(0), by="subject", at="at", point_at="seen")
    assert alone.where("before is not null or after is not null").count() == 0
    assert alone.count() == marks.count()
    assert neighbours(marks.limit(0), points, by="subject", at="at", point_at="seen").count() == 0
    with pytest.raises(ValueError):
        asof_join(marks, points, by="subject", at="at", point_at="seen", direction="sideways")


def test_a_crowded_day_is_many_bins_and_no_pairs(spark):
    """One subject-day holds nine tenths of all rows."""
    ids = spark.range(40_000)
    at = F.when(F.col("id") % 10 == 0, F.col("id") * 500).otherwise(F.pmod(F.xxhash64("id"), F.lit(86_400)))
    rows = ids.select(F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(F.lit(99)).alias("subject_id"),
                      F.col("id").alias("study_id"), F.timestamp_seconds(at).alias("ecg_time"))
    micros = F.unix_micros("ecg_time").alias("m")
    sizes = with_bin(rows.select("subject_id", micros), "m", value_bounds(rows.select(micros), "m")
                     ).groupBy("subject_id", "_bin").count()
    assert sizes.agg(F.max("count")).first()[0] < 40_000 / 200
    stays = rows.where("study_id % 40 = 1").select(
        "subject_id", F.col("study_id").alias("hadm_id"), F.col("ecg_time").alias("admittime"),
        (F.col("ecg_time") + F.expr("interval 1 hour")).alias("dischtime"))
    found = joins.match_first_strict(stays, rows)
    plan = plan_of(found)
    assert "_slice" not in plan and "SortMergeJoin [subject_id" not in plan
    assert found.count() == stays.count() == found.where("ecg_time = admittime").count()


def test_nearest_looks_up_moments_that_round_alike(spark):
    """3.6 seconds are one thousandth of an hour: the lower id of such moments wins."""
    points = spark.createDataFrame(
        [(1, 9, second(1000)), (1, 5, second(1001)), (1, 3, second(999)), (1, 1, second(1009)),
         (2, 8, second(996)), (2, 2, second(1020))], "subject_id int, study_id int, ecg_time timestamp")
    stays = spark.createDataFrame(
        [(1, 10, second(1000), None), (1, 11, second(1000), second(1000)), (1, 12, second(1000), second(999)),
         (2, 13, second(1000), second(1100)), (3, 14, second(0), None), (None, 15, second(0), None),
         (1, 16, None, None)], "subject_id int, hadm_id int, admittime timestamp, dischtime timestamp")
    got = {r.hadm_id: r.study_id for r in joins.match_to_interval(points, stays).collect()}
    assert got == {10: 3, 11: 3, 12: 3, 13: 8}
