from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pytest
from conftest import moment, plan_of
from pyspark.sql import functions as F

from cohortloom.functions.columns import hash_ordinal
from cohortloom.operators import joins, ranking
from cohortloom.operators.bounds import value_bounds, with_bin, with_bin_by_steps
from cohortloom.operators.heavy import heavy_keys
from cohortloom.operators.cohort import assign_split, stratified_split

START = moment("2024-01-01 00:00:00")


def hour(n):
    return START + timedelta(hours=n)


@pytest.fixture(scope="module")
def random_case():
    """A busy subject holds most points; spans overlap, touch and stay open."""
    rng = random.Random(3)
    points = [(1 if rng.random() < 0.6 else rng.randint(2, 6), i, hour(rng.randint(0, 900)))
              for i in range(300)]
    spans = [(rng.randint(1, 6), 1000 + i, hour(s := rng.randint(0, 800)),
              None if rng.random() < 0.2 else hour(s + rng.randint(0, 200))) for i in range(40)]
    return points, spans


def frames(spark, case):
    points, spans = case
    return (spark.createDataFrame(points, "subject_id int, study_id int, ecg_time timestamp"),
            spark.createDataFrame(spans, "subject_id int, hadm_id int, admittime timestamp, "
                                         "dischtime timestamp"))


def test_interval_join_equals_brute_force(spark, random_case):
    points, spans = frames(spark, random_case)
    found = joins.interval_join(points, spans, by="subject_id", at="ecg_time", start="admittime",
                                end="dischtime").select("study_id", "hadm_id").collect()
    wanted = [(i, h) for s, i, t in random_case[0] for s2, h, a, d in random_case[1]
              if s == s2 and a <= t and (d is None or t <= d)]
    assert sorted(map(tuple, found)) == sorted(wanted)


def test_nearest_point_equals_brute_force(spark, random_case):
    points, spans = frames(spark, random_case)
    found = {r.hadm_id: r.study_id for r in joins.match_to_interval(points, spans).collect()}
    wanted = {}
    for s, h, a, d in random_case[1]:
        near = [(abs(round((t - a).total_seconds() / 3600, 3)), i) for s2, i, t in random_case[0]
                if s == s2 and a - timedelta(hours=12) <= t and (d is None or t <= d)
                and (t - a) <= timedelta(hours=72)]
        if near:
            wanted[h] = min(near)[1]
    assert found == wanted


def test_first_strict_equals_brute_force(spark, random_case):
    points, spans = frames(spark, random_case)
    found = {r.hadm_id: r.study_id for r in joins.match_first_strict(spans, points).collect()}
    wanted = {}
    for s, h, a, d in random_case[1]:
        during = [(t, i) for s2, i, t in random_case[0] if s == s2 and d and a <= t <= d]
        if during:
            wanted[h] = min(during)[1]
    assert found == wanted


def test_hot_key_is_cut_and_nothing_is_lost(spark):
    events = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("k"), "id")
    stays = spark.range(45).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    cut = joins.stay_join(events, stays, "k", ["id"], hot_rows=100)
    assert cut.where("k = 7").select("_part").distinct().count() > 5
    assert sorted(cut.drop("_part").collect()) == sorted(events.join(stays, "k").collect())
    assert heavy_keys(events, "k", 100).count() == 1
    # The list is a constant: the plan reads the events once.
    assert plan_of(cut).count("Range (0, 3000") == 1


def test_heavy_keys_are_found_with_few_counters(spark):
    """Far more keys than counters; four keys hold a third of the rows."""
    rows = spark.range(60_000).select(F.when(F.col("id") % 12 < 4, F.col("id") % 12).otherwise(
        F.col("id") + 100).alias("k")).unionByName(spark.createDataFrame([(None,)] * 9000, "k long"))
    for shuffled in (rows.repartition(8), rows.repartitionByRange(8, "k")):
        found = {r.k: r["_parts"] for r in heavy_keys(shuffled, "k", 2000, counters=256).collect()}
        assert found == {k: 3 for k in range(4)}
    names = rows.where("k < 200").select(F.concat(F.lit("n"), "k").alias("a b"))
    assert heavy_keys(names, "a b", 4999).count() == 4
    assert heavy_keys(rows.limit(0), "k", 1).count() == 0


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile_equals_numpy(spark, share):
    rng = np.random.default_rng(5)
    groups = {
        "ties": [3.0] * 50 + [4.0] * 3, "one": [2.5], "mixed": list(rng.normal(0, 1e3, 301)),
        "tiny": list(rng.normal(0, 1e-9, 40)), "zero": [0.0, -0.0, 1.0, -1.0],
        "wide": list(10.0 ** rng.uniform(-8, 8, 120)), None: [1.0, 2.0],
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("ties", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    found = {r.g: r.quantile for r in ranking.exact_quantile(df, ["g"], "v", share).collect()}
    for g, values in groups.items():
        assert found[g] == pytest.approx(np.quantile(values, share), rel=1e-12, abs=1e-15)


def test_bins_follow_the_order_of_values(spark):
    values = sorted({*(2.0**k for k in range(-60, 60)), *(-(2.0**k) for k in range(-5, 5)),
                     *(np.nextafter(2.0**k, 0) for k in range(-60, 60)), 0.0, 1e308, -1e308,
                     float("inf"), float("-inf")})
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for bins in (1, 2, 7, 64, 1024):
        bounds = value_bounds(df, "v", bins)
        assert len(bounds) < bins
        got = [(r.v, r._bin) for r in with_bin(df, "v", bounds).orderBy("v").collect()]
        assert got == [(v, sum(b <= v for b in bounds)) for v in values]
    assert value_bounds(df.where("v is null"), "v") == []
    nulls = with_bin(spark.createDataFrame([(None,)], "v double"), "v", [1.0, 2.0])
    assert nulls.first()._bin == 0


@pytest.mark.parametrize("scale", ["one day of seconds", "one octave", "hot value"])
def test_no_bin_holds_more_than_a_small_share(spark, scale):
    """Values that lie close together, or of which a third are the same."""
    ids = spark.range(60_000).select(F.col("id"), F.xxhash64("id").alias("h"))
    day = 1_700_000_000 + F.pmod("h", F.lit(86_400))
    values = {"one day of seconds": day, "one octave": 1 + F.pmod("h", F.lit(10**9)) / 10**9,
              "hot value": F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod("h", F.lit(10**6)))}
    df = ids.select(values[scale].cast("double").alias("v")).repartition(8)
    bounds = value_bounds(df, "v", 256)
    sizes = with_bin(df.distinct() if scale == "hot value" else df, "v", bounds).groupBy("_bin").count()
    assert sizes.agg(F.max("count")).first()[0] < 60_000 * (1 / 256 + 0.004)
    assert sizes.count() > 150
    exact = ranking.exact_quantile(df.withColumn("g", F.lit(1)), ["g"], "v").first().quantile
    assert exact == float(np.median([r.v for r in df.collect()]))


def test_a_quantile_shuffles_only_the_wanted_bins(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").cast("double").alias("v"))
    plan = plan_of(ranking.exact_quantile(df, ["g"], "v"))
    values = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_value" in line]
    # The values are dealt once, behind the join with the wanted bins, and counted before.
    assert len(values) == 1


def test_binned_rank_is_a_row_number(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("s"))
    ranked = ranking.binned_rank(df, ["s"], hash_ordinal("id", "x", "md5"), ["id"], bins=64)
    for rows in (ranked.where(f"s = {s}").select("rank").collect() for s in range(3)):
        assert sorted(r.rank for r in rows) == list(range(1, len(rows) + 1))


def test_sample_is_exact_stable_and_never_one_task(spark):
    df = spark.range(4000).withColumn("pad", F.lit("x"))
    keep = F.lit(37)
    once = ranking.hash_sample(df, keep, "id", "ctl")
    assert once.count() == 37
    again = ranking.hash_sample(df.repartition(7), keep, "id", "ctl")
    assert sorted(once.collect()) == sorted(again.collect())
    assert ranking.hash_sample(df, F.lit(10_000), "id", "ctl").count() == 4000
    # Only the per-bin totals (at most one row per bin) meet in one task.
    lines = plan_of(once).splitlines()
    alone = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert alone and all("HashAggregate" in lines[i + 1] and "_bin" in lines[i + 1] for i in alone)
    lowest = df.orderBy(F.hash(F.concat_ws("::", F.lit("ctl"), "id")), "id").limit(37)
    assert sorted(once.collect()) == sorted(lowest.collect())


def test_split_follows_the_subject(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 13)], "subject_id int, hadm_id int")
    rows = assign_split(df).collect()
    assert len({r.split for r in rows if r.subject_id == 1}) == 1
    spread = assign_split(spark.range(20000), "id").groupBy("split").count().collect()
    shares = {r.split: r["count"] / 20000 for r in spread}
    assert shares["train"] == pytest.approx(0.70, abs=0.02)
    assert shares["validation"] == pytest.approx(0.15, abs=0.02)
    same = assign_split(spark.range(100), "id").withColumn(
        "want", F.pmod(F.hash(F.concat_ws("::", F.lit("angina-v1"), F.col("id").cast("string"))),
                       F.lit(100)))
    assert same.where("split_bucket <> want").count() == 0


def test_stratified_split_keeps_the_label_mix(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    counts = {(r.label, r.split): r["count"]
              for r in stratified_split(df, "label", "id").groupBy("label", "split").count()
              .collect()}
    assert counts == {(0, "test"): 180, (0, "validation"): 72, (0, "train"): 648,
                      (1, "test"): 20, (1, "validation"): 8, (1, "train"): 72}


def test_bins_by_steps_are_those_of_one_expression_and_steps_name_the_last_twice(spark):
    bounds = [-1.0, 0.0, 0.5, 2.0, 3.0, 7.0, 7.5]
    df = spark.createDataFrame(
        [(v,) for v in (None, -5.0, -1.0, 0.25, 0.5, 2.5, 7.0, 7.5, float("inf"), float("nan"))], "v double")
    for some in ([], bounds[:1], bounds[:4], bounds):
        both = with_bin_by_steps(with_bin(df, "v", some), "v", some, "_steps")
        assert both.where("_bin <> _steps or _steps is null").count() == 0
    plan = with_bin_by_steps(df, "v", bounds)._jdf.queryExecution().analyzed().toString()
    steps = [line for line in plan.splitlines() if " AS _bin#" in line and "get(" in line]
    # Written out as one expression, three mentions in each of ten steps are 59,049.
    assert len(steps) == 3 and all(line.count("_bin#") <= 3 for line in steps)
