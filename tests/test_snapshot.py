from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.sources.snapshot import CommitConflict, SnapshotTable

SCHEMA = T.StructType([
    T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
    T.StructField("at", T.IntegerType()), T.StructField("value", T.DoubleType())])


def frame(spark, rows):
    return spark.createDataFrame([(*r, False) if len(r) == 4 else r for r in rows],
                                 T.StructType([*SCHEMA, T.StructField("gone", T.BooleanType())]))


def table(spark, tmp_path, buckets=8):
    return SnapshotTable.create(spark, str(tmp_path / "t"), SCHEMA, ["a", "b"], ["at"], buckets)


def files(tmp_path, manifest):
    return {b: sorted(os.listdir(tmp_path / "t" / f)) for b, f in manifest.folders.items()}


def test_deliveries_in_any_order_give_the_newest_record(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randrange(40), rng.choice("xyz"), rng.randrange(100), float(i)) for i in range(400)]
    rows = list({(r[0], r[1], r[2]): r for r in rows}.values())
    want = {}
    for r in sorted(rows, key=lambda r: r[2]):
        want[r[:2]] = r
    t = table(spark, tmp_path)
    rng.shuffle(rows)
    for k in range(0, len(rows), 60):
        t.upsert(frame(spark, rows[k:k + 60]), deleted="gone")
    t.upsert(frame(spark, rows[:60]), deleted="gone")  # once more: nothing changes
    assert sorted(map(tuple, t.read().collect())) == sorted(want.values())


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = table(spark, tmp_path)
    first = t.upsert(frame(spark, [(i, "x", 1, 1.0) for i in range(200)]))
    before = files(tmp_path, first)
    second = t.upsert(frame(spark, [(3, "x", 2, 9.0), (3, "x", 0, 7.0)]))
    changed = [b for b in first.folders if first.folders[b] != second.folders[b]]
    assert len(changed) == 1
    after = files(tmp_path, second)
    assert all(after[b] == before[b] for b in before if b not in changed)
    found = t.lookup(spark.createDataFrame([(3, "x"), (500, "x")], "a long, b string")).collect()
    assert [tuple(r) for r in found] == [(3, "x", 2, 9.0)]


def test_readers_keep_their_version_and_old_ones_expire(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [(i, "x", 1, 1.0) for i in range(50)]))
    reader = t.read()
    t.upsert(frame(spark, [(i, "x", 2, 2.0) for i in range(50)]))
    assert reader.agg(F.sum("value")).first()[0] == 50.0
    assert t.read(1).agg(F.sum("value")).first()[0] == 50.0
    assert t.read().agg(F.sum("value")).first()[0] == 100.0
    t.upsert(frame(spark, [(i, "x", 3, 3.0) for i in range(50)]))
    assert t.expire(keep=2) and t.versions() == [2, 3]
    assert t.read(2).agg(F.sum("value")).first()[0] == 100.0
    assert t.read().agg(F.sum("value")).first()[0] == 150.0


def test_deletes_empty_changes_and_null_keys(spark, tmp_path):
    t = table(spark, tmp_path, buckets=2)
    assert t.read().count() == 0
    t.upsert(frame(spark, []))
    t.upsert(frame(spark, [(1, "x", 1, 1.0), (2, "x", 1, 1.0)]), deleted="gone")
    t.upsert(frame(spark, [(1, "x", 0, 1.0, True), (2, "x", 2, 1.0, True)]), deleted="gone")
    assert [r.a for r in t.read().collect()] == [1]
    with pytest.raises(ValueError):
        t.upsert(frame(spark, [(None, "x", 1, 1.0)]))


def test_a_second_writer_is_told(spark, tmp_path):
    t = table(spark, tmp_path)
    stale = t.manifest()
    t.upsert(frame(spark, [(1, "x", 1, 1.0)]))
    t.manifest = lambda version=None: stale
    with pytest.raises(CommitConflict):
        t.upsert(frame(spark, [(2, "x", 1, 1.0)]))
    del t.manifest
    assert t.read().count() == 1 and not [n for n in t.files.names("manifests") if "draft" in n]


def test_one_key_with_most_records(spark, tmp_path):
    t = table(spark, tmp_path)
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"), F.lit("x").alias("b"),
        F.col("id").cast("int").alias("at"), F.col("id").cast("double").alias("value"))
    t.upsert(rows)
    assert t.read().where("a = 7").first().at == 19_998
    assert t.read().count() == rows.select("a").distinct().count()
