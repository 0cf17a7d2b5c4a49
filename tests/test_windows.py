from __future__ import annotations

import json
import random
from collections import Counter
from datetime import timedelta

import pytest
from conftest import moment
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.streaming.windows import Windows, WindowStore, count_windows

START = moment("2024-01-01 00:00:00")
SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("key", T.IntegerType()),
    T.StructField("at", T.TimestampType()), T.StructField("note", T.StringType())])


@pytest.fixture(scope="module")
def rows():
    """A third of the rows has one key; moments run over ten hours."""
    rng = random.Random(4)
    return [(i, 1 if rng.random() < 0.33 else rng.randint(2, 9), START + timedelta(
        seconds=rng.randint(0, 36_000)), rng.choice(["a", None, 'q"']))
        for i in range(400)]


def hours(rows):
    return Counter((str(k), at.replace(minute=0, second=0)) for _, k, at, _ in rows)


def feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, store, rules):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    count_windows(stream, store, rules, key="key", at="at", row_id="id",
                  checkpoint=str(tmp_path / "check")).awaitTermination()


@pytest.mark.parametrize("delay,parts", [(40_000, 1), (40_000, 4), (600, 2)])
def test_shuffled_batches_and_a_restart_equal_the_batch(spark, tmp_path, rows, delay, parts):
    mixed = rows[:]
    random.Random(delay).shuffle(mixed)
    rules = Windows(3600, delay, parts)
    store = WindowStore.create(spark, str(tmp_path / "store"), buckets=2)
    feed(spark, str(tmp_path / "in"), mixed[:200])
    run(spark, tmp_path, store, rules)
    for k in (200, 300):  # A new query goes on from the checkpoint.
        feed(spark, str(tmp_path / "in"), mixed[k:k + 100])
    run(spark, tmp_path, store, rules)
    totals = store.totals().collect()
    assert {(r.key, r.window): r.n + r.n_late for r in totals} == hours(rows)
    first = {}
    for i, k, at, _ in rows:
        slot = (str(k), at.replace(minute=0, second=0))
        first[slot] = min(first.get(slot, (at, str(i))), (at, str(i)))
    assert {(r.key, r.window): (r.first_at, r.first_id) for r in totals} == first
    late = store.late_rows(SCHEMA).collect()
    assert (len(late) > 50) == (delay == 600) and sum(r.n_late for r in totals) == len(late)
    known = {r[0]: r for r in rows}
    assert all(tuple(r) == known[r.id] for r in late)


def test_closed_windows_leave_the_state(spark, tmp_path, rows):
    """Rows in order: only late rows' windows are closed, and the state stays small."""
    store = WindowStore.create(spark, str(tmp_path / "store"), buckets=2)
    ordered = sorted(rows, key=lambda r: r[2])
    for k in range(0, 400, 134):
        feed(spark, str(tmp_path / "in"), ordered[k:k + 134])
    run(spark, tmp_path, store, Windows(3600, 600))
    assert store.late.read().count() == 0
    assert {(r.key, r.window): r.n for r in store.totals().collect()} == hours(rows)


def test_update_keeps_only_open_windows():
    import pandas as pd

    from cohortloom.streaming.windows import MICRO, counter

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    state, update = State(), counter(Windows(10, 5))

    def send(*moments):
        frame = pd.DataFrame([(m * MICRO, f"i{m}", "{}") for m in moments], columns=["at", "id", "row"])
        out = pd.concat(update(("k", 0), iter([frame]), state))
        return [(r.kind, r.window // MICRO, r.n) for r in out.itertuples()]

    assert send(1, 12, 2) == [("window", 0, 2), ("window", 10, 1)]
    assert send(3, 26) == [("window", 0, 3), ("window", 20, 1)]
    assert send(4, 27) == [("window", 20, 2), ("late", 0, 1)]
    assert set(json.loads(state.get[1])) == {str(20 * MICRO)}


def test_rows_that_cannot_be_placed_are_told_apart(spark):
    from cohortloom.streaming.windows import unplaceable

    df = spark.createDataFrame([(1, None, START, "a"), (None, 1, START, "b"), (2, 1, None, "c"),
                                (3, 1, START, "d")], SCHEMA)
    assert [r.note for r in df.where(~unplaceable("key", "at", "id")).collect()] == ["d"]
    assert df.where(unplaceable("key", "at", "id")).agg(F.count("note")).first()[0] == 3
