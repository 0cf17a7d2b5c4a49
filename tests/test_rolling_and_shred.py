from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pytest
from conftest import moment, plan_of
from pyspark.sql import functions as F

from cohortloom.operators.rolling import rolling, trend
from cohortloom.operators.shred import Property, discover, shred

START = moment("2024-01-01 00:00:00")


@pytest.fixture(scope="module")
def stays():
    """One stay holds most rows, some at the same moment; nulls in every column."""
    rng = random.Random(6)
    rows = []
    for i in range(400):
        hours = rng.choice([rng.randint(0, 5), rng.randint(0, 400)])
        rows.append((i, 1 if rng.random() < 0.7 else rng.choice([2, 3, None]),
                     None if i % 60 == 5 else START + timedelta(hours=hours), float(hours),
                     None if i % 30 == 2 else float(rng.randint(0, 50))))
    return rows


@pytest.mark.parametrize("bins", [1, 5, 300])
def test_rolling_equals_brute_force(spark, stays, bins):
    df = spark.createDataFrame(stays, "id int, stay int, at timestamp, hours double, value double").repartition(4)
    got = rolling(df, trend("value", "hours"), by="stay", at="at", seconds=10 * 3600, bins=bins)
    assert got.columns == [*df.columns, "n_in_span", "mean_in_span", "slope_in_span"]
    found = {r.id: r for r in got.collect()}
    assert len(found) == len(stays) == got.count()
    for i, stay, at, hours, _ in stays:
        r = found[i]
        if stay is None or at is None:
            assert r.n_in_span is None and r.mean_in_span is None
            continue
        near = [(h, v) for _, s, t, h, v in stays if s == stay and t and v is not None
                and at - timedelta(hours=10) <= t <= at]
        assert r.n_in_span == len(near)
        if not near:
            assert r.mean_in_span is None
            continue
        x, y = map(np.array, zip(*near, strict=True))
        assert r.mean_in_span == pytest.approx(y.mean())
        if x.std() == 0:
            assert r.slope_in_span is None
        else:
            assert r.slope_in_span == pytest.approx(np.polyfit(x, y, 1)[0], abs=1e-9)


def test_a_long_stay_is_many_windows(spark):
    df = spark.range(20_000).select(F.floor(F.col("id") / 10**6).alias("stay"), F.timestamp_seconds(F.col("id") * 60).alias("at"),
                                    F.col("id").cast("double").alias("value"))
    got = rolling(df, {"n": F.count("value")}, by="stay", at="at", seconds=600, bins=64)
    assert got.where("n = 11").count() == 20_000 - 10 and got.count() == 20_000
    window = next(line for line in plan_of(got).splitlines() if " Window [" in line)
    assert "windowspecdefinition(stay" in window and "_bin" in window


JSON = [
    (1, '{"n": 1, "s": "x", "f": 1.5, "b": true, "mixed": 1, "o": {"a": [1, 2]}}'),
    (2, '{"n": 2, "s": "q\\"uote ü", "f": 2, "b": false, "mixed": "two"}'),
    (3, '{"n": null, "s": null, "rare": 5}'), (4, "{}"), (5, None), (6, "{cut"), (7, "[1, 2]"), (8, '"text"'),
    (9, '{"n": 12345678901234567890, "f": 0.25, "s": ""}'), (1, '{"n": 1, "n ": 2, "a.b": 3}'),
]


def test_discovery_and_shredding_lose_nothing(spark):
    df = spark.createDataFrame(JSON, "id int, p string")
    found = {p.name: p.kind for p in discover(df, "p", min_share=0.3)}
    assert found == {"n": "bigint", "f": "double", "s": "string", "b": "boolean"}
    assert "rare" in {p.name for p in discover(df, "p", min_share=0.1)}
    kinds = [Property("n", "bigint"), Property("s", "string"), Property("f", "double"), Property("b", "boolean")]
    rows = shred(df, "p", kinds).collect()
    got = [(r.id, r.n, r.s, r.f, r.b, r.rest, r.malformed) for r in rows]
    assert got == [
        (1, 1, "x", 1.5, True, '{"mixed":1,"o":{"a":[1,2]}}', None),
        (2, 2, 'q"uote ü', 2.0, False, '{"mixed":"two"}', None),
        (3, None, None, None, None, '{"n":null,"s":null,"rare":5}', None),
        (4, None, None, None, None, None, None), (5, None, None, None, None, None, None),
        (6, None, None, None, None, None, "{cut"), (7, None, None, None, None, None, "[1, 2]"),
        (8, None, None, None, None, None, '"text"'),
        (9, None, "", 0.25, None, '{"n":12345678901234567890}', None),
        (1, 1, None, None, None, '{"n ":2,"a.b":3}', None)]


def test_empty_and_without_objects(spark):
    df = spark.createDataFrame([(1, None)], "id int, p string")
    assert discover(df, "p") == [] and discover(df.limit(0), "p") == []
    assert shred(df, "p", []).first().asDict() == {"id": 1, "rest": None, "malformed": None}
