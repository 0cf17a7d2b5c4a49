from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

HERE = os.path.dirname(os.path.abspath(__file__))
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
#: Names that operators use themselves, as extra columns.
CLASHING = ("n_words", "size", "shard", "slot", "kept", "copies", "target", "component_id",
            "digest", "keys", "row", "ident", "text_hash", "n_tokens", "spans", "items", "labels",
            "_text", "_row", "_host", "host", "_source", "_bin", "_words", "_tie", "_size", "_old")


def frame(spark, rows, clashing=False):
    """Documents from (doc_id, text, source), with columns of clashing names if asked."""
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if clashing else df


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(HERE))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, blank texts, a long text, ties, repeated rows and ids."""
    long = prose(1, 20_000)
    same = prose(2, 60)
    return [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (None, prose(3, 40), "b"),
        (None, None, None), (4, long, "a"), (5, long + " tail", "b"), (6, same, "a"), (6, same, "a"),
        (7, same, None), (8, "One.", "c"), (8, prose(4, 30), "c"), (9, "ÄÖ über 中文 \U0001f600 x", "c"),
        (10, same + " more", "a"),
    ]
