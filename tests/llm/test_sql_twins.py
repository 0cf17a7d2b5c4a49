from __future__ import annotations

import pytest
from llm_helpers import package_on_workers  # noqa: F401
from oracle import connect, difference

from cohortloom.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def database(small):
    return connect(small)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, small, database, name):
    assert difference(QUERIES[name](spark, small), database, ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_other_queries_give_a_row_per_document(spark, small, name):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    got = QUERIES[name](spark, small)
    assert got.select("doc_id").exceptAll(documents.select("doc_id")).count() == 0
    assert got.count() == documents.count()
