"""All registered queries against their SQL, on whole tables of the smallest scale.

They share one set of derived layers, which are built once per session.
"""

from __future__ import annotations

import importlib.util

import pytest
from conftest import ROOT
from oracle import connect, difference

from cohortloom.catalog import BUILDERS, ORACLES, QUERIES
from cohortloom.catalog.base import plain_times
from cohortloom.catalog.tables import Tables

WITHOUT_SQL = {"a8_assign_split_murmur3", "p4_train_classifiers", "p7_resample_signal"}


@pytest.fixture(scope="module")
def tables(spark, small):
    return Tables(spark, small)


@pytest.fixture(scope="module")
def database(small):
    return connect(small)


def test_every_query_but_three_has_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(tables, database, name):
    assert difference(plain_times(BUILDERS[name](tables)), database, ORACLES[name]) is None


def test_entry_runs(spark):
    spec = importlib.util.spec_from_file_location("entry", f"{ROOT}/__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() > 0
    assert set(module.oracle_sql()) <= set(module.queries())
