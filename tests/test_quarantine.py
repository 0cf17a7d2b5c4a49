from __future__ import annotations

from conftest import plan_of

from cohortloom.sources.lake import read_csv
from cohortloom.sources.quarantine import WIDTH, read_checked, reason_counts, split_checked
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
    T.StructField("at", T.TimestampType()), T.StructField("value", T.DoubleType())])
LINES = '''id,name,at,value
1,plain,2024-01-01 10:00:00,1.5
2,"quoted, ""twice""",2024-01-01 11:00:00,-2e3
3,,,
4,no number,2024-01-01 12:00:00,abc
x5,two bad cells,2024-13-01 12:00:00,1
6,too few
7,too many,2024-01-01 12:00:00,1,extra,cells
1.5,fraction,2024-01-01 12:00:00,NaN
99999999999,too large,2024-01-01 12:00:00,1
 8 ,spaces,2024-01-01 12:00:00, 7.25
'''


def test_reasons_name_the_cells_and_no_row_is_lost(spark, tmp_path):
    (tmp_path / "a.csv").write_text(LINES)
    checked = read_checked(spark, str(tmp_path / "a.csv"), SCHEMA)
    good, bad = split_checked(checked, "checked")
    assert [r.id for r in good.orderBy("id").collect()] == [1, 2, 3, 8]
    assert good.schema == SCHEMA
    found = {r.name: {(x.column, x.kind, x.cell) for x in r["_reasons"]} for r in bad.collect()}
    assert found == {
        "no number": {("value", "double", "abc")},
        "two bad cells": {("id", "int", "x5"), ("at", "timestamp", "2024-13-01 12:00:00")},
        "too few": {(WIDTH, "line", "6,too few")},
        "too many": {(WIDTH, "line", "7,too many,2024-01-01 12:00:00,1,extra,cells")},
        "fraction": {("id", "int", "1.5")}, "too large": {("id", "int", "99999999999")}}
    counts = {(r.column, r.kind): r.cells for r in reason_counts(bad).collect()}
    assert counts[("id", "int")] == 3 and counts[(WIDTH, "line")] == 2
    plain = {r.id: r for r in read_csv(spark, str(tmp_path / "a.csv"), SCHEMA).collect()}
    for row in good.where("id <= 3").collect():
        assert plain[row.id] == row
    # One scan gives values and reasons.
    assert plan_of(checked).count("FileScan csv") == 1


def test_empty_file_and_clean_file(spark, tmp_path):
    (tmp_path / "none.csv").write_text("id,name,at,value\n")
    good, bad = split_checked(read_checked(spark, str(tmp_path / "none.csv"), SCHEMA), "checked")
    assert good.count() == bad.count() == 0
