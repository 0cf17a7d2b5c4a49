"""Raw files with malformed cells: what is wrong, cell by cell, and good rows apart.

The cells are read as text and parsed by the declared types in the same scan, so a cell
that does not parse is told from an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.session import fresh_path
from cohortloom.sources.lake import RAW_TIMESTAMP_FORMAT, RawFormat

REASONS, LINE = "_reasons", "_line"
#: The reason of a line with more or fewer cells than columns, which has no column.
WIDTH = "number of cells"


def parsed(cell: Column, kind: T.DataType, timestamps: str) -> Column:
    """The cell as its declared type, null if it is no such value."""
    if isinstance(kind, T.StringType):
        return cell
    if isinstance(kind, T.TimestampType):
        return F.try_to_timestamp(cell, F.lit(timestamps))
    if isinstance(kind, T.IntegralType):
        # A whole number only: a cast from text would cut 1.5 to 1.
        return F.when(F.trim(cell).rlike(r"^[+-]?[0-9]+\z"), F.trim(cell).try_cast(kind))
    return F.trim(cell).try_cast(kind)


def read_checked(spark: SparkSession, path: str, schema: T.StructType,
                 timestamp_format: str = RAW_TIMESTAMP_FORMAT) -> DataFrame:
    """The rows of raw files in their declared types, with two more columns.

    ``_reasons`` lists (column, kind, cell) for each cell that is not empty and does
    not parse, and one entry for a line of the wrong width; it is empty for a good
    row. ``_line`` is the raw line of a row of the wrong width. No row is dropped.
    """
    text = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema),
                         T.StructField(LINE, T.StringType())])
    rows = RawFormat(timestamp_format).open(spark.read, text).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=LINE).load(path)
    values = {f.name: parsed(F.col(f.name), f.dataType, timestamp_format) for f in schema}

    def reason(column: str, kind: str, cell: Column) -> Column:
        return F.struct(F.lit(column).alias("column"), F.lit(kind).alias("kind"), cell.alias("cell"))

    checks = [F.when(F.col(f.name).isNotNull() & values[f.name].isNull(),
                     reason(f.name, f.dataType.simpleString(), F.col(f.name)))
              for f in schema if not isinstance(f.dataType, T.StringType)]
    width = F.when(F.col(LINE).isNotNull(), reason(WIDTH, "line", F.col(LINE)))
    reasons = F.filter(F.array(width, *checks), lambda r: r.isNotNull())
    return rows.select(*(values[f.name].alias(f.name) for f in schema), reasons.alias(REASONS), LINE)


def split_checked(checked: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows), from one write of the checked rows to the shared folder.

    Good rows have the declared columns only; bad ones also their reasons and line.
    """
    path = fresh_path(checked.sparkSession, name)
    bad = (F.size(REASONS) > 0).cast("int")
    checked.withColumn("_bad", bad).write.partitionBy("_bad").parquet(path)
    schema = T.StructType([*checked.schema, T.StructField("_bad", T.IntegerType())])
    stored = checked.sparkSession.read.schema(schema).parquet(path)
    good = stored.where("_bad = 0").drop("_bad", REASONS, LINE)
    return good, stored.where("_bad = 1").drop("_bad")


def reason_counts(bad: DataFrame) -> DataFrame:
    """Per column and declared kind, the number of bad cells."""
    return bad.select(F.explode(REASONS).alias("reason")).groupBy(
        "reason.column", "reason.kind").agg(F.count(F.lit(1)).alias("cells"))
