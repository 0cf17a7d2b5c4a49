"""Token counts of documents without their ids.

Units (see ``tokens``) are counted over the corpus and the pieces of each distinct
unit are found once. The most common units travel to the tasks as a table of
bounded size; what a document holds of the others is joined to their pieces.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import size_class, text_columns, written
from cohortloom.llm.tokens import encoder

#: Distinct units a task adds up before it passes them on.
MOST_HELD = 500_000


def unit_pieces(docs: DataFrame, text: str, path: str) -> DataFrame:
    """(unit, times, pieces): every distinct unit of all texts, each encoded once."""
    def count(batches):
        own, held = encoder(path), Counter()

        def out():
            table = pa.table({"unit": pa.array(held.keys(), pa.string()),
                              "times": pa.array(held.values(), pa.int64())})
            return table.to_batches(50_000)

        for batch in batches:
            for value in batch.column(0):
                value = value.as_py()
                if value:
                    held.update(own.units(value))
                if len(held) >= MOST_HELD:
                    yield from out()
                    held.clear()
        yield from out()

    def pieces(batches):
        own = encoder(path)
        for batch in batches:
            sizes = [len(ids) for ids in own.encode(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int32())], names=["unit", "times", "pieces"])

    units = docs.select(text).mapInArrow(count, "unit string, times bigint")
    return units.groupBy("unit").agg(F.sum("times").alias("times")).mapInArrow(
        pieces, "unit string, times bigint, pieces int")


def count_tokens(docs: DataFrame, path: str, *, ident: str = "doc_id", text: str = "text",
                 limit: int = 512, most_common: int = 500_000, longest: int = 64) -> DataFrame:
    """Per row of ``docs``: the id, n_bytes, n_tokens and whether these are over ``limit``.

    ``path`` is a tokenizer file. At most ``most_common`` units of at most
    ``longest`` characters are sent to the tasks, a few dozen MB there: those from the
    class of counts on above which there are no more. A null or empty text has no
    tokens. Repeated rows are counted each. An empty table gives no rows. A very long
    text is cut into its units in one task, which holds its distinct units. Other
    columns are not read.
    """
    frame = docs.select(
        F.col(ident).alias("ident"), F.col(text).alias("_text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    pieces = written(unit_pieces(frame, "_text", path), "unit-pieces")
    short = pieces.where(F.char_length("unit") <= longest).withColumn("_class", size_class("times"))
    lowest, above = None, 0
    classes = short.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("_class"))
    for row in classes.collect():  # About 90 for each digit of the largest count.
        above += row.n
        if above > most_common:
            break
        lowest = row["_class"]
    common = short.where(F.lit(False) if lowest is None else F.col("_class") >= lowest)
    table = {r.unit: r.pieces for r in common.select("unit", "pieces").toLocalIterator()}
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def prepare():
        own, known = encoder(path), shared.value

        def add_up(texts):
            sums, units, times = [], [], []
            for value in texts:
                total, rest = 0, {}
                for unit, n in Counter(own.units(value.decode()) if value else ()).items():
                    size = known.get(unit)
                    if size is None:
                        rest[unit] = n
                    else:
                        total += n * size
                sums.append(total)
                units.append(list(rest))
                times.append(list(rest.values()))
            return [pa.array(sums, pa.int64()), pa.array(units, pa.list_(pa.string())),
                    pa.array(times, pa.list_(pa.int32()))]
        return add_up

    fields = [T.StructField("_known", T.LongType()),
              T.StructField("_units", T.ArrayType(T.StringType())),
              T.StructField("_times", T.ArrayType(T.IntegerType()))]
    rows = text_columns(frame, "_text", fields, prepare, ["ident", "n_bytes"])
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "token-rows")
    open_units = rows.select("_row", F.explode(F.arrays_zip("_units", "_times")).alias("u")).select(
        "_row", F.col("u._units").alias("unit"), F.col("u._times").alias("times"))
    rest = open_units.join(pieces.select("unit", "pieces"), "unit").groupBy("_row").agg(
        F.sum(F.col("times") * F.col("pieces").cast("long")).alias("_rest"))
    return rows.join(rest, "_row", "left").select(
        F.col("ident").alias(ident), "n_bytes",
        (F.col("_known") + F.coalesce("_rest", F.lit(0))).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
