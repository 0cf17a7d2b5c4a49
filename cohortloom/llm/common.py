"""Helpers the corpus operators share: words, batches, stored tables, running sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from cohortloom.session import fresh_path

#: Characters between words, for regular expressions of the JVM and of DuckDB.
GAP = r"\x20\x09-\x0D"
#: Spark's setting to remove the shuffle files of a finished query.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of one Arrow batch are handled in pieces of about so many bytes of text.
PIECE_BYTES = 8 << 20


def _plain_table() -> bytes:
    """Maps bytes so that split() gives runs of 0-9, a-z and non-ASCII, A-Z in lower case."""
    table = bytearray(b" " * 256)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low:high + 1] = bytes(range(low, high + 1))
    table[0x41:0x5B] = bytes(range(0x61, 0x7B))
    return bytes(table)


PLAIN = _plain_table()


def spaced_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.lower().split() if text else []


def plain_words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case."""
    return text.translate(PLAIN).split() if text else []


def pieces(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of a batch with the bytes of one text column as a list.

    A part ends once it holds PIECE_BYTES of text, so that a batch of very long
    texts is not unpacked at once.
    """
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    if not texts.null_count and texts.nbytes <= PIECE_BYTES:
        yield batch, texts.to_pylist()
        return
    start, held, out = 0, 0, []
    for i, text in enumerate(texts):
        out.append(text.as_py())
        held += len(out[-1] or b"")
        if held >= PIECE_BYTES:
            yield batch.slice(start, i + 1 - start), out
            start, held, out = i + 1, 0, []
    if out:
        yield batch.slice(start), out


def text_columns(df: DataFrame, column: str, fields: Sequence[T.StructField],
                 prepare: Callable[[], Callable[[list], list[pa.Array]]],
                 keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and new ones computed in Python from one text column.

    ``prepare`` runs once per task and returns the function from a list of UTF-8
    texts to one Arrow array per field.
    """
    schema = T.StructType([*(df.schema[c] for c in keep), *fields])

    def run(batches):
        compute = prepare()
        for batch in batches:
            for part, texts in pieces(batch, column):
                kept = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, *compute(texts)], names=schema.names)

    return df.mapInArrow(run, schema)


def written(df: DataFrame, name: str, *, codec: str | None = None) -> DataFrame:
    """Store once in the shared folder and go on from the stored table.

    ``codec``: the compression of its files, the session's unless given; tables that hold
    whole texts are a quarter smaller under zstd than under snappy.

    The shuffles of the write are removed once it is done: nothing reads them again, and
    until the driver happens to collect them they would pile up on the executors' disks.
    """
    path, conf = fresh_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(DROP_SHUFFLES)
    conf.set(DROP_SHUFFLES, "true")
    try:
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    finally:
        conf.set(DROP_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, Callable[[str], str]]:
    """``df`` with its columns of these names renamed to in_<name>, and the new name of any
    column. An in_<name> that is taken too gets another in_ before it."""
    new = {}
    for name in set(names) & set(df.columns):
        new[name] = f"in_{name}"
        while new[name] in df.columns:
            new[name] = f"in_{new[name]}"
    return df.withColumnsRenamed(new), lambda name: new.get(name, name)


def digest_bin(column: Column | str, bins: int) -> Column:
    """A bin from 0 to ``bins`` - 1 by the MD5 of a value's text; null counts as ''."""
    text = F.coalesce(F.col(column).cast("string") if isinstance(column, str)
                      else column.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % bins).cast("int")


def size_class(column: str) -> Column:
    """Number of digits and the first two digits of a number: classes a tenth wide at most
    from 10 on, in the order of the numbers."""
    digits = F.col(column).cast("string")
    return F.length(digits) * 100 + F.rpad(F.substring(digits, 1, 2), 2, "0").cast("int")


def running_sum(df: DataFrame, levels: Sequence[str], order: Sequence[Column],
                totals: dict[str, str]) -> DataFrame:
    """Per row, sums over the rows before it in its group, the row left out.

    The group is ``levels[0]``; the order inside it is ``levels[1:]``, then
    ``order``. Only rows that agree in all levels meet in one window, and per
    group only the totals of the next level, so no task sorts a whole group as
    long as each level has a bounded number of values within the one before.
    Levels may not be null. ``totals`` maps new names to summed columns.
    """
    sums = {c: F.sum(source).alias(c) for c, source in totals.items()}
    lowest = df.groupBy(*levels).agg(*sums.values())
    offsets = None
    for depth in range(1, len(levels)):
        keys = list(levels[:depth + 1])
        table = lowest if depth + 1 == len(levels) else lowest.groupBy(*keys).agg(
            *(F.sum(c).alias(c) for c in totals))
        before = W.Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(
            W.Window.unboundedPreceding, -1)
        table = table.select(*keys, *(
            F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in totals))
        if offsets is not None:
            table = table.join(offsets, keys[:-1])
            table = table.select(*keys, *((F.col(f"_{c}") + F.col(f"_{c}_up")).alias(f"_{c}")
                                          for c in totals))
        offsets = table.select(*keys, *(F.col(f"_{c}").alias(f"_{c}_up") for c in totals))
    inner = W.Window.partitionBy(*levels).orderBy(*order).rowsBetween(
        W.Window.unboundedPreceding, -1)
    here = {c: F.coalesce(F.sum(source).over(inner), F.lit(0)) for c, source in totals.items()}
    if offsets is None:
        return df.withColumns(here)
    joined = df.join(offsets, list(levels))
    return joined.withColumns({c: e + F.col(f"_{c}_up") for c, e in here.items()}).drop(
        *(f"_{c}_up" for c in totals))
