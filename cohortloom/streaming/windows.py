"""Counts per key and window of event time, kept in the state store as rows arrive.

State is held per key and part of a key, so a key with many rows is several states. A
window is closed once its rows are too late to be expected, and leaves the state; rows
that come for it afterwards are handed out as they are, never dropped.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from cohortloom.sources.lake import materialise
from cohortloom.sources.snapshot import SnapshotTable

MICRO = 1_000_000


def schema_of(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


TEXT, WHOLE = T.StringType(), T.LongType()
COUNTS = schema_of(key=TEXT, part=T.IntegerType(), window=WHOLE, n=WHOLE, first_at=WHOLE, first_id=TEXT)
OUT = T.StructType([T.StructField("kind", TEXT), *COUNTS, T.StructField("row", TEXT)])
STATE = schema_of(high=WHOLE, windows=TEXT)


@dataclass(frozen=True)
class Windows:
    """``seconds``: length of a window; ``delay``: how many seconds a row may be behind the
    newest row of its key and part; ``parts``: states per key."""

    seconds: int
    delay: int
    parts: int = 1

    def start(self, at: int) -> int:
        return at // (self.seconds * MICRO) * self.seconds * MICRO

    def closed(self, start: int, high: int | None) -> bool:
        return high is not None and start + self.seconds * MICRO <= high - self.delay * MICRO


def counter(rules: Windows) -> Callable:
    """The update of one state by the rows of a micro-batch.

    Whether a row is late is settled by what was known before the batch, so the order of
    rows inside a batch does not matter. Every window that changes is handed out with
    its count so far; a later count replaces it.
    """
    def update(group, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        key, part = group
        high, held = (state.get[0], json.loads(state.get[1])) if state.exists else (None, {})
        windows = {int(k): v for k, v in held.items()}
        before, changed, late = high, set(), []
        for frame in frames:
            for at, name, row in zip(frame["at"], frame["id"], frame["row"], strict=True):
                at, start = int(at), rules.start(int(at))
                high = at if high is None else max(high, at)
                if rules.closed(start, before):
                    late.append((start, at, name, row))
                    continue
                count, first = windows.get(start, (0, [at, name]))
                windows[start] = (count + 1, min([at, name], list(first)))
                changed.add(start)
        out = [("window", key, part, s, windows[s][0], *windows[s][1], None) for s in sorted(changed)]
        out += [("late", key, part, s, 1, at, name, row) for s, at, name, row in late]
        windows = {s: w for s, w in windows.items() if not rules.closed(s, high)}
        state.update((high, json.dumps(windows)))
        yield pd.DataFrame(out, columns=OUT.names)

    return update


def window_rows(rows: DataFrame, rules: Windows, *, key: str, at: str, row_id: str) -> DataFrame:
    """The changed windows and late rows of a stream, as rows of ``OUT``.

    A row is known by ``row_id``, which also picks its part. Keys and ids travel as
    text. Rows without a moment, key or id are left to ``unplaceable``.
    """
    whole = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    placed = rows.where(~unplaceable(key, at, row_id)).select(
        F.col(key).cast("string").alias("key"),
        F.pmod(F.xxhash64(F.col(row_id).cast("string")), F.lit(rules.parts)).cast("int").alias("part"),
        F.unix_micros(F.col(at).cast("timestamp")).alias("at"),
        F.col(row_id).cast("string").alias("id"), whole.alias("row"))
    return placed.groupBy("key", "part").applyInPandasWithState(
        counter(rules), OUT, STATE, "update", GroupStateTimeout.NoTimeout)


def unplaceable(key: str, at: str, row_id: str):
    return F.col(key).isNull() | F.col(at).isNull() | F.col(row_id).isNull()


@dataclass(frozen=True)
class WindowStore:
    """Where a stream keeps its windows and its late rows: two snapshot tables."""

    counts: SnapshotTable
    late: SnapshotTable

    @classmethod
    def create(cls, spark: SparkSession, root: str, buckets: int = 16) -> WindowStore:
        late = T.StructType([*COUNTS, T.StructField("row", TEXT)])
        return cls(
            SnapshotTable.create(spark, f"{root}/counts", COUNTS, ["key", "part", "window"], ["n"], buckets),
            SnapshotTable.create(spark, f"{root}/late", late, ["key", "first_id"], ["first_at"], buckets))

    def totals(self) -> DataFrame:
        """Per key and window: n rows counted in time, n_late after it, and the first moment
        and id of all of them."""
        counted = self.counts.read().withColumn("n_late", F.lit(0))
        late = self.late.read().drop("row").withColumns({"n": F.lit(0), "n_late": F.lit(1)})
        return counted.unionByName(late).groupBy("key", "window").agg(
            F.sum("n").alias("n"), F.sum("n_late").alias("n_late"),
            F.min(F.struct("first_at", "first_id")).alias("_first")).select(
                "key", F.timestamp_micros("window").alias("window"), "n", "n_late",
                F.timestamp_micros("_first.first_at").alias("first_at"), "_first.first_id")

    def late_rows(self, schema: T.StructType) -> DataFrame:
        """The rows that came after their window was closed, as they came."""
        return self.late.read().select(F.from_json("row", schema).alias("r")).select("r.*")


def count_windows(stream: DataFrame, store: WindowStore, rules: Windows, *, key: str, at: str,
                  row_id: str, checkpoint: str) -> StreamingQuery:
    """Keep the store up to date with a stream; started with availableNow.

    A window's count only grows, and a late row has its id, so a micro-batch that is
    replayed after a failure changes nothing it has changed before. Of late rows with
    one key and id one is kept.
    """
    def merge(batch: DataFrame, number: int) -> None:
        # Stored, since reading the batch again would go through the states again.
        ready = materialise(batch, "window-batch")
        store.counts.upsert(ready.where("kind = 'window'"))
        store.late.upsert(ready.where("kind = 'late'"))

    changed = window_rows(stream, rules, key=key, at=at, row_id=row_id)
    return changed.writeStream.outputMode("update").foreachBatch(merge).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
