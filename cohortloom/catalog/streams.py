"""Streams over the given events, replayed in shuffled files."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.catalog.base import query
from cohortloom.session import fresh_path
from cohortloom.streaming.windows import Windows, WindowStore, count_windows

DAY = 86_400


def replayed(t, files: int, rules: Windows) -> WindowStore:
    """All events through the stream, dealt to files by a hash of their id."""
    events = t.load("events").select("event_id", "user_id", "event_type", "ts")
    folder, root = fresh_path(t.spark, "arrivals"), fresh_path(t.spark, "windows")
    events.repartition(files, F.md5(F.col("event_id").cast("string"))).write.parquet(folder)
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    store = WindowStore.create(t.spark, f"{root}/store", buckets=4)
    count_windows(stream, store, rules, key="user_id", at="ts", row_id="event_id",
                  checkpoint=f"{root}/checkpoint").awaitTermination()
    return store


DAYS = """
select user_id, date_trunc('day', ts)::timestamp as day, count(*) as n, min(ts) as first_at
from events group by all"""


@query("st1_window_counts", DAYS)
def st1(t):
    """Events per user and day: shuffled over the month, none is late."""
    totals = replayed(t, 3, Windows(DAY, 40 * DAY, parts=2)).totals()
    return totals.select(F.col("key").cast("long").alias("user_id"), F.col("window").alias("day"),
                         "n", "first_at")


@query("st1_window_counts_late", DAYS)
def st1_late(t):
    """The same with two days of delay: most rows are late, and none is lost."""
    totals = replayed(t, 3, Windows(DAY, 2 * DAY)).totals()
    return totals.select(F.col("key").cast("long").alias("user_id"), F.col("window").alias("day"),
                         (F.col("n") + F.col("n_late")).alias("n"), "first_at")
