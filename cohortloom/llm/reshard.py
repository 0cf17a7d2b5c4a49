"""Resharding by minimum-cost flow: new shard sizes with the fewest bytes moved.

The driver sees one number per old and new shard. A flow from old sizes to new
capacities tells how many bytes go from each shard to each; documents, in a fixed
order inside their old shard, are cut into blocks of those lengths. Only shards
that give or take a block are written again.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import digest_bin, running_sum, set_aside, size_class

#: Rows of one size class in a shard, and of one new shard, are spread over so many bins.
BINS, SLOT_BINS = 256, 2048


def even_capacities(total: int, shards: int) -> list[int]:
    """``total`` in ``shards`` whole parts that differ by one at most."""
    return [total // shards + (i < total % shards) for i in range(shards)]


def least_cost_flow(sizes: Sequence[int], capacities: Sequence[int],
                    cost: np.ndarray | None = None) -> np.ndarray:
    """Bytes from each old shard to each new one at the least total cost.

    Successive shortest paths: each path takes bytes of a shard with some left to a
    shard with room, and may re-route bytes sent before. ``cost`` is per byte and
    pair; the usual one is 0 for staying in the shard of the same number, else 1.
    """
    left, room = np.array(sizes, np.int64), np.array(capacities, np.int64)
    if left.sum() > room.sum():
        raise ValueError("the new shards hold less than the old ones")
    if cost is None:
        cost = 1.0 - np.eye(len(left), len(room))
    flow = np.zeros((len(left), len(room)), np.int64)
    while left.any():
        far = np.where(left > 0, 0.0, np.inf)
        ahead = np.full(len(room), np.inf)
        came, giver = np.full(len(left), -1), np.full(len(room), -1)
        while True:
            # A parent changes on a strict gain only; ties could close a circle.
            reach = far[:, None] + cost
            nearer = reach.min(0) < ahead - 1e-9
            giver[nearer], ahead[nearer] = reach.argmin(0)[nearer], reach.min(0)[nearer]
            back = np.where(flow > 0, ahead - cost, np.inf)
            better = back.min(1) < far - 1e-9
            if not better.any():
                break
            came[better], far[better] = back.argmin(1)[better], back.min(1)[better]
        end = int(np.where(room > 0, ahead, np.inf).argmin())
        path, j = [], end
        while True:
            i = int(giver[j])
            path.append((i, j))
            if came[i] < 0:
                break
            j = int(came[i])
        amount = min([left[i], room[end], *(flow[path[k][0], path[k + 1][1]]
                                            for k in range(len(path) - 1))])
        for k, (a, b) in enumerate(path):
            flow[a, b] += amount
            if k + 1 < len(path):
                flow[a, path[k + 1][1]] -= amount
        left[i] -= amount
        room[end] -= amount
    return flow


def transfers(flow: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(old, new, first byte, end byte) of every block; what stays comes first."""
    out = []
    for old, row in enumerate(flow.tolist()):
        at = 0
        for new in sorted(range(len(row)), key=lambda j: (j != old, j)):
            if row[new]:
                out.append((old, new, at, at + row[new]))
                at += row[new]
    return out


def reshard(rows: DataFrame, *, size: str, old: str, capacities: Sequence[int] | int,
            order: Sequence[str] = ("doc_id",), cost: np.ndarray | None = None,
            old_shards: int | None = None) -> DataFrame:
    """Adds shard and slot, gapless from 0 in each shard, to every row.

    ``old`` is the present shard from 0 up, not null; ``size`` is above 0.
    ``capacities`` lists the bytes of each new shard, or is the number of equal ones.
    Inside an old shard the largest rows come first and stay; a row belongs to the
    block its middle byte is in, so a shard misses its capacity by half a row at
    each end of its blocks. Rows that agree in size and ``order`` are
    interchangeable; repeated rows are placed each. An empty table gives no rows.
    Columns of ``rows`` named shard or slot come back as in_shard and in_slot. Equal
    texts are not kept together: each is placed by its own middle byte. Only sizes are
    read, so the length of a text does not matter.
    """
    rows, named = set_aside(rows, ("shard", "slot"))
    size, old, order = named(size), named(old), [named(c) for c in order]
    spark = rows.sparkSession
    sizes = {r[0]: r[1] for r in rows.groupBy(old).agg(F.sum(size)).collect()}
    n_old = old_shards or max(sizes, default=-1) + 1
    if isinstance(capacities, int):
        capacities = even_capacities(sum(sizes.values()), capacities)
    blocks = transfers(least_cost_flow([sizes.get(i, 0) for i in range(n_old)], capacities, cost))
    table = {}
    for was, new, start, end in blocks:
        table.setdefault(was, []).append((start, end, new))
    # One row per old shard with its blocks: the size of the plan, not of the data.
    plan = spark.createDataFrame(
        [(was, own) for was, own in table.items()],
        "_was int, _blocks array<struct<start: long, end: long, shard: int>>")
    placed = rows.withColumns({
        "_was": F.col(old).cast("int"), "_bytes": F.col(size).cast("long"),
        "_class": -size_class(size), "_bin": digest_bin(order[0], BINS)})
    keys = [F.col(c) for c in order]
    placed = running_sum(placed, ["_was", "_class", "_bin"], [F.col("_bytes").desc(), *keys],
                         {"_start": "_bytes"})
    middle = F.col("_start") + F.expr("_bytes div 2")
    placed = placed.join(F.broadcast(plan), "_was").withColumn("shard", F.element_at(
        F.filter("_blocks", lambda b: b["end"] > middle), 1)["shard"])
    slots = placed.drop("_was", "_bytes", "_class", "_start", "_blocks").withColumns(
        {"_one": F.lit(1), "_bin": digest_bin(order[0], SLOT_BINS)})
    return running_sum(slots, ["shard", "_bin"], keys, {"slot": "_one"}).drop("_bin", "_one")


def rewrite_shards(placed: DataFrame, old_folder: str, new_folder: str, *, old: str,
                   contents: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Write the shards that gave or took rows below ``new_folder``; a manifest of all.

    ``old_folder`` holds the present shards as ``<old>=<number>``. The manifest has
    shard, path, n_rows and rewritten; an untouched shard points to its old files.
    A shard of several files is cut between tasks by slot. With ``contents``, the rows
    written are its columns, found by ``key``, with shard and slot, so that texts do not
    travel through the placement; they are dealt once, by key, and each task writes its
    part of each shard.
    """
    moved = placed.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum((F.col(old) != F.col("shard")).cast("long")).alias("_in"))
    gave = placed.where(F.col(old) != F.col("shard")).groupBy(F.col(old).alias("shard")).agg(
        F.count(F.lit(1)).alias("_out"))
    state = moved.join(gave, "shard", "left").select(
        "shard", "n_rows", ((F.col("_in") > 0) | F.col("_out").isNotNull()).alias("rewritten"))
    shards = state.collect()
    touched = [r.shard for r in shards if r.rewritten]
    out = placed.where(F.col("shard").isin(touched)).drop(old) if touched else None
    if out is not None:
        out = (out.hint("rebalance", "shard") if contents is None else
               out.select(key, "shard", "slot").join(contents, key).drop(key))
        out.write.option("compression", "zstd").partitionBy("shard").parquet(new_folder)
    rows = [(r.shard, f"{new_folder}/shard={r.shard}" if r.rewritten
             else f"{old_folder}/{old}={r.shard}", r.n_rows, r.rewritten) for r in shards]
    return placed.sparkSession.createDataFrame(rows, T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("path", T.StringType()),
        T.StructField("n_rows", T.LongType()), T.StructField("rewritten", T.BooleanType())]))
