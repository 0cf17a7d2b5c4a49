"""Mixing sources to target weights by systematic sampling.

Targets come from the weights by filling up to a limit. Inside a source, documents
stand in order of size; their expected copies are summed up from the front, one
offset is added, and a document is emitted once per whole number that its share of
the sum crosses. Sums are exact decimals, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.llm.common import digest_bin, GAP, running_sum, set_aside, size_class, written

WEIGHTS = (5, 2, 1)
LIMIT = 3
#: Parts of one copy in which expected copies are counted.
UNIT = 10**12
#: Sources whose row of targets is sent to all tasks; for more of them rows are shuffled.
MOST_SOURCES = 100_000
#: Documents of one size class are spread over so many bins.
BINS = 256


def word_count(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(f"[^{GAP}]+")), F.lit(0)).cast("long")


def source_key(source: str) -> F.Column:
    """Never null; in the order of the sources' code points, a null source last."""
    return F.coalesce(F.concat(F.lit("a"), F.col(source).cast("string")), F.lit("b"))


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT
                   ) -> DataFrame:
    """One row per ``_source``: source_size, target, expected copies of its documents.

    Sources in the order of their keys take the weights in turn and share the size
    of all. A target stops at ``limit`` times its source's size; the excess goes to
    the others by weight. The end of that is one level per weight for all below
    their limit, found by going through the sources in the order of limit per
    weight. The windows see one row of sums per source, never documents.
    """
    sources = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy("_source")) - 1
    given = F.array(*(F.lit(int(w)).cast("long") for w in weights))
    sources = sources.select(
        "_source", "source_size", (limit * F.col("source_size")).alias("_most"),
        F.element_at(given, turn % len(weights) + 1).alias("_weight"))
    before = Window.orderBy(F.col("_most") / F.col("_weight"), "_source").rowsBetween(
        Window.unboundedPreceding, -1)
    every = Window.orderBy(F.col("_most") / F.col("_weight"), "_source").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    sources = sources.withColumns({
        "_left": F.sum("source_size").over(every) - F.coalesce(F.sum("_most").over(before), F.lit(0)),
        "_open": F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0))})
    # At its limit if the level shared by it and all later sources reaches that far.
    capped = F.col("_left") * F.col("_weight") >= F.col("_most") * F.col("_open")
    sources = sources.withColumn("_capped", capped)
    sources = sources.withColumns({
        "_level": F.max(F.when(~F.col("_capped"), F.col("_left"))).over(every),
        "_share": F.max(F.when(~F.col("_capped"), F.col("_open"))).over(every)})
    wanted = F.when(F.col("_capped"), F.col("_most")).otherwise(F.col("_weight") * F.col("_level"))
    parts = F.when(F.col("_capped"), F.lit(1)).otherwise(F.col("_share"))
    sources = sources.withColumns({
        "target": wanted / parts,
        "_wanted": wanted.cast("decimal(25,0)"),
        "_have": (parts * F.col("source_size")).cast("decimal(25,0)")})
    expected = F.expr(f"if(_have = 0, 0, (_wanted * cast({UNIT} as decimal(13,0))) div _have)")
    return sources.select("_source", "source_size", "target", expected.alias("_expected"))


def systematic_copies(docs: DataFrame, *, size: str, source: str = "source",
                      order: Sequence[str] = ("doc_id",), seed: int = 1,
                      weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Adds source_size, target and copies to each row of ``docs``.

    A source whose documents have no words has target 0 and no copies. Rows that
    agree in size and ``order`` are interchangeable. An empty table gives no rows.
    No document gets more copies than ``limit``, since its expected copies are not
    above it. A null source is a source of its own. Columns of ``docs`` with a name of
    the result come back as in_<name>.
    """
    docs, named = set_aside(docs, ("source_size", "target", "copies"))
    size, source, order = named(size), named(source), [named(c) for c in order]
    sized = docs.withColumns({"_source": source_key(source), "_size": F.col(size)})
    targets = written(source_targets(sized, weights, limit), "source-targets")
    if targets.count() <= MOST_SOURCES:
        targets = F.broadcast(targets)
    rows = sized.join(targets, "_source").withColumns({
        "_class": size_class("_size"), "_bin": digest_bin(order[0], BINS),
        "_expected": F.col("_expected").cast("decimal(20,0)")})
    rows = running_sum(rows, ["_source", "_class", "_bin"],
                       [F.col("_size"), *(F.col(c) for c in order)], {"_before": "_expected"})
    key = F.md5(F.concat(F.lit(f"{seed}/"), F.col("_source")))
    offset = F.conv(F.substring(key, 1, 12), 16, 10).cast("long") % UNIT
    rows = rows.withColumn("_from", (F.col("_before") + offset).cast("decimal(36,0)"))
    copies = F.expr(f"(_from + _expected) div {UNIT} - _from div {UNIT}")
    return rows.withColumn("copies", copies.cast("long")).drop(
        "_source", "_size", "_class", "_bin", "_expected", "_before", "_from")


def mix(docs: DataFrame, *, text: str = "text", source: str = "source",
        order: Sequence[str] = ("doc_id",), seed: int = 1, weights: Sequence[int] = WEIGHTS,
        limit: int = LIMIT) -> DataFrame:
    """The mixture: each row of ``docs`` as often as it was drawn, with its columns."""
    inner = docs.select(
        F.struct(*(F.col(c) for c in docs.columns)).alias("_row"), F.col(source).alias("_from_source"),
        *(F.col(c).alias(f"_order{i}") for i, c in enumerate(order)),
        F.xxhash64(*(F.col(c) for c in docs.columns)).alias("_tie"),
        word_count(text).alias("_words"))
    drawn = systematic_copies(
        inner, size="_words", source="_from_source", seed=seed, weights=weights, limit=limit,
        order=[*(f"_order{i}" for i in range(len(order))), "_tie"])
    return drawn.where("copies > 0").select(
        "_row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy")
    ).select("_row.*")
